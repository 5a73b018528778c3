"""The commands, over small tables."""

import json

import pytest

from rolemill.__main__ import main
from rolemill.plans.samples import SAMPLES


def test_commands(spark, tmp_path, capsys):
    rows = spark.createDataFrame([("Welder", "Graz", "lever", 10.0, None), ("Fitter (remote)", "", "keka", None, 5.0)], "title string, location string, ats_type string, salary_min double, salary_max double")
    rows.write.parquet(f"{tmp_path}/l")
    main(["search", f"{tmp_path}/l", "--query", "weld", "--out", f"{tmp_path}/found"], spark)
    assert [r.title for r in spark.read.parquet(f"{tmp_path}/found").collect()] == ["Welder"]
    main(["profile", f"{tmp_path}/l", "--by", "ats_type", "--out", f"{tmp_path}/gaps"], spark)
    assert {r.ats_type: (r.rows, r.location_blank) for r in spark.read.parquet(f"{tmp_path}/gaps").collect()} == {"lever": (1, 0.0), "keka": (1, 1.0)}
    (tmp_path / "p.jsonl").write_text(json.dumps({"source": "lever", "company": "acme", "payload": SAMPLES["lever"].payload}))
    main(["payloads", f"{tmp_path}/p.jsonl", "--out", f"{tmp_path}/postings"], spark)
    assert spark.read.parquet(f"{tmp_path}/postings").head().url == "https://jobs.lever.co/acme/@I"
    main(["list"])
    assert "publish_snapshot" in capsys.readouterr().out.split()
    with pytest.raises(SystemExit):
        main(["run", "no_such_operator", "x"], spark)
