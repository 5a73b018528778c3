"""Files that are read and written, and what runs leave behind, in awkward cases."""

import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from rolemill.functions import classify
from rolemill.operators import filings, groups, lifecycle, sinks, state
from rolemill.sources import payloads, readers


def test_slices_that_drift(spark, tmp_path):
    for name, text in {"a": "id,url\n1,x\n2,\n", "b": "id,url,more\n3,y,z\n", "empty": "", "head": "id,url\n"}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "jobs.csv").write_text(text)
    rows = {(r.slice, r.id, r.url, r.more) for r in readers.slices(spark, str(tmp_path)).collect()}
    assert rows == {("a", "1", "x", None), ("a", "2", None, None), ("b", "3", "y", "z")}
    with pytest.raises(readers.NothingFound):
        readers.slices(spark, str(tmp_path / "a"))


def test_directories_and_extensions(spark, tmp_path):
    (tmp_path / "lever.csv").write_text("name,slug,url\nAcme,acme,u1\n")
    (tmp_path / "keka.csv").write_text("name,url\nBlue,u2\n")
    (tmp_path / "odd.csv").write_text("a,b\n1,2\n")
    assert {tuple(r) for r in readers.directory(spark, str(tmp_path)).collect()} == {("lever", "Acme", "acme", "u1"), ("keka", "Blue", "", "u2")}
    with gzip.open(tmp_path / "x.jsonl.gz", "wt") as f:
        f.write('{"a": 1}\n{"a": 2}\n')
    assert readers.by_extension(spark, str(tmp_path / "x.jsonl.gz")).count() == 2
    assert readers.by_extension(spark, str(tmp_path / "lever.csv")).columns == ["name", "slug", "url"]
    assert readers.best_format({"csv": "c", "parquet": "p"}) == "p" and readers.best_format({"csv": "c"}) == "c"
    with pytest.raises(readers.NothingFound):
        readers.best_format({})


def test_lines(spark, tmp_path):
    (tmp_path / "gold.jsonl").write_text('{"id": "a", "n": 1}\n\n  \nbroken\n')
    assert sorted((r.id or "", r.n) for r in readers.json_lines(spark, str(tmp_path / "gold.jsonl"), "id string, n int").collect()) == [("", None), ("a", 1)]
    (tmp_path / "names.txt").write_bytes("Caf\xe9: The One:0000000012:\nno number:\n:7:\n".encode("latin-1"))
    assert [tuple(r) for r in readers.keyed_lines(spark, str(tmp_path / "names.txt")).collect()] == [("Café: The One", 12)]
    (tmp_path / "p.jsonl").write_text('{"source": "lever", "company": "acme", "payload": [{"id": "1", "text": "t"}]}\nnothing\n')
    held = payloads.read_payloads(spark, str(tmp_path / "p.jsonl"))
    assert [r.ats_id for r in payloads.postings(held, "lever").collect()] == ["1"]


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("f_main.csv", 'EIN,NAME\n1,"a, b"\n2\n')
        z.writestr("readme.txt", "x")
    rows = readers.zipped_rows(spark, str(tmp_path / "a.zip"), "main", ["name", "ein", "gone"], ("ein",), ",", quoted=True)
    assert [tuple(r) for r in rows.collect()] == [("f_main.csv", "a, b", "1", None), ("f_main.csv", None, "2", None)]
    with pytest.raises(Exception, match="no total"):
        readers.zipped_rows(spark, str(tmp_path / "a.zip"), "main", ["name"], ("total",), ",").collect()


def test_columns_by_any_spelling(spark):
    df = spark.createDataFrame([("a", 1)], "`CIK Number` string, Name int")
    assert df.select(readers.picked(df, "cik", "cik number").alias("x"), readers.picked(df, "none").alias("y")).head() == ("a", None)
    assert [len(b) for b in readers.batches(spark.range(7), 3)] == [3, 3, 1]


def test_files_are_put_in_place(spark, tmp_path):
    path = str(tmp_path / "m.json")
    assert sinks.read_text(spark, path) is None and sinks.read_manifest(None) == sinks.read_manifest("{") == sinks.read_manifest("[]") == {}
    for text in ("one", "zwei é"):
        sinks.write_text(spark, path, text)
        assert sinks.read_text(spark, path) == text
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")) == ["m.json"]
    found = sinks.artifacts(spark, path).head()
    assert found.bytes == 7 and found.sha256 == __import__("hashlib").sha256("zwei é".encode()).hexdigest()
    (tmp_path / "by_date").mkdir()
    assert sinks.pruned(spark, str(tmp_path), ["by_date", "other"]) == ["by_date"] and sinks.pruned(spark, str(tmp_path), ["by_date"]) == []


def test_publication(spark, tmp_path):
    df = spark.createDataFrame([("a", "1", ["x"]), ("b", "2", None)], "ats_type string, id string, tags array<string>")
    sinks.write_text(spark, f"{tmp_path}/manifest.json", json.dumps({"companies": {"rows": 9}, "by_date": {}}))
    made = sinks.publish_all(df, str(tmp_path), "2026-01-01")
    assert made == json.loads(sinks.read_text(spark, f"{tmp_path}/manifest.json")) and made["companies"] == {"rows": 9} and "by_date" not in made
    with pytest.raises(sinks.EmptySliceError):
        sinks.publish_all(df.where("ats_type = 'a'"), str(tmp_path), "2026-01-02")
    assert sinks.publish_all(df.where("ats_type = 'a'"), str(tmp_path), "2026-01-02", allow_empty=True)["stats"]["ats_count"] == 1


@pytest.mark.parametrize(("counts", "policy", "want"), [
    ({"targets": 3, "rows": 5, "error": 1}, {}, "publish"), ({"targets": 3, "rows": 5, "error": 1}, {"fail_closed_on_any_error": True}, "shards_failed"),
    ({"targets": 3, "rows": 0}, {"fail_closed_on_empty": True}, "empty"), ({"targets": 3, "rows": 5, "not_found": 1}, {"fail_closed_on_not_found": True}, "shards_failed"),
    ({"targets": 4, "rows": 0, "error": 2}, {}, "failed"), ({"targets": 5, "rows": 0, "error": 2}, {}, "publish"), ({}, {"fail_closed_on_empty": True}, "publish"),
    ({"targets": 3, "rows": 5, "omitted": 1}, {"fail_closed_on_any_error": True}, "shards_failed"),
])
def test_run_verdict(counts, policy, want):
    assert sinks.run_verdict(counts, policy) == want
    assert sinks.run_verdict(counts | {"error": 1}, policy, streaming=True) == "streaming_failed"


def test_shards_keep_their_bounds(spark):
    df = spark.createDataFrame([(i, "x" * n) for i, n in enumerate([10, 10, 90, 5, 5, 5, 5, 250, 1, 1])], "id long, text string")
    rows = sorted(sinks.sharded(df, "id", "text", 3, 100).collect(), key=lambda r: r.id)
    assert [r.shard for r in rows] == [0, 0, 1, 1, 2, 2, 2, 3, 4, 4]
    many = sinks.sharded(df, "id", "text", 3, 100, part_rows=2).collect()
    assert len(many) == 10 and len({r.part for r in many}) > 1


def test_ledgers_and_reports(spark):
    df = spark.createDataFrame([("b", 1.23456), ("a", None)], "stage string, cost double")
    assert [(r.stage, r.sequence) for r in sinks.ledger(df, 7, "stage").orderBy("sequence").collect()] == [("a", 8), ("b", 9)]
    assert sinks.report(df, "Costs") == "## Costs\n\n| stage | cost |\n|---|---|\n| b | 1.235 |\n| a |  |\n"


def test_batches_and_caches(spark):
    rows = spark.createDataFrame([("x", "s", "submitted", 1), ("x", "s", "completed", 3), ("y", "t", "running", 2), ("z", "u", "collected", 2)], "batch_id string, shard string, status string, at int")
    made = lifecycle.batches(rows)
    assert {r.batch_id: (r.status, r.submitted_at, r.completed_at) for r in made.collect()} == {"x": ("completed", 1, 3), "y": ("running", 2, None), "z": ("collected", 2, None)}
    assert [r.batch_id for r in lifecycle.open_batches(made).collect()] == ["y"] and {r.shard for r in lifecycle.shards_done(made).collect()} == {"s", "u"}
    pages = spark.createDataFrame([("a", None, 1), ("b", "p", 1)], "domain string, page string, at int")
    later = lifecycle.crawl_cache(pages, spark.createDataFrame([("a", "q", 2)], pages.schema), ["domain"], "at")
    assert {tuple(r) for r in later.collect()} == {("a", "q", 2), ("b", "p", 1)}
    assert lifecycle.projected(spark.createDataFrame([(100,), (300,)], "tokens int"), 1_000_000, 1.0, 2.0).head() == (200.0, 560.0, 280.0)


def test_registry():
    boards = lifecycle.Registry()

    @boards.register("own")
    def read(df):
        return df

    assert boards.get("own") is read and boards.names() == ["own"]
    with pytest.raises(ValueError):
        boards.register("own")(read)


def test_filings(spark):
    dates = spark.createDataFrame([("31-MAY-2024",), ("2024-05-31 10:00",), ("soon",), (None,)], "d string")
    assert [str(r.x) for r in dates.select(filings.filed_date("d").alias("x")).collect()] == ["2024-05-31", "2024-05-31", "None", "None"]
    names, tickers = spark.createDataFrame([("Acme", 1), ("Blue", 2)], "name string, key int"), spark.createDataFrame([("ACME CORP", 1, "AC")], "name string, key int, ticker string")
    assert {tuple(r) for r in filings.registrants(names, tickers).collect()} == {("Acme", 1, "AC", True), ("ACME CORP", 1, "AC", True), ("Blue", 2, None, False)}
    with pytest.raises(Exception, match="unknown verdict"):
        filings.precision(spark.createDataFrame([("s", "perhaps")], "s string, verdict string"), "s").collect()
    held = spark.createDataFrame([("wrong", "f"), ("wrong", ""), ("correct", "f"), ("correct", None)], "verdict string, flags string")
    assert filings.flag_recall(held, "flags").head() == (2, 1, 2, 0.5, 0.5)
    sponsors = spark.createDataFrame([("1", "Blue Harbor Inc", 10, "TX", "2023"), ("1", "Blue Harbor Inc", 90, "TX", "2022"), ("1", "Blue Harbor Inc", 30, "TX", "2023"), ("2", "Blue Harbor LLC", 20, "TX", "2023")], "ein string, sponsor string, participants long, state string, as_of string")
    assert filings.sponsor_floors(sponsors).head() == ("blueharbor", 30, 2, 3)
    counts = spark.createDataFrame([("t", "2023", 2, 5), ("t", "2024", 3, 7), ("t", "2024", 1, 6), ("t", None, 0, 99)], "k string, as_of string, source_rank int, employees int")
    assert filings.freshest(counts, "k").head().employees == 6


def test_joins_that_would_add_rows(spark):
    left, right = spark.createDataFrame([(1,), (2,), (2,)], "k int"), spark.createDataFrame([(1, "a"), (3, "b"), (3, "c")], "k int, v string")
    assert sorted(map(tuple, groups.joined_once(left, right, ["k"]).collect()), key=str) == [(1, "a"), (2, None), (2, None)]
    with pytest.raises(Exception, match="several rows for 3"):
        groups.joined_once(spark.createDataFrame([(3,)], "k int"), right, ["k"]).collect()


def test_cached_fields(spark):
    df = spark.createDataFrame([("", "x"), ("own", None)], "a string, b string")
    filled = state.filled_blanks(df, {"a": F.lit("kept"), "b": F.lit("kept")})
    assert [tuple(r) for r in filled.collect()] == [("kept", "x"), ("own", "kept")]
    assert state.look_capped(df, "a", 3) and not state.look_capped(df, "a", 2) and not state.look_capped(df.where("a = ''"), "a", 3)


def test_answers_without_a_model(spark):
    said = "You have 5 years of experience with mills. " * 4
    row = spark.createDataFrame([("Senior Welder (Remote)", said), ("Welder", "short"), ("Welder", None)], "title string, description string").select(classify.offline_answer().alias("x")).collect()
    assert [(r.x.insufficient_text, r.x.seniority, r.x.placement, r.x.experience) for r in row] == [(False, "SENIOR", "remote", 5), (True, None, None, None), (True, None, None, None)]
