"""Queries over tables of a few awkward rows, for what SQL can't express."""

import pytest

from rolemill.queries import ORACLE, QUERIES

LONG = "word " * 4_000
TEXTS = {
    1: "Annual Salary: $320,000 - $405,000 USD and stock",
    2: LONG + "We pay $25.50 - $31.00 per hour. It has 900 full-time employees.",
    3: None,
    4: "",
    5: "Senior Software Engineer. We had 12,500 employees and 300 associates.",
    6: "Between $5 and $7 off. We laid off 200 employees.",
    7: LONG,
}
URLS = {1: "https://acme.wd5.myworkdayjobs.com/Ext", 2: "https://example.com/" + "x/" * 2_000, 3: None, 4: "", 5: "https://jobs.lever.co/acme-co"}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in TEXTS.items()], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, u, "") for i, u in URLS.items()], "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    return path


def test_rules_for_prose_read_the_whole_column(spark, tables):
    def got(name):
        return {r[0]: tuple(r[1:]) for r in QUERIES[name](spark, tables).collect()}

    none = (None,) * 4
    assert got("described_pay") == {1: (320000.0, 405000.0, "USD", "YEAR"), 2: (25.5, 31.0, "USD", "HOUR"), 3: none, 4: none, 5: none, 6: none, 7: none}
    assert got("described_headcounts") == {1: (None,), 2: (900,), 3: (None,), 4: (None,), 5: (12500,), 6: (None,), 7: (None,)}
    assert {k: v[1:] for k, v in got("page_boards").items()} == {1: ("workday", "acme"), 2: (None, None), 3: (None, None), 4: (None, None), 5: ("lever", "acme-co")}
    assert {k: v[1] for k, v in got("posting_classes").items()} == {i: "SENIOR" if i == 5 else None for i in TEXTS}
    assert got("posting_countries") == {i: ("Austin, TX", "US") for i in TEXTS}
    assert {k: v[1:] for k, v in got("posting_pay").items()} == {i: (30000.0, 50000.0) if i % 4 == 1 else (None, None) for i in TEXTS}
    assert not ORACLE.keys() & {"described_pay", "described_headcounts", "page_boards", "posting_classes", "posting_countries", "posting_pay"}
