"""Each board's payload, read whole; and payloads that hold nothing, twice the same, or no payload at all."""

import pytest

from rolemill.plans.samples import SAMPLES
from rolemill.sources import payloads
from rolemill.sources.boards import BOARDS


def filled(text):
    return text and text.replace("@I", "4711").replace("@T", "Lead Welder & Fitter").replace("@C", "Graz")


def test_every_board_has_a_sample():
    assert BOARDS.keys() == SAMPLES.keys() and len(BOARDS) == 70


@pytest.fixture(scope="module")
def found(spark):
    odd = [None, "", "[]", "{}", "{", "<li></li>", "[1, null]"]
    rows = [(s, "acme", p) for s, x in SAMPLES.items() for p in [filled(x.payload), filled(x.payload), *odd]]
    table = spark.createDataFrame(rows, "source string, company string, payload string")
    got = {}
    for r in payloads.mixed_postings(table).selectExpr("*", "string(posted_at) AS at").collect():
        got.setdefault(r.ats_type, []).append(r.asDict() | {"posted_at": r["at"]})
    return got


@pytest.mark.parametrize("source", sorted(SAMPLES))
def test_board(found, source):
    sample = SAMPLES[source]
    assert len(found[source]) == 1
    row = found[source][0]
    want = {"ats_id": filled(sample.ats_id), "title": "Lead Welder & Fitter", "url": filled(sample.url), "location": filled(sample.location)} | {k: filled(v) for k, v in sample.more}
    got = {k: str(row[k]).lower() if isinstance(row[k], bool) else str(row[k]) if isinstance(row[k], float) else row[k] for k in want}
    assert got == want
    assert "company" in want or row["company"] == "acme"
