"""Prose about employers, and places out of free text."""

import pytest
from pyspark.sql import functions as F

from rolemill.functions import prose
from rolemill.operators import gazetteer


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).head()["x"]


def test_tidy_and_sentences(spark):
    assert one(spark, prose.tidy("t"), t=" “**Acme** &amp;amp; Co.\n- builds​  `mills`” ") == "Acme & Co. builds mills"
    assert one(spark, prose.tidy("t"), t=None) == ""
    assert one(spark, prose.sentences(F.col("t")), t="Acme Inc. makes mills. It began in the U.S. in 1990! No. 1 there? Yes.") == ["Acme Inc. makes mills.", "It began in the U.S. in 1990!", "No. 1 there?", "Yes."]


@pytest.mark.parametrize(("text", "want"), [("One. Two. Three. Four.", "One. Two. Three."), ("", ""), ("word " * 20, "word word word word word word…"), ("Short one. " + "long " * 9 + ".", "Short one."), ("no end here", "no end here")])
def test_trim(spark, text, want):
    assert one(spark, prose.trim(F.col("t"), 3, 30), t=text) == want


def test_what_is_no_description(spark):
    flags = [(one(spark, prose.is_legalese(F.col("t")), t=t), one(spark, prose.is_role_copy(F.col("t")), t=t)) for t in ("We are an equal opportunity employer.", "x" * 300 + " We use e-verify.", "x" * 300 + " We use e-verify and a drug-free workplace.", "About the role: weld.", "Acme makes mills.", None)]
    assert flags == [(True, False), (False, False), (True, False), (False, True), (False, False), (False, False)]
    names = [one(spark, prose.mentions_name("t", "n"), t="At Nestlé Nordics we bake bread.", n=n) for n in ("Nestle Foods", "nordics", "Bake Off", "Ax", "", None)]
    assert names == [True, True, True, False, False, False]
    good = "Blue Harbor builds quiet machines for large kitchens."
    assert [one(spark, prose.acceptable(F.col("t"), F.col("n")), t=t, n="Blue Harbor Ltd") for t in (good, "Blue Harbor.", "We are hiring at Blue Harbor, and more and more of it.")] == [True, False, False]


def test_page_description(spark):
    long = "A maker of mills and of many other machines since 1990"
    pages = {
        f"<META content='{long}' NAME='description'><meta property=og:description content=\"short\">": long,
        f'<meta name="description" content="other text that is long enough to be taken"><meta property="og:description" content="{long} &amp;amp; Co">': f"{long} & Co",
        f'<script type="application/ld+json">{{"@graph":[{{"@type":"WebSite","description":"{long} no"}},{{"@type":["Corporation"],"description":"{long}"}}]}}</script>': long,
        "<p>nothing</p>": None,
    }
    assert {p: one(spark, prose.page_description(F.col("h")), h=p) for p in pages} == pages


@pytest.mark.parametrize(("text", "want"), [
    ("<p>Build <b>mills</b>.</p><ul><li>one</li><li>two</li></ul>", "Build **mills**.\n\n- one\n- two"),
    ("See https://a.example/x, or mail me@a.example.", "See <https://a.example/x>, or mail <me@a.example>."),
    ('<a href="https://a.example">here</a> &amp; there', "[here](https://a.example) & there"),
    ("plain", "plain"), ("  ", None), (None, None),
])
def test_plain(spark, text, want):
    assert one(spark, prose.plain("t"), t=text) == want


def test_boards_of_tenants(spark):
    args = F.col("u"), F.col("a"), F.col("s")
    cases = [("https://acme-co.breezy.hr/p/1", "breezy", "acme-co", "https://acme-co.breezy.hr"), ("https://jobs.lever.co/acme/1?x", "lever", "acme", "https://jobs.lever.co/acme"), ("https://jobs.lever.co/other/1", "lever", "acme", None), ("https://acme.example/1", "lever", "acme", None)]
    assert [one(spark, prose.board_root(*args), u=u, a=a, s=s) for u, a, s, _ in cases] == [w for *_, w in cases]


def test_about_section(spark):
    report = "Table of contents. Item 1. Business Overview of the year. Blue Harbor designs and sells machines for kitchens. It is old. Item 2. Properties"
    assert one(spark, prose.about_section(F.col("t")), t=report) == "Blue Harbor designs and sells machines for kitchens."


def test_gazetteer(spark):
    countries = spark.createDataFrame([("germany", "DE"), ("de", "DE"), ("france", "FR"), ("fr", "FR"), ("us", "US"), ("usa", "US"), ("united states", "US"), ("zealand", "XX"), ("new zealand", "NZ")], "token string, country string")
    cities = spark.createDataFrame([("berlin", "DE", 52.5, 13.4, 3600), ("hamburg", "DE", 53.5, 10.0, 1800), ("paris", "FR", 48.8, 2.3, 2100), ("paris", "US", 33.6, -95.5, 25), ("boston", "US", 42.3, -71.0, 690), ("auckland", "NZ", -36.8, 174.7, 1400)], "name string, country string, lat double, lon double, population long")
    cases = {
        "Berlin, Germany": ("DE", 52.5, "city", False), "Paris": ("FR", 48.8, "city", False), "Paris, United States": (("US", 42.3, "country", False)),
        "DE (DE300)": ("DE", 52.5, "country", False), "Remote": (None, None, None, True), "Boston, MA 02110": ("US", 42.3, "city", False), "Somewhere, TX": ("US", 42.3, "admin1", False),
        "Somewhere, QC": ("CA", None, "admin1", False), "Nowhere at all": (None, None, None, False), "New Zealand / Zealand": ("NZ", -36.8, "country", False), "Hamburg (hybrid)": ("DE", 53.5, "city", False), "USA": ("US", 42.3, "country", False),
        "": (None, None, None, None), None: (None, None, None, None),
    }
    df = spark.createDataFrame([(k,) for k in cases] * 2, "place string")
    got = {r.place: (r.country, r.lat, r.precision, r.placeless) for r in gazetteer.resolved(df, "place", countries, cities).collect()}
    assert got == cases and gazetteer.resolved(df, "place", countries, cities).count() == 2 * len(cases)
