"""Queries over texts whose letters or blanks Spark and the SQL engine see differently; what is wanted is what the SQL says."""

import pytest
from pyspark.sql import functions as F

from rolemill.functions import classify, text
from rolemill.queries import QUERIES

#: The same first three words but for the first letter, which no key keeps, in texts of different lengths.
TWINS = {38: "ßa one two", 9: "éa one two three"}


def got(spark, tmp_path, name, texts):
    path = str(tmp_path)
    spark.createDataFrame([(i, t, "en") for i, t in texts.items()], "doc_id long, text string, lang string").write.parquet(f"{path}/documents.parquet")
    return sorted(map(tuple, QUERIES[name](spark, path).collect()))


def test_posting_keys(spark, tmp_path):
    found = got(spark, tmp_path, "posting_keys", {1: "ßa one", 2: "aŉ İx", 3: "ﬁ b"})
    assert [r[:3] for r in found] == [(1, "firmainc", "a one team"), (2, "firmainc", "a ix team"), (3, "firminc", "b team")]


@pytest.mark.parametrize("odd", ["ß", "ŉ", "ᾳ", "ᾀ", "ﬃ", "x", "ä", "\U00010d70", "é\U0001f600"])
def test_one_letter_makes_one(spark, odd):
    row = spark.createDataFrame([(f"a{odd}Σ",)], "t string").select(text.upper_each("t").alias("u"), text.lower_each("t").alias("l")).head()
    assert len(row.u) == len(row.l) == len(odd) + 2
    assert (row.u[0], row.u[-1], row.l[-1]) == ("A", "Σ", "σ")


def test_us_pay_cohort(spark, tmp_path):
    found = got(spark, tmp_path, "us_pay_cohort", {1: "ßa one", 37: "SSa one", 73: "ﬁ one"})
    assert [r[:3] for r in found] == [("lever", "Firm SS INC", 1), ("lever", "Firm ẞA INC", 1), ("lever", "Firm ﬁ  INC", 1)]


@pytest.mark.parametrize(("said", "want"), [("ſALARY RANGE: $100,000", True), ("ſalary range: $100,000", True), ("$100,000\v- $200,000", False), ("$100,000\n- $200,000", True)])
def test_pay_in_prose(spark, said, want):
    none = F.lit(None).cast("string")
    assert spark.createDataFrame([(said,)], "d string").select(classify.pay_disclosed(none, none, F.col("d")).alias("x")).head()["x"] == want


def test_dedup_exact_passes(spark, tmp_path):
    assert [r[:2] for r in got(spark, tmp_path, "dedup_exact_passes", {1: "ßa one", 3: "éa two"})] == [(1, "lever")]


@pytest.mark.parametrize(("title", "want"), [("A\vB", "a\vb"), (" A\tB\n", "a b"), ("A (b)\v(c)", "a (b)\v"), ("ΟΣ İ", "οσ i")])
def test_core_of_odd_titles(spark, title, want):
    assert spark.createDataFrame([(title,)], "t string").select(text.title_core("t").alias("x")).head()["x"] == want


def test_dedup_gated_pairs(spark, tmp_path):
    assert got(spark, tmp_path, "dedup_gated_pairs", TWINS) == [(38, 9)]


def test_publish_equal_keys(spark, tmp_path):
    assert [r[:2] for r in got(spark, tmp_path, "publish_equal_keys", TWINS)] == [(9, "greenhouse")]


def test_publish_where_ids_repeat(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([(1, "b one two", "en"), (1, "a one two", "fr")], "doc_id long, text string, lang string").write.parquet(f"{path}/documents.parquet")
    assert [tuple(r[:3]) for r in QUERIES["publish_equal_keys"](spark, path).collect()] == [(1, "lever", "FR")] * 2
