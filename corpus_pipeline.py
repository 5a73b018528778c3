"""The corpus pipeline: quality rules, exact deduplication, n-gram near-duplicates, source mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns of documents, but for
the last one, which returns the packed pieces. Between stages the rows are written as Parquet and read again.

Documents without a text fail the length rule and go. Near-duplicates share 80 of 100 shingles of five words. A document that
the mix takes twice is packed twice. Repeated rows, ties, very long texts, empty tables and further columns of documents are
treated as each stage's operator says; the columns that come in go out of all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rolemill.llm import exact_dedup, mixing, ngram_join, packing, quality_rules
from rolemill.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.passing(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.kept_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.representatives(docs, width=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs)


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("ngram_join", near), ("source_mixing", mix), ("best_fit_packing", pack)]

#: Best-fit packing and the closure of near-duplicate links aren't expressible in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
