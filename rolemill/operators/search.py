"""Search over postings: literal text, flags that may be unknown, ranges; and ranked lookup of companies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def holds(column: str, text: str) -> Column:
    """Whether the column has the text, in any case; nothing is a pattern and nulls never match."""
    return F.coalesce(F.contains(F.lower(F.col(column)), F.lit(text.lower())), F.lit(False))


def search(df: DataFrame, query=None, location=None, company=None, ats=None, remote=None, salary_min=None, salary_max=None, experience_max=None, limit=None, order="seq") -> DataFrame:
    """Rows that pass every filter given; a filter on a column that df lacks is skipped, but remote then reads the location."""
    have = set(df.columns)
    for column, text in (("title", query), ("location", location), ("company", company)):
        if text is not None and column in have:
            df = df.where(holds(column, text))
    if ats is not None:
        df = df.where(F.col("ats_type") == ats)
    if remote is not None:
        by_place = holds("location", "remote") if "location" in have else F.lit(False)
        if "is_remote" in have:
            df = df.where(F.coalesce(F.col("is_remote"), by_place) if remote else F.col("is_remote").eqNullSafe(False))
        else:
            df = df.where(by_place if remote else ~by_place)
    if salary_min is not None and "salary_max" in have:
        df = df.where(F.coalesce(F.col("salary_max"), F.lit(0.0)) >= salary_min)
    if salary_max is not None and "salary_min" in have:
        df = df.where(F.coalesce(F.col("salary_min"), F.lit(float("inf"))) <= salary_max)
    if experience_max is not None and "experience" in have:
        df = df.where(F.coalesce(F.col("experience"), F.lit(0)) <= experience_max)
    return df if limit is None else df.orderBy(order).limit(limit)


def load(df: DataFrame, ats=None, date=None) -> DataFrame:
    """A slice by source or by date, not both; over a table partitioned by source that prunes files."""
    if ats is not None and date is not None:
        raise ValueError("ats and date exclude each other")
    if ats is not None:
        return df.where(F.col("ats_type") == ats)
    return df if date is None else df.where(F.to_date("posted_at") == F.lit(date).cast("date"))


def find_company(companies: DataFrame, text: str, limit: int = 10, order: str = "seq") -> DataFrame:
    """Companies whose name or slug has the text: equal slugs first, then equal names, then the others in their order."""
    q = text.strip().lower()
    rank = 2 * (F.lower("slug") != q).cast("int") + (F.lower("name") != q).cast("int")
    return companies.where(holds("name", q) | holds("slug", q)).withColumn("rank", rank).orderBy("rank", order).limit(limit)
