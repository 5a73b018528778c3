"""Companies: cohorts of tenants, matching against reference names, floors, funding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemill.functions.places import looks_us
from rolemill.functions.classify import pay_disclosed
from rolemill.functions.similarity import name_score_udf
from rolemill.operators.groups import latest_of, on_any_key, within_fan_out

REVIEW, ACCEPT, CERTAIN = 80.0, 92.0, 95.0
FAN_OUT = 200
#: Slack of a lower bound before it counts as contradicted, and of a head count before it is withdrawn.
FLOOR_SLACK, WITHDRAW = 1.15, 2.0


def us_paid(listings: DataFrame) -> DataFrame:
    return listings.where(looks_us(F.col("location"), F.col("country_iso")) & pay_disclosed(F.col("salary_min").cast("string"), F.col("salary_summary"), F.col("description")))


def cohort(listings: DataFrame) -> DataFrame:
    """One row a tenant: postings, remote ones, pay span and a sample."""
    return listings.groupBy("ats_type", "company").agg(F.count("*").alias("postings"), F.count_if(F.col("is_remote")).alias("remote"), F.min("salary_min").alias("pay_min"), F.max("salary_max").alias("pay_max"), F.min("url").alias("sample_url"))


def candidates(tenants: DataFrame, reference: DataFrame, keys: list[tuple[str, str]], tenant_id: str, ref_id: str) -> DataFrame:
    """Pairs that agree on a key; keys with too many reference rows block nothing."""
    found = None
    for a, b in keys:
        one = on_any_key(tenants.where(F.col(a) != ""), within_fan_out(reference.where(F.col(b) != ""), b, FAN_OUT), [(a, b)], tenant_id, ref_id)
        found = one if found is None else found.unionByName(one)
    return found.distinct()


def confidence(score: Column, name: Column) -> Column:
    """high needs a near-perfect score and a name of two words or more."""
    return F.when((score >= CERTAIN) & (F.size(F.split(F.trim(name), r"\s+")) > 1), "high").when(score >= ACCEPT, "medium").otherwise("low")


def matched(tenants: DataFrame, reference: DataFrame, keys: list[tuple[str, str]], tenant_id: str, ref_id: str, name: str, ref_name: str, size: str) -> DataFrame:
    """The best reference row of each tenant by score, then size, then id; scores below the review bar match nothing."""
    pairs = candidates(tenants, reference, keys, tenant_id, ref_id)
    named = pairs.join(tenants.select(tenant_id, F.col(name).alias("name")), tenant_id).join(reference.select(ref_id, F.col(ref_name).alias("ref_name"), F.col(size).alias("size")), ref_id)
    scores = named.select("name", "ref_name").distinct().withColumn("score", name_score_udf("name", "ref_name"))
    scored = named.join(scores, ["name", "ref_name"]).where(F.col("score") >= REVIEW)
    best = latest_of(scored, [tenant_id], F.desc("score"), F.desc_nulls_last("size"), F.col(ref_id))
    return best.withColumn("confidence", confidence(F.col("score"), F.col("name")))


def checked_floor(count: Column, floor: Column) -> Column:
    """Whether a head count stands against a known lower bound: agrees, contradicted, or withdrawn when far below."""
    return F.when(count.isNull() | floor.isNull(), None).when(count * FLOOR_SLACK >= floor, "agrees").when(count * WITHDRAW >= floor, "contradicted").otherwise("withdrawn")


def withheld(df: DataFrame, columns: list[str], when: Column) -> DataFrame:
    """The columns nulled, types kept, where the condition holds."""
    return df.withColumns({c: F.when(F.coalesce(when, F.lit(False)), F.lit(None).cast(dict(df.dtypes)[c])).otherwise(F.col(c)) for c in columns})


def funding(filings: DataFrame, key: str) -> DataFrame:
    """Roll-up of filings: totals, equity only, first and last date, the last amount, and all rounds by date."""
    equity = F.col("is_equity")
    return filings.groupBy(key).agg(
        F.count("*").alias("filings"), F.sum("amount").alias("total"), F.sum(F.when(equity, F.col("amount"))).alias("equity_total"), F.count_if(equity).alias("equity_rounds"),
        F.min("filed").alias("first_filed"), F.max("filed").alias("last_filed"), F.max_by("amount", F.struct("filed", "filing_id")).alias("last_amount"),
        F.array_sort(F.collect_list(F.struct("filed", "filing_id", "amount"))).alias("rounds"),
    )
