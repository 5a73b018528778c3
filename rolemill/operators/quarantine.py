"""Gates that a posting must pass; the first that fails names the reason."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemill.functions import fixed
from rolemill.functions.text import BLANKS
from rolemill.operators.listings import lookup


def future_posted(now: str, posted_at="posted_at") -> Column:
    return F.try_to_timestamp(F.col(posted_at).cast("string")) > F.lit(now).cast("timestamp") + F.expr("INTERVAL 2 DAYS")


def implausible_pay(df: DataFrame) -> Column:
    amounts = [F.col(c).try_cast("double") for c in ("salary_min", "salary_max") if c in df.columns]
    amount = F.greatest(*amounts) if len(amounts) > 1 else amounts[0]
    return amount > lookup(F.upper("salary_period"), fixed.PAY_CEILING) * lookup(F.upper("salary_currency"), fixed.UNITS_PER_DOLLAR, 1.0)


def contradicted_period() -> Column:
    """The summary speaks of another period, and not of the declared one."""
    said = {p: F.col("salary_summary").rlike(words) for p, words in fixed.PERIOD_WORDS.items()}
    wrong = [(F.upper("salary_period") == p) & ~said[p] & reduce(lambda a, b: a | b, [x for q, x in said.items() if q != p]) for p in said]
    return reduce(lambda a, b: a | b, wrong)


def placeholder_employer(company="company") -> Column:
    name = F.lower(F.trim(F.col(company).cast("string"), F.lit(BLANKS)))
    return name.isin(fixed.PLACEHOLDER_EMPLOYERS) | name.rlike(fixed.HOSTNAME)


def reason(df: DataFrame, now: str) -> Column:
    """Why a row must not be published, else null; a check whose columns are missing is skipped."""
    have, checks = set(df.columns), []
    if "posted_at" in have:
        checks.append((future_posted(now), "future_posted_at"))
    if {"salary_period", "salary_currency"} <= have and have & {"salary_min", "salary_max"}:
        checks.append((implausible_pay(df), "implausible_salary"))
    if {"salary_period", "salary_summary"} <= have:
        checks.append((contradicted_period(), "contradicted_salary_period"))
    if "company" in have:
        checks.append((placeholder_employer(), "placeholder_employer"))
    return F.coalesce(*[F.when(c, name) for c, name in checks], F.lit(None).cast("string"))


def split(df: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """Rows to publish, and rejected rows with their reason; both filter one tagged plan."""
    tagged = df.withColumn("quarantine_reason", reason(df, now))
    return tagged.where("quarantine_reason IS NULL").drop("quarantine_reason"), tagged.where("quarantine_reason IS NOT NULL")
