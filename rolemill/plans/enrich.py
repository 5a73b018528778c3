"""Enrichment of postings: what rules can tell, merged with what the source said and what a model said before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemill.functions import classify
from rolemill.functions.places import country_of
from rolemill.functions.keys import content_hash, job_key
from rolemill.functions.text import present

#: Fields that a model could still answer when rules can't.
ANSWERABLE = ["seniority", "employment_type", "placement", "experience"]
THIN = 200


def rules(df: DataFrame) -> dict[str, Column]:
    return {
        "country_iso": F.nullif(country_of(F.col("location")), F.lit("")),
        "seniority": classify.seniority(),
        "employment_type": classify.employment_type("commitment", "title"),
        "placement": classify.placement("title", "location", "commitment"),
        "salary_period": classify.pay_period(F.col("salary_summary")),
        "salary_currency": classify.currency(F.col("salary_summary"), F.col("country_iso")),
        "experience": classify.experience_years(F.col("description")),
    }


def tier0(df: DataFrame, provider: list[str]) -> DataFrame:
    """Key, digest, value and source of each field; the provider's value wins where it gave one."""
    found = rules(df)
    fields = {}
    for name, value in found.items():
        given = present(F.col(name).cast("string")) if name in provider and name in df.columns else F.lit(None).cast("string")
        text = value.cast("string")
        fields[name] = F.coalesce(given, text)
        fields[f"{name}_source"] = F.when(given.isNotNull(), "provider").when(text.isNotNull(), "rules")
    out = df.select("seq", job_key(F.col("url")).alias("job_key"), content_hash().alias("content_hash"), *[c.alias(n) for n, c in fields.items()], (F.length("description") < THIN).alias("thin"))
    missing = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in ANSWERABLE]))
    return out.withColumn("unresolved", F.array_join(missing, ",")).withColumn("needs_model", (F.col("unresolved") != "") & ~F.col("thin"))


def merged(rows: DataFrame, answers: DataFrame, fields: list[str]) -> DataFrame:
    """Model answers by content digest fill what is null; placement alone is the model's first."""
    got = answers.select("content_hash", *[F.col(f).alias(f"__{f}") for f in fields])
    both = rows.join(got, "content_hash", "left")
    order = {f: (f"__{f}", f) if f == "placement" else (f, f"__{f}") for f in fields}
    return both.withColumns({f: F.coalesce(*pair) for f, pair in order.items()}).drop(*[f"__{f}" for f in fields])


def coverage(rows: DataFrame, fields: list[str]) -> DataFrame:
    """Rows by field and by the source of its value."""
    one = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f"{f}_source"), F.lit("none")).alias("source")) for f in fields])).alias("x")
    return rows.select(one).groupBy("x.field", "x.source").agg(F.count("*").alias("rows"))
