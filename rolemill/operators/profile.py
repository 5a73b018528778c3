"""Coverage, savings, quantiles and scores of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemill.functions.text import present, squeezed


def blank_share(c: str) -> Column:
    return F.avg(F.when(present(F.col(c).cast("string")).isNull(), 1.0).otherwise(0.0))


def gaps(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """Rows, and the share of blank values of each column, over the table or by group."""
    return df.groupBy(*by).agg(F.count("*").alias("rows"), *[blank_share(c).alias(f"{c}_blank") for c in columns])


def lengths(df: DataFrame, c: str) -> DataFrame:
    n = F.length(F.col(c))
    return df.where(F.col(c).isNotNull()).agg(F.median(n).alias("median"), F.percentile(n, 0.9).alias("p90"), F.max(n).alias("longest"))


def dedup_savings(df: DataFrame, title="title", body="description", location="location") -> DataFrame:
    """How many distinct postings, bodies and body-location pairs there are, and the share of bodies spared."""
    def digest(*cs: str) -> Column:
        return F.md5(F.concat_ws("\0", *[F.lower(squeezed(c)) for c in cs]))

    counts = df.where(present(body).isNotNull()).agg(F.count("*").alias("rows"), F.countDistinct(digest(title, body)).alias("postings"), F.countDistinct(digest(body)).alias("bodies"), F.countDistinct(digest(title, body, location)).alias("placed"))
    return counts.withColumn("saved", 1 - F.try_divide(F.col("postings"), F.col("rows")))


def evaluated(labels: DataFrame, predictions: DataFrame, key: str, fields: list[str], by: list[str] = ()) -> DataFrame:
    """Per field: hits, wrong, missed, over-claimed and rightly abstained, with recall, precision and the over-claim share.

    A null label says that nothing may be claimed. Ratios without a denominator are null.
    """
    pairs = labels.select(key, *by, *[F.col(f).alias(f"__want_{f}") for f in fields]).join(predictions.select(key, *fields), key, "left")
    one = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"__want_{f}").cast("string").alias("want"), F.col(f).cast("string").alias("got")) for f in fields])).alias("x")
    rows = pairs.select(*by, one).select(*by, "x.field", "x.want", "x.got")
    want, got, same = F.col("want").isNotNull(), F.col("got").isNotNull(), F.upper("want") == F.upper("got")
    sums = rows.groupBy(*by, "field").agg(F.count_if(want & got & same).alias("hit"), F.count_if(want & got & ~same).alias("wrong"), F.count_if(want & ~got).alias("missed"), F.count_if(~want & got).alias("over_claimed"), F.count_if(~want & ~got).alias("correct_abstain"))
    return sums.withColumns({
        "recall": F.try_divide(F.col("hit"), F.col("hit") + F.col("wrong") + F.col("missed")),
        "precision": F.try_divide(F.col("hit"), F.col("hit") + F.col("wrong") + F.col("over_claimed")),
        "over_claim": F.try_divide(F.col("over_claimed"), F.col("over_claimed") + F.col("correct_abstain")),
    })


def compared(want: Column, got: Column, kind: str = "text", slack: float = 0.0) -> Column:
    """hit, near, wrong, missed, over_claimed or correct_abstain for a label and a prediction.

    kind: text (capitals don't matter), money (equal within a share of slack) or number (near within slack).
    """
    if kind == "text":
        same, near = F.upper(want.cast("string")) == F.upper(got.cast("string")), F.lit(False)
    elif kind == "money":
        same, near = F.abs(want.cast("double") - got.cast("double")) <= F.abs(want.cast("double")) * slack, F.lit(False)
    else:
        same, near = want == got, F.abs(want - got) <= slack
    both = want.isNotNull() & got.isNotNull()
    return F.when(both & same, "hit").when(both & near, "near").when(both, "wrong").when(want.isNotNull(), "missed").when(got.isNotNull(), "over_claimed").otherwise("correct_abstain")


def graded(pairs: DataFrame, fields: dict[str, tuple[str, float]], by: list[str] = ()) -> DataFrame:
    """Rows by field (and slice) and outcome; pairs has want_<field> and got_<field>, fields their kinds and slacks."""
    one = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), compared(F.col(f"want_{f}"), F.col(f"got_{f}"), *kind).alias("outcome")) for f, kind in fields.items()])).alias("x")
    return pairs.select(*by, one).groupBy(*by, F.col("x.field").alias("field"), F.col("x.outcome").alias("outcome")).agg(F.count("*").alias("rows"))


def flag_counts(df: DataFrame, flags: str) -> DataFrame:
    """How often each flag of a comma-separated list is set."""
    return df.select(F.explode(F.split(flags, ",")).alias("flag")).where("flag <> ''").groupBy("flag").agg(F.count("*").alias("rows"))


def flags_of(**conditions: Column) -> Column:
    """Names of the true conditions, in order, comma-separated; empty where none is."""
    return F.concat_ws(",", *[F.when(c, name) for name, c in conditions.items()])
