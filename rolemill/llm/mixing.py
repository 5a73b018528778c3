"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

A source's target is its weighted share of the whole mix, held to a number of epochs of its own size; what a held source
can't take is reshared among the others by weight. Whole epochs of a source come first. The rest of its target is a
weighted sample without replacement: each document draws an exponential key divided by its quality weight, documents
are sorted by key within their source, and sizes are summed up to the remaining budget.

No source is sorted in one task. Keys are dealt to bands between quantiles of all keys, so that a band holds about one row
of BANDS whatever the weights are; band totals give the band in which a source's budget runs out, and only the rows of
that band are put in order. The quantiles come from sketches of fixed size, and only decide how the work is dealt.

Sizes are words. Null texts have none. A null source is a source of its own, the last one. Draws depend on doc_id alone,
so reruns agree; ties in the key go by doc_id, then by a digest of the row, then by the place of reading. Repeated rows are
documents of their own: as many of them enter as the budget has room for, and rows that differ in nothing can stand in for
each other. Very long texts are counted whole. Extra columns are carried by mixed(), also those named as its own are, and
not read otherwise. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolemill.llm.common import stored, text_of, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
BANDS = 4096


def quality_weight(text: Column) -> Column:
    """Between 0.1 and 1: texts with many symbols for their length are drawn later."""
    symbols = F.regexp_count(text, F.lit("[#*$%&|<>]"))
    return F.greatest(F.lit(0.1), F.lit(1.0) - F.lit(10.0) * symbols / F.greatest(F.length(text), F.lit(1)))


def uniform(doc_id: Column) -> Column:
    """A draw between 0 and 1, without both, from the digest of doc_id."""
    return (F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size and target from one row a source.

    Held sources are those with the least cap for their weight: in that order, a source is held if the level that the
    rest would get, were all before it held, reaches its own cap.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight.cast("double")).withColumn("cap", F.col("source_size").cast("double") * epochs)
    rank = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    every = Window.partitionBy()
    before = rank.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({
        "total": F.sum("source_size").over(every).cast("double") * share,
        "caps_before": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "weight_left": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    })
    level = (F.col("total") - F.col("caps_before")) / F.col("weight_left")
    rows = rows.withColumn("free", F.when(level * F.col("weight") <= F.col("cap"), F.struct("caps_before", level.alias("level"))))
    rows = rows.withColumn("level", F.min("free").over(every)["level"])
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("level") * F.col("weight"), F.col("cap")))
    return rows.select("source", "source_size", target.alias("target"))


def keyed(docs: DataFrame, *carried: str) -> DataFrame:
    """doc_id, source, size, key and what tells rows apart, stored, for each row of docs; and the columns carried."""
    weight = quality_weight(text_of())
    every = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select("doc_id", "source", word_count(text_of()).alias("size"), (-F.log(uniform(F.col("doc_id"))) / weight).alias("key"), every.alias("digest"), F.monotonically_increasing_id().alias("at"), *carried)
    return stored(rows, "mix-rows")


def banded(rows: DataFrame, bands: int = BANDS) -> DataFrame:
    """rows with band: how many of the quantiles of all keys are not above a row's key. bands: a power of two."""
    found = rows.agg(F.percentile_approx("key", [k / bands for k in range(1, bands)], 4 * bands).alias("q")).head()["q"]
    if not found:
        return rows.withColumn("band", F.lit(0))
    edges, steps = F.array(*[F.lit(float(x)) for x in found]), F.array(*[F.lit(1 << k) for k in reversed(range(bands.bit_length() - 1))])
    band = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.element_at(edges, at + step) <= F.col("key"), at + step).otherwise(at))
    return rows.withColumn("band", band)


def _order() -> list[Column]:
    return [F.col(c) for c in ("key", "doc_id", "digest", "at")]


def plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """One row a source: mix_source, source_size, target, whole epochs, and the band and last row that the rest reaches.

    rows: what keyed() gives of every document, with band.
    """
    totals = stored(rows.groupBy("source", "band").agg(F.sum("size").alias("band_size")), "mix-bands")
    goals = targets(totals.groupBy("source").agg(F.sum("band_size").alias("source_size")), weights, share, epochs)
    goals = goals.withColumn("epochs", F.when(F.col("source_size") > 0, F.least(F.lit(epochs), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("long"))
    goals = goals.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")).withColumnRenamed("source", "mix_source")
    before = F.sum("band_size").over(Window.partitionBy("source").orderBy("band").rowsBetween(Window.unboundedPreceding, -1))
    at = totals.withColumn("before", F.coalesce(before, F.lit(0)))
    full = at.join(goals, F.col("source").eqNullSafe(F.col("mix_source"))).where(F.col("before") + F.col("band_size") > F.col("budget"))
    cut = full.groupBy("mix_source", "source_size", "target", "epochs", "budget").agg(F.min(F.struct(F.col("band").alias("cut_band"), "before")).alias("cut"))
    cut = stored(cut.select("mix_source", "source_size", "target", "epochs", "budget", "cut.cut_band", "cut.before"), "mix-cuts")
    edge = rows.join(cut, F.col("source").eqNullSafe(F.col("mix_source")) & (F.col("band") == F.col("cut_band")))
    up_to = Window.partitionBy("mix_source").orderBy(*_order()).rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.withColumn("start", F.col("before") + F.coalesce(F.sum("size").over(up_to), F.lit(0)))
    enters = (F.col("start") < F.col("budget")) & (F.col("start") + F.col("size") / 2 <= F.col("budget"))  # the last one if that comes nearer
    last = edge.where(enters).groupBy("mix_source").agg(F.max(F.struct(*_order())).alias("last")).withColumnRenamed("mix_source", "s")
    rest = goals.join(cut.select(F.col("mix_source").alias("c"), "cut_band"), F.col("mix_source").eqNullSafe(F.col("c")), "left")
    out = rest.join(last, F.col("mix_source").eqNullSafe(F.col("s")), "left")
    return stored(out.select("mix_source", "source_size", "target", "epochs", "cut_band", "last"), "mix-plan")


def decided(rows: DataFrame, plan: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """rows with copies, the number of times each is taken."""
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("mix_source")))
    inside = F.coalesce(F.struct(*_order()) <= F.col("last"), F.lit(False))
    chosen = F.when(F.col("cut_band").isNull(), 0).when(F.col("band") < F.col("cut_band"), 1).when((F.col("band") == F.col("cut_band")) & inside, 1).otherwise(0)
    return rows.withColumn("copies", F.least(F.col("epochs") + chosen, F.lit(epochs)).cast("long"))


def drawn(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of each row."""
    rows = banded(keyed(docs.select("doc_id", "source", "text")))
    return decided(rows, plan(rows)).select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: each document with its own columns, as many times as it is taken."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    rows = banded(keyed(docs.select("doc_id", "source", "text", own), "own"))
    out = decided(rows, plan(rows)).where("copies > 0")
    return out.select("own", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("own.*")
