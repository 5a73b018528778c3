"""Building blocks: group facts beside each row, first and latest rows of groups, in forms that bear skew.

A window over a key sorts all of a key's rows in one task. These helpers aggregate first, with partial sums before the
shuffle, and join the facts back, which Spark can split where a key is hot. Order columns must make a total order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_group(df: DataFrame, keys: list[str], **facts: Column) -> DataFrame:
    """df with aggregates of each row's group beside it; null keys are groups of their own."""
    names = [f"__key{i}" for i in range(len(keys))]
    sums = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).agg(*[c.alias(n) for n, c in facts.items()])
    on = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)]
    return df.join(sums, on).drop(*names)


def first_of(df: DataFrame, keys: list[str], order: list[str], valid: Column | None = None) -> DataFrame:
    """One row a group, the first by order and then by its other columns; rows that aren't valid all stay, in no group."""
    valid = F.lit(True) if valid is None else F.coalesce(valid, F.lit(False))
    whole = F.struct(*order, *[c for c in df.columns if c not in order])
    firsts = df.where(valid).groupBy(*keys).agg(F.min(whole).alias("__first"))
    return firsts.select(*[F.col("__first")[c].alias(c) for c in df.columns]).unionByName(df.where(~valid))


def latest_of(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row a group, first by the given sort expressions."""
    ranked = df.withColumn("__place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("__place = 1").drop("__place")


def top_n(df: DataFrame, keys: list[str], n: int, *order: Column) -> DataFrame:
    """The first n rows of each group, with their place."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= n)


def exact_sample(df: DataFrame, n: int, identity: Column, seed: int = 0) -> DataFrame:
    """n rows, the same ones on every run, by the order of a digest of identity and seed."""
    return df.orderBy(F.md5(F.concat_ws("|", identity.cast("string"), F.lit(str(seed)))), identity).limit(n)


def stratified(df: DataFrame, stratum: str, n: int, identity: Column, seed: int = 0) -> DataFrame:
    """Up to n rows of each stratum, in the order of a digest."""
    return top_n(df, [stratum], n, F.md5(F.concat_ws("|", identity.cast("string"), F.lit(str(seed)))), identity).drop("place")


def mode(df: DataFrame, keys: list[str], value: str, least: int = 2) -> DataFrame:
    """The commonest value of each group if it occurs at least so often; ties go to the smallest value."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("times"))
    best = counted.groupBy(*keys).agg(F.min(F.struct((-F.col("times")).alias("less"), F.col(value).alias("value"))).alias("best"))
    return best.select(*keys, F.col("best.value").alias("mode"), (-F.col("best.less")).alias("times")).where(F.col("times") >= least)


def latest_period_max(df: DataFrame, key: str, period: str, value: str) -> DataFrame:
    """The largest value within each key's newest period, never a sum over periods."""
    newest = df.groupBy(key, period).agg(F.max(value).alias("value"))
    return newest.groupBy(key).agg(F.max(F.struct(F.col(period).alias("period"), "value")).alias("x")).select(key, F.col("x.period").alias(period), F.col("x.value").alias(value))


def within_fan_out(df: DataFrame, key: str, most: int) -> DataFrame:
    """Rows whose key has no more than so many rows; a key beyond that blocks nothing."""
    held = df.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") <= most).select(key)
    return df.join(held, key, "left_semi")


def on_any_key(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], left_id: str, right_id: str) -> DataFrame:
    """Pairs that agree on at least one of the key columns: one equi-join a key, never a disjunction."""
    found = None
    for a, b in pairs:
        one = left.select(F.col(left_id), F.col(a).alias("__k")).join(right.select(F.col(right_id), F.col(b).alias("__k")), "__k").select(left_id, right_id)
        found = one if found is None else found.unionByName(one)
    return found.distinct()


def best_strategy(parts: list[DataFrame], keys: list[str], *order: Column) -> DataFrame:
    """Rows of several joins, of which each key keeps the one from the first part that has it."""
    tagged = [p.withColumn("strategy", F.lit(i)) for i, p in enumerate(parts)]
    both = tagged[0]
    for p in tagged[1:]:
        both = both.unionByName(p, allowMissingColumns=True)
    return latest_of(both, keys, F.col("strategy"), *order)


def roots(df: DataFrame, node: str, parent: str, depth: int = 10) -> DataFrame:
    """Each node with the node that at most so many steps to the parent lead to."""
    own = df.select(F.col(node).alias("node"), F.col(parent).alias("root"))
    parents = own.select(F.col("node").alias("__n"), F.col("root").alias("__r")).where("__r IS NOT NULL")
    now = own.select("node", F.coalesce("root", "node").alias("root"))
    for _ in range(depth - 1):
        now = now.join(parents, F.col("root") == F.col("__n"), "left").select("node", F.coalesce("__r", "root").alias("root"))
    return now


def joined_once(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """left with the columns of right, a row a row: a key that right has twice is an error, not a second row."""
    rest = [c for c in right.columns if c not in keys]
    once = right.groupBy(*keys).agg(F.count("*").alias("__n"), F.min(F.struct(*rest)).alias("__r"))
    whole = left.join(once, keys, "left")
    sound = F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit("several rows for "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))).cast("int"))
    checked = whole.withColumn("__bad", sound).where("__bad IS NULL")
    return checked.select(*left.columns, *[F.col(f"__r.{c}").alias(c) for c in rest])


def samples(df: DataFrame, keys: list[str], text: str, order: str, most: int = 6, shortest: int = 400, longest: int = 20_000) -> DataFrame:
    """A few rows of each group whose texts are neither too short nor too long, by order."""
    fitting = df.where(F.length(text).between(shortest, longest))
    return top_n(fitting, keys, most, F.col(order)).drop("place")
