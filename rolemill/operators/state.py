"""Tables that last between runs: first and last sightings, upserts, caches, incremental classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rolemill.functions.text import seen_key
from rolemill.operators.groups import latest_of


def stamped(snapshot: DataFrame, sightings: DataFrame, now: Column) -> DataFrame:
    """snapshot with first_seen_at, carried over by key where known, and last_seen_at."""
    rows = snapshot.withColumn("seen_key", seen_key())
    before = sightings.groupBy(F.col("seen_key").alias("__key")).agg(F.min("first_seen_at").alias("__first"))
    rows = rows.join(before, F.col("seen_key") == F.col("__key"), "left")
    return rows.withColumns({"first_seen_at": F.coalesce("__first", now), "last_seen_at": now}).drop("__key", "__first")


def sightings_of(stamped_rows: DataFrame) -> DataFrame:
    """State for the next run; keys that are gone are forgotten, so that a posting that returns starts anew."""
    return stamped_rows.where("seen_key <> ''").groupBy("seen_key").agg(F.min("first_seen_at").alias("first_seen_at"))


def read_sightings(spark: SparkSession, path: str) -> DataFrame:
    """The state, or an empty one where it is missing or has another shape."""
    empty = spark.createDataFrame([], "seen_key string, first_seen_at timestamp")
    try:
        found = spark.read.parquet(path)
    except Exception:  # noqa: BLE001 - whatever can't be read counts as no state
        return empty
    return found if {"seen_key", "first_seen_at"} <= set(found.columns) else empty


def upserted(existing: DataFrame, incoming: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """Rows of incoming, one a key by order, in place of those that existing has for their keys."""
    fresh = latest_of(incoming, keys, *order)
    return existing.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh)


def inserted(existing: DataFrame, incoming: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """existing, and rows of incoming whose key it lacks."""
    return existing.unionByName(latest_of(incoming.join(existing.select(*keys), keys, "left_anti"), keys, *order))


def merged(existing: DataFrame, incoming: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Field by field the incoming value if there is one, else the existing one."""
    left = existing.select(*keys, *[F.col(c).alias(f"__old_{c}") for c in fields])
    return left.join(incoming.select(*keys, *fields), keys, "full").select(*keys, *[F.coalesce(c, f"__old_{c}").alias(c) for c in fields])


def longer_wins(cached: Column, fresh: Column) -> Column:
    """The longer text; the fresh one where they are as long."""
    return F.when(F.length(cached) > F.coalesce(F.length(fresh), F.lit(0)), cached).otherwise(fresh)


def classified(rows: DataFrame, state: DataFrame, version: int, prompt: Column | None = None) -> DataFrame:
    """Each row as new, changed, stale or unchanged against state: job_key, content_hash, version, prompt_hash."""
    old = state.select(F.col("job_key"), F.col("content_hash").alias("__hash"), F.col("version").alias("__version"), F.col("prompt_hash").alias("__prompt"))
    other_prompt = F.lit(False) if prompt is None else ~F.col("__prompt").eqNullSafe(prompt)
    kind = F.when(F.col("__hash").isNull(), "new").when(F.col("__hash") != F.col("content_hash"), "changed").when((F.col("__version") < version) | other_prompt, "stale").otherwise("unchanged")
    return rows.join(old, "job_key", "left").withColumn("delta", kind).drop("__hash", "__version", "__prompt")


def delta_counts(classified_rows: DataFrame) -> DataFrame:
    counts = classified_rows.groupBy("delta").agg(F.count("*").alias("rows"))
    return counts.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy()))


def cached(requests: DataFrame, cache: DataFrame, keys: list[str], payload: str, schema: str) -> DataFrame:
    """requests with the cached payload as a struct; what can't be decoded is a miss."""
    found = cache.select(*keys, F.from_json(payload, schema, {"mode": "PERMISSIVE"}).alias("payload"))
    return requests.join(latest_of(found, keys, F.col("payload").isNull()), keys, "left").withColumn("hit", F.col("payload").isNotNull())


def first_cached(rows: DataFrame, cache: DataFrame, keys: list[Column], value: str) -> DataFrame:
    """rows with the cached value under the first of several keys that has one; cache: key and the value. Blank keys find nothing."""
    tried = F.filter(F.array(*[F.struct(F.lit(k).alias("rank"), c.alias("key")) for k, c in enumerate(keys)]), lambda x: x["key"] != "")
    named = rows.withColumn("__row", F.monotonically_increasing_id()).withColumn("__tried", tried)
    named = named.select("*", F.explode_outer("__tried").alias("__t")).drop("__tried")
    one = cache.groupBy(F.col("key").alias("__key")).agg(F.max(value).alias("__value"))
    found = named.join(one, F.col("__t.key") == F.col("__key"), "left")
    best = found.groupBy("__row").agg(F.min(F.when(F.col("__value").isNotNull(), F.struct(F.col("__t.rank").alias("rank"), F.col("__value").alias("value"))))["value"].alias(value), F.first(F.struct(*rows.columns)).alias("__own"))
    return best.select("__own.*", value)


def filled_blanks(df: DataFrame, cached: dict[str, Column]) -> DataFrame:
    """Columns with what is cached where they are blank; what is there stays."""
    return df.withColumns({c: F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).cast(dict(df.dtypes)[c]), v) for c, v in cached.items()})


def look_capped(df: DataFrame, text: str, cap: int) -> bool:
    """Whether texts seem to have been cut: some are there, and none is longer than the cap."""
    r = df.agg(F.count_if(F.length(text) > 0).alias("n"), F.max(F.length(text)).alias("longest")).head()
    return bool(r["n"]) and r["longest"] <= cap
