"""What runs leave behind: batches of model calls, what they cost, replayed answers, and pages that were fetched or not found."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemill.operators.groups import latest_of
from rolemill.operators.state import cached

#: States of a batch that nothing follows but its collection.
ENDED = ("completed", "failed", "cancelled", "expired")


def batches(records: DataFrame) -> DataFrame:
    """One row a batch from its records (batch_id, shard, status, at): the last status, when it was first seen and when it ended.

    completed_at is the time of the last record where that one ended the batch, as each record replaces the one before.
    """
    last = F.max_by(F.struct("shard", "status", "at"), F.struct("at", "status"))
    rows = records.groupBy("batch_id").agg(F.min("at").alias("submitted_at"), last.alias("x"))
    return rows.select("batch_id", "x.shard", "x.status", "submitted_at", F.when(F.col("x.status").isin(*ENDED), F.col("x.at")).alias("completed_at"))


def open_batches(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("status").isin(*ENDED, "collected"))


def shards_done(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("status").isin("collected", "completed")).select("shard").distinct()


def costs(entries: DataFrame, prices: DataFrame, batch_share: float = 0.5) -> DataFrame:
    """Calls, tokens and cost by stage and reported model, from prices in dollars for a million tokens; batched calls cost a share.

    An unknown model has no cost: null, not zero.
    """
    sums = entries.groupBy("stage", "model_id", "batched").agg(F.sum("calls").alias("calls"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"))
    priced = sums.join(prices, "model_id", "left")
    cost = (F.col("input_tokens") * F.col("input_price") + F.col("output_tokens") * F.col("output_price")) / 1e6 * F.when(F.col("batched"), batch_share).otherwise(1.0)
    return priced.withColumn("cost", cost).groupBy("stage", "model_id").agg(F.sum("calls").alias("calls"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.sum("cost").alias("cost_usd"))


def projected(sample: DataFrame, requests: int, input_price: float, output_price: float, output_tokens: int = 180, batch_share: float = 0.5) -> DataFrame:
    """What as many requests would cost at once and batched, at the mean number of tokens of a sample."""
    once = (F.avg("tokens") * input_price + F.lit(output_tokens) * output_price) * requests / 1e6
    return sample.agg(F.avg("tokens").alias("mean_tokens"), once.alias("sync_usd"), (once * batch_share).alias("batch_usd"))


def replayed(rows: DataFrame, cache: DataFrame, keys: list[str], schema: str, fields: list[str]) -> DataFrame:
    """rows with the fields of cached answers where a row has none of its own; what isn't cached or can't be read stays as it is."""
    held = cached(rows, cache, keys, "payload", schema)
    return held.withColumns({f: F.coalesce(F.col(f), F.col(f"payload.{f}")) for f in fields}).drop("payload", "hit")


def recovered(rows: DataFrame, tools: list[tuple[str, Column]], least: int = 200, steps: int = 3) -> DataFrame:
    """rows with the text of the first tool that gives enough of it, that tool's name, and how many were tried.

    tools: names and columns in the order of trying; steps of them at most.
    """
    usable = [(name, F.trim(F.coalesce(c, F.lit("")))) for name, c in tools[:steps]]
    found = [F.when(F.length(c) >= least, F.struct(F.lit(k + 1).alias("tried"), F.lit(name).alias("tool"), c.alias("text"))) for k, (name, c) in enumerate(usable)]
    none = F.struct(F.lit(len(usable)).alias("tried"), F.lit(None).cast("string").alias("tool"), F.lit(None).cast("string").alias("text"))
    return rows.withColumn("__r", F.coalesce(*found, none)).withColumns({"recovered": F.col("__r.text"), "tool": F.col("__r.tool"), "tried": F.col("__r.tried")}).drop("__r")


def run_summary(runs: DataFrame) -> DataFrame:
    """Of runs of the recovery loop: rows, mean number of tools tried, rows recovered, by tool."""
    return runs.groupBy("tool").agg(F.count("*").alias("rows"), F.avg("tried").alias("mean_tried"), F.count("recovered").alias("recovered"))


def to_fetch(wanted: DataFrame, crawled: DataFrame, keys: list[str]) -> DataFrame:
    """What has not been tried yet; pages that were not found are in crawled too, with nulls, and are not tried again."""
    return wanted.join(crawled.select(*keys).distinct(), keys, "left_anti")


def crawl_cache(before: DataFrame, fetched: DataFrame, keys: list[str], at: str) -> DataFrame:
    """The cache with what was fetched since; of several answers for a key the last one stays."""
    return latest_of(before.unionByName(fetched), keys, F.desc(at))


def each_once(rows: DataFrame, key: Column, *order: Column) -> DataFrame:
    """Rows of a run, each identity once, the first by order; rows without one stay."""
    keyed = rows.withColumn("__key", key)
    named = latest_of(keyed.where("__key IS NOT NULL AND __key <> ''"), ["__key"], *order)
    return named.unionByName(keyed.where("__key IS NULL OR __key = ''")).drop("__key")


class Registry:
    """Readers of boards by name, for adapters of one's own beside those of the table."""

    def __init__(self) -> None:
        self.found: dict[str, Callable[[DataFrame], DataFrame]] = {}

    def register(self, name: str) -> Callable:
        def keep(read: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
            if name in self.found:
                raise ValueError(f"{name} is registered already")
            self.found[name] = read
            return read

        return keep

    def get(self, name: str) -> Callable[[DataFrame], DataFrame]:
        return self.found[name]

    def names(self) -> list[str]:
        return sorted(self.found)
