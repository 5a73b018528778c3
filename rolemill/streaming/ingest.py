"""Postings as a stream: each identity once, upserts by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolemill.operators.state import upserted


def once(stream: DataFrame, keys: list[str], event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """The first row of each identity; with an event time and a delay, state is let go after that delay."""
    if event_time and delay:
        return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
    return stream.dropDuplicates(keys)


def counted(stream: DataFrame, event_time: str, size: str, delay: str, *by: str) -> DataFrame:
    """Rows and values by window of event time; late rows beyond the delay are left out."""
    return stream.withWatermark(event_time, delay).groupBy(F.window(event_time, size), *by).agg(F.count("*").alias("rows"), F.sum("value").alias("value"))


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process all there is now, batch by batch, and stop; a later call goes on where this one ended."""
    stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each).trigger(availableNow=True).start().awaitTermination()


def upsert_into(spark: SparkSession, root: str, keys: list[str], *order) -> Callable[[DataFrame, int], None]:
    """A batch function that keeps a table under root: each batch writes the next version from the one before."""

    def each(batch: DataFrame, number: int) -> None:
        before = batch.limit(0) if number == 0 else spark.read.schema(batch.schema).parquet(f"{root}/version={number - 1}")
        upserted(before, batch, keys, *order).write.mode("overwrite").parquet(f"{root}/version={number}")

    return each
