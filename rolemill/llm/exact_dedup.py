"""Exact deduplication over keyed streaming state, in DataFrame functions and Structured Streaming only.

Every row's digest goes through a streaming aggregation whose state lives in RocksDB on disk and never expires. State
keeps, for each digest, the smallest (doc_id, locator), which names the row that stays and where its content lies, and the
number of rows. Partial sums come before the shuffle, so a group that holds a third of all rows arrives as a row a task.
State rows are appended to a table in the shared folder in each micro-batch; as minima and counts only move one way, the
latest state of a digest is their minimum and maximum, and a batch that is run twice changes nothing.

On hits, that is for digests with more than one row, full normalised texts are compared: rows are picked by a bitmap of
fixed size over the digests with hits, and the distinct texts of each digest are gathered with a partial aggregation.
Should two different texts share a digest, their rows are told apart by the text itself.

Texts are equal when they agree after each run of blanks, tabs and line ends becomes one blank. Nulls count as empty, so a
null and an empty text are copies. Of repeated rows with one doc_id, the first by locator stays; kept_documents() reads the
rows anew and keeps, of rows with one doc_id and one text, the one whose columns have the smallest digest. Null doc_ids sort
last. Very long texts are taken whole. An empty table gives an empty table; extra columns are carried by kept_documents(),
whatever they are called, and not read otherwise.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rolemill.llm.common import SPACE, shared_path, stored, text_of

#: Bits of the bitmap that marks digests with hits: 4 MB in 128 pieces at most, whatever the size of the corpus.
HIT_BITS = 1 << 22
PIECE_BITS = 32768
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",  # commits write what changed, not whole files
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each of many small stores holds disk ahead of use
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@contextmanager
def _held(spark: SparkSession, settings: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def digest_rows(docs: DataFrame, digest=sha256) -> DataFrame:
    """doc_id, digest and a locator of each row: its file and its place in the order of reading, fixed once stored."""
    rows = docs.select("doc_id", digest(normalised(text_of())).alias("digest"), F.input_file_name().alias("file"))
    return rows.select("doc_id", "digest", F.struct("file", F.monotonically_increasing_id().alias("at")).alias("locator"))


def keyed_state(rows: DataFrame) -> DataFrame:
    """The state of a stream or table of digest rows: first row (nulls last), locator, and number of rows of each digest."""
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "locator")
    return rows.groupBy("digest").agg(F.min(first).alias("first"), F.count("*").alias("group_size"))


def run_stream(spark: SparkSession, source: str, schema, state_dir: str, files_per_batch: int | None = None) -> DataFrame:
    """Take all files of source that state_dir hasn't seen through the keyed state; the state after them.

    state_dir lasts between calls: a later call with new files goes on where this one ended.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def append(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{state_dir}/state/batch={number}")

    with _held(spark, STREAM_SETTINGS):
        stream = keyed_state(reader.parquet(source)).writeStream.outputMode("update").option("checkpointLocation", f"{state_dir}/progress")
        stream.foreachBatch(append).trigger(availableNow=True).start().awaitTermination()
    shape = keyed_state(spark.createDataFrame([], schema)).schema
    changed = spark.read.schema(shape).option("recursiveFileLookup", "true").parquet(f"{state_dir}/state")
    return changed.groupBy("digest").agg(F.min("first").alias("first"), F.max("group_size").alias("group_size"))


def _hit_bit() -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(HIT_BITS))


def hit_texts(docs: DataFrame, state: DataFrame, digest=sha256) -> DataFrame:
    """The distinct normalised texts of each digest with hits, full bytes; a few digests without hits may be among them."""
    bits = state.where("group_size > 1").select(_hit_bit().alias("bit"))
    pieces = bits.groupBy((F.col("bit") / PIECE_BITS).cast("int").alias("piece")).agg(F.bitmap_construct_agg(F.col("bit") % PIECE_BITS).alias("bitmap"))
    rows = docs.select(normalised(text_of()).alias("norm")).withColumn("digest", digest(F.col("norm"))).withColumn("bit", _hit_bit())
    rows = rows.join(F.broadcast(pieces), (F.col("bit") / PIECE_BITS).cast("int") == F.col("piece"))  # 128 rows of 4 KB at most
    byte = F.conv(F.hex(F.substring("bitmap", ((F.col("bit") % PIECE_BITS) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    rows = rows.where(F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1)
    return rows.groupBy("digest").agg(F.collect_set("norm").alias("texts"))


def deduplicated(docs: DataFrame, digest=sha256, files_per_batch: int | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept and digest of each row of docs."""
    spark = docs.sparkSession
    spool, state_dir = shared_path(spark, "digests"), shared_path(spark, "dedup-state")
    plan = digest_rows(docs, digest)
    plan.write.parquet(spool)
    rows = spark.read.schema(plan.schema).parquet(spool)
    state = stored(run_stream(spark, spool, plan.schema, state_dir, files_per_batch), "dedup-final")
    clashes = stored(hit_texts(docs, state, digest).where(F.size("texts") > 1).select("digest", F.explode("texts").alias("norm")), "dedup-clashes")
    sound = rows.join(state, "digest")
    if not clashes.isEmpty():
        sound = sound.join(clashes.select("digest").distinct(), "digest", "left_anti")
    out = _decided(sound)
    if not clashes.isEmpty():
        out = out.unionByName(_told_apart(docs, clashes, digest))
    return out


def _decided(rows: DataFrame) -> DataFrame:
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("locator") == F.col("first.locator"))
    return rows.select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), "digest")


def _told_apart(docs: DataFrame, clashes: DataFrame, digest) -> DataFrame:
    """Rows whose digest several texts share, grouped by the text itself."""
    rows = docs.select("doc_id", normalised(text_of()).alias("norm"), F.struct(F.lit("").alias("file"), F.monotonically_increasing_id().alias("at")).alias("locator"))
    rows = stored(rows.withColumn("digest", digest(F.col("norm"))).join(clashes, ["digest", "norm"], "left_semi"), "dedup-told-apart")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "locator")
    groups = rows.groupBy("digest", "norm").agg(F.min(first).alias("first"), F.count("*").alias("group_size"))
    return _decided(rows.join(groups, ["digest", "norm"]))


def kept_documents(docs: DataFrame, digest=sha256) -> DataFrame:
    """One document of each group of equal texts, with all its columns."""
    every = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"), every.alias("every"), "doc_id", normalised(text_of()).alias("norm"))
    own = own.select("own", "every", "doc_id", digest(F.col("norm")).alias("digest"))
    decided = stored(deduplicated(docs, digest), "dedup-decided")
    kept = decided.where("kept").select(F.col("doc_id").alias("kept_id"), F.col("digest").alias("kept_digest"))
    held = own.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("digest") == F.col("kept_digest")), "left_semi")
    again = stored(decided.groupBy("doc_id", "digest").agg(F.count("*").alias("n"), F.max("kept").alias("k")).where("n > 1 AND k").select(F.col("doc_id").alias("again_id"), F.col("digest").alias("again_digest")), "dedup-again")
    if again.isEmpty():
        return held.select("own.*")
    same = F.col("doc_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again_digest"))
    first = held.join(again, same, "left_semi").groupBy("doc_id", "digest").agg(F.min_by("own", "every").alias("own"))
    return held.join(again, same, "left_anti").select("own.*").unionByName(first.select("own.*"))
