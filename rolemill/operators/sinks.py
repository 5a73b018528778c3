"""Writing tables: snapshots by source, guarded publishing with a manifest, line-delimited shards."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class EmptySliceError(ValueError):
    """A source that had rows would be replaced by nothing."""


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for sinks that hold none."""
    nested = {n for n, k in df.dtypes if k.startswith(("array", "struct", "map"))}
    return df.select(*[F.to_json(c).alias(c) if c in nested else F.col(c) for c in df.columns])


def counts_by(df: DataFrame, key: str = "ats_type") -> dict[str, int]:
    return {r[key]: r["n"] for r in df.groupBy(key).agg(F.count("*").alias("n")).collect()}


def guard(counts: dict[str, int], previous: dict, allow_empty: bool = False) -> None:
    gone = sorted(s for s, e in (previous.get("by_ats") or {}).items() if e.get("rows", 0) > 0 and not counts.get(s))
    if gone and not allow_empty:
        raise EmptySliceError(f"no rows for {', '.join(gone)}")


def manifest(counts: dict[str, int], path: str, previous: dict, generated_at: str) -> dict:
    """The new manifest; entries that this run doesn't own are kept, retired ones dropped."""
    kept = {k: v for k, v in previous.items() if k in ("companies", "by_ats_companies")}
    entries = {s: {"parquet": f"{path}/ats_type={s}", "rows": n} for s, n in sorted(counts.items())}
    return kept | {"version": "2.0", "generated_at": generated_at, "stats": {"total_jobs": sum(counts.values()), "ats_count": len(counts)}, "all": {"parquet": path, "rows": sum(counts.values())}, "by_ats": entries}


def publish(df: DataFrame, path: str, previous: dict | None = None, generated_at: str = "", allow_empty: bool = False) -> dict:
    """Write the snapshot by source, data first; returns the manifest, which a caller writes last."""
    counts = counts_by(df)
    guard(counts, previous or {}, allow_empty)
    df.write.mode("overwrite").option("compression", "zstd").partitionBy("ats_type").parquet(path)
    return manifest(counts, path, previous or {}, generated_at)


def read_manifest(text: str | None) -> dict:
    try:
        found = json.loads(text or "")
    except ValueError:
        return {}
    return found if isinstance(found, dict) else {}


def write_slices(df: DataFrame, path: str) -> None:
    """One folder of CSV a source, every column as text."""
    df.select("*", F.col("ats_type").alias("slice")).write.mode("overwrite").partitionBy("slice").option("header", True).option("escape", '"').option("nullValue", "").csv(path)


def _greedy(most_rows: int, most_bytes: int):
    """Shards in order: one ends before the row that would take it over a bound."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("order")
        sums = np.concatenate([[0], np.cumsum(rows.column("bytes").to_numpy())])
        shard, low, number = np.empty(len(rows), np.int64), 0, 0
        while low < len(rows):
            high = int(np.searchsorted(sums, sums[low] + most_bytes, "right")) - 1
            high = min(max(high, low + 1), low + most_rows, len(rows))  # a row above the bound has a shard of its own
            shard[low:high], low, number = number, high, number + 1
        return rows.append_column("shard", pa.array(shard)).select(["part", "order", "shard", "bytes"])

    return run


def sharded(df: DataFrame, order: str, text: str, most_rows: int, most_bytes: int, part_rows: int = 1 << 20) -> DataFrame:
    """part, shard and bytes for each row of df: no shard of a part has more rows or bytes than that, but for a row that alone has more.

    Shards are filled in order, each as far as it goes. That is done over ids and lengths, not texts, for parts of about
    part_rows rows, which are dealt by a hash of order; order is unique.
    """
    parts = max(1, -(-df.count() // part_rows))
    lengths = df.select(F.pmod(F.xxhash64(order), F.lit(parts)).alias("part"), F.col(order).alias("order"), (F.octet_length(text) + 1).cast("long").alias("bytes"))
    kind = df.schema[order].dataType.simpleString()
    found = lengths.groupBy("part").applyInArrow(_greedy(most_rows, most_bytes), f"part long, order {kind}, shard long, bytes long")
    return df.join(found, F.col(order) == F.col("order")).drop("order") if order != "order" else df.join(found, "order")


def write_lines(df: DataFrame, path: str, order: str, text: str, most_rows: int, most_bytes: int) -> None:
    """A folder a shard, with lines of text."""
    rows = sharded(df, order, text, most_rows, most_bytes)
    rows.select("part", "shard", F.col(text).alias("value")).repartition("part", "shard").write.partitionBy("part", "shard").text(path)


# ---- files: through Hadoop's file systems, so that any store will do ----

def _place(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, put in place by a rename, so that readers see the old one or the new one."""
    fs, new = _place(spark, f"{path}.new")
    out = fs.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    _, old = _place(spark, path)
    fs.delete(old, False)
    if not fs.rename(new, old):
        raise OSError(f"{path} could not be put in place")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file, or null where there is none."""
    fs, p = _place(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def pruned(spark: SparkSession, root: str, prefixes: list[str]) -> list[str]:
    """Deletes what earlier layouts left under root; the prefixes that were there. A second call finds nothing."""
    gone = []
    for prefix in prefixes:
        fs, p = _place(spark, f"{root}/{prefix}")
        if fs.exists(p) and fs.delete(p, True):
            gone.append(prefix)
    return gone


def artifacts(spark: SparkSession, path: str) -> DataFrame:
    """Path, bytes and SHA-256 of each file under path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def publish_all(df: DataFrame, root: str, generated_at: str, allow_empty: bool = False) -> dict:
    """Snapshots by source and as a whole, both as Parquet and as CSV, then the manifest, which names them.

    The manifest is read, changed and put in place last. A source that had rows and has none now stops all of it before a
    file is written. Each publication has a folder of its own, so that readers of the last one are not disturbed.
    """
    spark = df.sparkSession
    previous = read_manifest(read_text(spark, f"{root}/manifest.json"))
    counts = counts_by(df)
    guard(counts, previous, allow_empty)
    home = f"{root}/run={sum(ord(c) * 31 ** (k % 9) for k, c in enumerate(generated_at)):x}"
    text = flat(df).select("*", F.col("ats_type").alias("slice"))
    df.write.mode("overwrite").option("compression", "zstd").partitionBy("ats_type").parquet(f"{home}/parquet")
    text.write.mode("overwrite").partitionBy("slice").option("header", True).option("escape", '"').option("nullValue", "").csv(f"{home}/csv")
    made = manifest(counts, f"{home}/parquet", previous, generated_at)
    made["all"] |= {"csv": f"{home}/csv"}
    for source, entry in made["by_ats"].items():
        entry |= {"csv": f"{home}/csv/slice={source}"}
    sizes = artifacts(spark, home).select(F.regexp_extract("path", r"/(?:ats_type|slice)=([^/]+)/", 1).alias("s"), "bytes").groupBy("s").agg(F.sum("bytes").alias("bytes"))
    for r in sizes.collect():  # a row a source
        if r["s"] in made["by_ats"]:
            made["by_ats"][r["s"]] |= {"size_bytes": r["bytes"]}
    write_text(spark, f"{root}/manifest.json", json.dumps(made, indent=2, sort_keys=True))
    return made


# ---- what stops a run, ledgers, reports ----

def run_verdict(counts: dict[str, int], policy: dict[str, bool], streaming: bool = False) -> str:
    """publish, or why not: streaming_failed, empty, shards_failed, failed.

    counts: targets, rows, and targets that ended in error, not_found or were omitted. Policies, as flags: fail_closed_on_empty,
    _on_any_error (omitted ones count) and _on_not_found. Whatever they say, a run without rows in which half of all targets
    or more failed publishes nothing.
    """
    targets, rows, error = counts.get("targets", 0), counts.get("rows", 0), counts.get("error", 0)
    if streaming and error:
        return "streaming_failed"
    if policy.get("fail_closed_on_empty") and targets and not rows:
        return "empty"
    shards = (error + counts.get("omitted", 0) if policy.get("fail_closed_on_any_error") else 0) + (counts.get("not_found", 0) if policy.get("fail_closed_on_not_found") else 0)
    if shards:
        return "shards_failed"
    return "failed" if targets and not rows and error >= max(1, (targets + 1) // 2) else "publish"


def verdicts(runs: DataFrame, policies: DataFrame) -> DataFrame:
    """source and verdict from a row a target (source, status ok, error, not_found or omitted, rows) and a row of flags a source."""
    n = lambda s: F.count(F.when(F.col("status") == s, 1))
    totals = runs.groupBy("source").agg(F.count("*").alias("targets"), F.sum("rows").alias("found"), n("error").alias("error"), n("not_found").alias("missing"), n("omitted").alias("omitted"))
    t = totals.join(policies, "source", "left")
    on = lambda flag: F.coalesce(F.col(flag), F.lit(False))
    none = F.coalesce(F.col("found"), F.lit(0)) == 0
    shards = F.when(on("fail_closed_on_any_error"), F.col("error") + F.col("omitted")).otherwise(0) + F.when(on("fail_closed_on_not_found"), F.col("missing")).otherwise(0)
    half = F.col("error") >= F.greatest(F.lit(1), F.floor((F.col("targets") + 1) / 2))
    verdict = F.when(on("streaming") & (F.col("error") > 0), "streaming_failed").when(on("fail_closed_on_empty") & none, "empty").when(shards > 0, "shards_failed").when(none & half, "failed").otherwise("publish")
    return t.select("source", verdict.alias("verdict"))


def ledger(entries: DataFrame, last: int, *order: str) -> DataFrame:
    """Entries with sequence numbers that go on from last; they are appended, never changed."""
    by = Window.orderBy(*order)
    return entries.withColumn("sequence", F.row_number().over(by) + F.lit(last))


def report(df: DataFrame, title: str) -> str:
    """A table of a few rows as Markdown."""
    rows = df.collect()
    cell = lambda v: "" if v is None else f"{v:.4g}" if isinstance(v, float) else str(v).replace("|", "\\|")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns), *["| " + " | ".join(cell(r[c]) for c in df.columns) + " |" for r in rows]]
    return f"## {title}\n\n" + "\n".join(lines) + "\n"
