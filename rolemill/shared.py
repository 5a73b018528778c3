"""Tables and folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders made by this process, for clean().
_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a local folder is set that serves one machine; on a cluster that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="rolemill-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, tag: str) -> str:
    _made.append(f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}")
    return _made[-1]


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write a table into the shared folder and read it back: lineage ends there, and a lost executor loses nothing."""
    path = shared_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Has the driver collect its garbage. Spark drops shuffle files and broadcasts of finished jobs only when it does."""
    spark._jvm.System.gc()


def clean(spark: SparkSession) -> int:
    """Deletes the folders that this process has made, once nothing that was read from them is needed; how many there were."""
    gone = 0
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        gone += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return gone
