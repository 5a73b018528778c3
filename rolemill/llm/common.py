"""What several corpus operators need: reading tables, shared intermediate tables, small text rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rolemill.shared import release, shared_path, stored

__all__ = ["release", "shared_path", "stored"]
#: ASCII white space as the contracts spell it: blank and 0x09 to 0x0D.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The whole text, null counting as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words; regexp_count never builds the list of words."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


#: Bits of a bitmap over hashes, and bits in a piece of it: 2 MB in 512 pieces at most, whatever the size of the corpus.
MARK_BITS, PIECE_BITS = 1 << 24, 32768


def _bit(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(MARK_BITS))


def likely_in(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose value of column is among keys (one column of that name), and a few others: a filter of fixed size.

    It spares a join from shuffling rows without a partner. With more keys than bits it lets all rows pass.
    """
    bits = keys.select(_bit(column).alias("__bit"))
    pieces = bits.groupBy((F.col("__bit") / PIECE_BITS).cast("int").alias("__piece")).agg(F.bitmap_construct_agg(F.col("__bit") % PIECE_BITS).alias("__bitmap"))
    marked = rows.withColumn("__bit", _bit(column)).join(F.broadcast(pieces), (F.col("__bit") / PIECE_BITS).cast("int") == F.col("__piece"))
    byte = F.conv(F.hex(F.substring("__bitmap", ((F.col("__bit") % PIECE_BITS) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return marked.where(F.getbit(byte, (F.col("__bit") % 8).cast("int")) == 1).drop("__bit", "__piece", "__bitmap")
