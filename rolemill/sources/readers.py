"""Reading what providers publish as files: folders of slices, archives, lines, and JSON of several shapes.

Paths go through Hadoop's file systems, so that any store that Spark reads will do.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rolemill.operators.listings import union_relaxed


class NothingFound(ValueError):
    """A folder that should hold something holds nothing."""


def _files(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """Path and bytes of the files that a pattern matches, by path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted((str(f.getPath().toString()), int(f.getLen())) for f in found or [] if f.isFile())


def text_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV with a header, every column as text."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("sep", sep).option("nullValue", "").csv(path)


def slices(spark: SparkSession, root: str, file: str = "jobs.csv") -> DataFrame:
    """Rows of root/<source>/<file> for each source; missing and empty files and those with but a header are passed over.

    Columns of differing types become text, missing ones null. Raises where no slice has a row.
    """
    held = [(p, text_csv(spark, p)) for p, size in _files(spark, f"{root}/*/{file}") if size]
    parts = [df.withColumn("slice", F.lit(p.split("/")[-2])) for p, df in held if not df.isEmpty()]
    if not parts:
        raise NothingFound(f"no slice under {root} has a row")
    return union_relaxed(parts)


def directory(spark: SparkSession, root: str) -> DataFrame:
    """Employers of root/<source>.csv: ats, name, slug and url; files without name and url are left out, a missing slug is empty."""
    parts = []
    for p, size in _files(spark, f"{root}/*.csv"):
        df = text_csv(spark, p) if size else None
        if df is not None and {"name", "url"} <= set(df.columns):
            slug = F.coalesce("slug", F.lit("")) if "slug" in df.columns else F.lit("")
            parts.append(df.select(F.lit(p.split("/")[-1].removesuffix(".csv")).alias("ats"), "name", slug.alias("slug"), "url"))
    if not parts:
        raise NothingFound(f"no directory under {root}")
    return union_relaxed(parts)


def by_extension(spark: SparkSession, path: str) -> DataFrame:
    """Parquet, CSV or lines of JSON, as the name says; packed or not."""
    name = path.lower().removesuffix(".gz")
    if name.endswith((".json", ".jsonl", ".ndjson")):
        return spark.read.json(path)
    return text_csv(spark, path, "\t" if name.endswith(".tsv") else ",") if name.endswith((".csv", ".tsv")) else spark.read.parquet(path)


def best_format(offered: dict[str, str]) -> str:
    """Of a dataset's files by format, the one to read: Parquet before CSV before anything else."""
    for kind in ("parquet", "csv"):
        if offered.get(kind):
            return offered[kind]
    raise NothingFound("no file is offered")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A record a line; blank lines are passed over, lines that can't be read give nulls."""
    return spark.read.text(path).where(F.trim("value") != "").select(F.from_json("value", schema).alias("x")).select("x.*")


def keyed_lines(spark: SparkSession, path: str) -> DataFrame:
    """name and key of lines "NAME:0000123456:" in Latin-1, split at the last colon with a number behind it."""
    lines = spark.read.option("encoding", "ISO-8859-1").option("sep", "\x01").option("quote", "").schema("line string").csv(path)
    rows = lines.select(F.trim(F.regexp_extract("line", r"^(.*):(\d+):?\s*$", 1)).alias("name"), F.regexp_extract("line", r"^(.*):(\d+):?\s*$", 2).try_cast("long").alias("key"))
    return rows.where("name <> '' AND key IS NOT NULL")


def columnar_rows(payloads: DataFrame, columns: list[str], payload: str = "payload") -> DataFrame:
    """Rows of JSON that has names in "fields" and lists of values in "data"; a field that is not there is null."""
    shape = F.from_json(payload, "struct<fields: array<string>, data: array<array<string>>>")
    rows = payloads.select(shape.alias("x")).select("x.fields", F.explode("x.data").alias("values"))
    at = lambda c: F.nullif(F.array_position("fields", F.lit(c)), F.lit(0))
    return rows.select(*[F.try_element_at("values", at(c).cast("int")).alias(c) for c in columns])


def money(c: Column) -> Column:
    """A number out of text such as "$1,234.5"; zero is unset."""
    return F.nullif(F.regexp_replace(c, r"[^0-9.\-]", "").try_cast("double"), F.lit(0.0))


def screener_rows(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """ticker, name, market_cap and last_sale of the rows of a screener's JSON."""
    row = "struct<symbol: string, name: string, marketCap: string, lastsale: string>"
    rows = payloads.select(F.explode(F.from_json(payload, f"struct<data: struct<rows: array<{row}>>>")["data"]["rows"]).alias("r"))
    return rows.select(F.upper(F.trim("r.symbol")).alias("ticker"), "r.name", money(F.col("r.marketCap")).alias("market_cap"), money(F.col("r.lastsale")).alias("last_sale"))


def binding_rows(payloads: DataFrame, names: list[str], key: str, best: str, payload: str = "payload") -> DataFrame:
    """Rows of the bindings of a SPARQL answer, of each key that with the greatest value of best."""
    bound = F.try_variant_get(F.try_parse_json(payload), "$.results.bindings", "array<variant>")
    rows = payloads.select(F.explode(bound).alias("b")).select(*[F.try_variant_get("b", f"$.{n}.value", "string").alias(n) for n in names])
    return rows.groupBy(key).agg(F.max_by(F.struct(*[n for n in names if n != key]), F.struct(F.col(best), *[n for n in names if n not in (key, best)])).alias("x")).select(key, "x.*")


def picked(df: DataFrame, *spellings: str) -> Column:
    """The first column that has one of these names, whatever its case; nulls if none has."""
    known = {c.lower(): c for c in df.columns}
    for s in spellings:
        if s.lower() in known:
            return F.col(f"`{known[s.lower()]}`")
    return F.lit(None).cast("string")


def _members(pattern: str, sep: str, columns: list[str], required: list[str], quoted: bool):
    def rows(text: io.TextIOBase) -> Iterator[list[str]]:
        yield from csv.reader(text, delimiter=sep) if quoted else (line.rstrip("\r\n").split(sep) for line in text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                archive = zipfile.ZipFile(io.BytesIO(content))
                for member in sorted(n for n in archive.namelist() if pattern.lower() in n.lower()):
                    lines = rows(io.TextIOWrapper(archive.open(member), "utf-8", errors="replace", newline=""))
                    header = [h.strip().lower() for h in next(lines, [])]
                    missing = [c for c in required if c.lower() not in header]
                    if missing:
                        raise ValueError(f"{path}: {member} has no {', '.join(missing)}")
                    at = [header.index(c.lower()) if c.lower() in header else None for c in columns]
                    held: list[list[str | None]] = []
                    for line in lines:
                        held.append([member, *[line[k] if k is not None and k < len(line) and line[k] != "" else None for k in at]])
                        if len(held) >= 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*held, strict=True)], ["member", *columns])
                            held = []
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*held, strict=True)], ["member", *columns])

    return run


def zipped_rows(spark: SparkSession, path: str, member: str, columns: list[str], required: tuple[str, ...] = (), sep: str = "\t", quoted: bool = False) -> DataFrame:
    """member and columns, as text, of the rows of archives' members that have member in their names; an archive a task.

    Rows are read as a stream: short ones are filled up, long ones cut, bytes that are no UTF-8 replaced. Columns that a member
    lacks are null, but for required ones, without which the layout has changed and it raises.
    """
    schema = "member string, " + ", ".join(f"`{c}` string" for c in columns)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(_members(member, sep, columns, list(required), quoted), schema)


def facet_plan(items: DataFrame, facets: list[str], cap: int) -> DataFrame:
    """How a query that answers with cap rows at most is split until every part fits: level, the facets' values, and rows.

    A part that is too large is split by the next facet; those of the last facet stay, however large. Each item is in one part.
    """
    open_, parts = items, []
    for level in range(len(facets) + 1):
        by = facets[:level]
        counts = open_.groupBy(*by).agg(F.count("*").alias("rows"))
        done = counts if level == len(facets) else counts.where(F.col("rows") <= cap)
        parts.append(done.where("rows > 0").select(F.lit(level).alias("level"), *[F.col(f).cast("string").alias(f) if f in by else F.lit(None).cast("string").alias(f) for f in facets], "rows"))
        if level < len(facets):
            large = counts.where(F.col("rows") > cap).select(*[F.col(f).alias(f"__{f}") for f in by], F.lit(1).alias("__large"))
            same = [F.col(f).eqNullSafe(F.col(f"__{f}")) for f in by]
            open_ = open_.join(large, same, "left_semi") if by else open_.join(F.broadcast(large), F.lit(True), "left_semi")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def batches(df: DataFrame, rows: int) -> Iterator[list]:
    """Rows in lists of bounded length, a partition at a time."""
    held: list = []
    for row in df.toLocalIterator(prefetchPartitions=False):
        held.append(row)
        if len(held) == rows:
            yield held
            held = []
    if held:
        yield held
