"""Saved payloads of job boards as postings: JSON, JSON inside pages, HTML cards, linked data and feeds of XML.

A board is a row of a table in boards.py: where its items lie and how each field is read from one. A board not listed reads
like the common shape. Live fetching is not part of this; payloads come as a table (company, payload) or as files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemill.sources.boards import BOARDS, COMMON, Board
from rolemill.sources.cells import Item, tagged

#: Fields of a posting with their types; what a board doesn't have is null.
FIELDS = {
    "ats_id": "string", "title": "string", "url": "string", "apply_url": "string", "location": "string", "is_remote": "boolean", "department": "string", "team": "string", "commitment": "string",
    "requisition_id": "string", "description": "string", "posted_at": "timestamp", "salary_min": "double", "salary_max": "double", "salary_currency": "string", "salary_period": "string", "salary_summary": "string",
}


def board(source: str) -> Board:
    return BOARDS.get(source, Board())


def _items(payloads: DataFrame, b: Board) -> DataFrame:
    """company, payload and item: one row an item of each payload."""
    if b.card:
        return payloads.select("company", "payload", F.explode(F.regexp_extract_all("payload", F.lit(f"(?is){b.card}"), 1)).alias("item"))
    if b.element:
        return payloads.select("company", "payload", F.explode(F.regexp_extract_all("payload", F.lit(rf"(?s)(<{b.element}\b.*?</{b.element}>)"), 1)).alias("item"))
    text = F.regexp_extract("payload", b.script, 1) if b.script else F.col("payload")
    parsed = payloads.select("company", F.try_parse_json(text).alias("payload"))
    listed = b.items(F.col("payload")) if b.items else F.coalesce(*[F.try_variant_get("payload", p, "array<variant>") for p in b.paths])
    return parsed.select("company", "payload", F.explode(listed).alias("item"))


def _cell(c: Column, kind: str) -> Column:
    return F.nullif(F.trim(c), F.lit("")) if kind == "string" else c.cast(kind)


def postings(payloads: DataFrame, source: str) -> DataFrame:
    """One row an item with an id and a title, each id once within a company; payload: its text, company: its tenant."""
    b = board(source)
    cells = (COMMON if not (b.card or b.element) else {}) | b.fields
    at = Item(F.col("item"), F.col("company"), F.col("payload"))
    employer = F.coalesce(cells["company"](at), F.col("company")) if "company" in cells else F.col("company")
    read = [_cell(cells[f](at), kind).alias(f) if f in cells else F.lit(None).cast(kind).alias(f) for f, kind in FIELDS.items()]
    rows = _items(payloads, b).select(F.lit(source).alias("ats_type"), F.col("company").alias("tenant"), employer.alias("company"), *read).where("ats_id IS NOT NULL AND title IS NOT NULL")
    rest = [c for c in rows.columns if c not in ("tenant", "ats_id")]
    first = rows.groupBy("tenant", "ats_id").agg(F.min(F.struct(*rest)).alias("x"))
    return first.select("ats_id", "x.*").select("ats_type", "company", *FIELDS)


def mixed_postings(payloads: DataFrame) -> DataFrame:
    """Postings of payloads of many boards at once; source: the board of each."""
    parts = [postings(payloads.where(F.col("source") == s), s) for s in sorted(BOARDS)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def linked_postings(pages: DataFrame, html: str = "html") -> DataFrame:
    """Postings that pages describe in linked-data scripts."""
    found = F.regexp_extract_all(F.col(html), F.lit(r'(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>'), 1)
    rows = pages.select("*", F.explode(found).alias("__ld")).where(F.get_json_object("__ld", "$['@type']") == "JobPosting")
    return rows.withColumns({"title": F.get_json_object("__ld", "$.title"), "company": F.get_json_object("__ld", "$.hiringOrganization.name"), "posted_at": F.get_json_object("__ld", "$.datePosted")}).drop("__ld")


def feed_postings(feeds: DataFrame, element: str = "item") -> DataFrame:
    """Items of an XML feed; payload: its text."""
    at = Item(F.col("item"), F.col("company"), F.col("payload"))
    cells = {"ats_id": tagged("guid"), "title": tagged("title"), "url": tagged("link")}
    return _items(feeds, Board(element=element)).select("company", *[c(at).alias(n) for n, c in cells.items()])


def read_payloads(spark, path: str) -> DataFrame:
    """source, company and payload of files with a line of JSON each, from any store that Spark reads."""
    lines = spark.read.text(path).select(F.try_parse_json("value").alias("v")).where("v IS NOT NULL")
    return lines.select(*[F.try_variant_get("v", f"$.{c}", "string").alias(c) for c in ("source", "company", "payload")])
