"""Cross-source deduplication: eight passes in turn, each over what the one before left.

Rows are ordered by (rank, seq): the source's rank, then the order of ingest, which must be unique but for rows of one url,
of which one stays in any case. The passes that compare titles work on blocks of one employer, and skip blocks that stay
larger than a limit even for a single country, as the contract of those passes says; every other pass is joins and
aggregates.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolemill.functions import fixed
from rolemill.functions.places import reconciled_country
from rolemill.functions.similarity import alike, in_order
from rolemill.functions.text import company_norm, lower_each, title_core, title_slug, trimmed
from rolemill.operators.groups import first_of, with_group
from rolemill.operators.listings import col_or, source_rank
from rolemill.shared import stored

BLOCK_LIMIT = 5000
TITLE_BAR, GATED_BAR = 90.0, 95.0
PAY = ["salary_min", "salary_max", "salary_currency", "salary_period", "salary_summary"]


def keys(df: DataFrame) -> DataFrame:
    """What the passes compare, one thin row a posting."""
    out = df.select(
        "seq", "ats_type", source_rank().alias("rank"), trimmed("url").alias("url"), lower_each(trimmed("title")).alias("title"),
        lower_each(trimmed("company")).alias("company"), lower_each(trimmed("location")).alias("location"),
        reconciled_country(col_or(df, "location"), col_or(df, "country_iso")).alias("country"), trimmed("ats_id").alias("ats_id"),
        title_core("title").alias("core"),
    )
    return out.withColumns({"norm": company_norm("company"), "slug": title_slug("title")})


def by_url(rows: DataFrame) -> DataFrame:
    return first_of(rows, ["url"], ["rank", "seq"], F.col("url") != "")


def _one_row(rows: DataFrame, on: list[str], needed: list[str]) -> DataFrame:
    """Of groups that span several sources only the first row stays."""
    valid = F.lit(True)
    for c in needed:
        valid &= F.col(c) != ""
    held = with_group(rows.where(valid), on, __first=F.min(F.struct("rank", "seq")), __a=F.min("ats_type"), __z=F.max("ats_type"))
    kept = held.where((F.col("__a") == F.col("__z")) | (F.struct("rank", "seq") == F.col("__first")))
    return kept.select(*rows.columns).unionByName(rows.where(~valid))


def _one_source(rows: DataFrame, on: list[str], one_country: bool = False) -> DataFrame:
    """Of groups that span several sources only the rows of the first row's source stay."""
    valid = F.lit(True)
    for c in on:
        valid &= F.col(c) != ""
    known = F.nullif(F.col("country"), F.lit(""))
    held = with_group(rows.where(valid), on, __best=F.min(F.struct("rank", "seq", "ats_type")), __c=F.min(known), __d=F.max(known))
    exempt = ~F.col("__c").eqNullSafe(F.col("__d")) if one_country else F.lit(False)
    kept = held.where(exempt | (F.col("ats_type") == F.col("__best.ats_type")))
    return kept.select(*rows.columns).unionByName(rows.where(~valid))


def by_text(rows: DataFrame) -> DataFrame:
    return _one_row(rows, ["company", "title", "location"], ["company", "title"])


def by_id(rows: DataFrame) -> DataFrame:
    return _one_row(rows, ["norm", "ats_id"], ["norm", "ats_id"])


def by_core_and_country(rows: DataFrame) -> DataFrame:
    return _one_source(rows, ["norm", "core", "country"])


def by_core(rows: DataFrame) -> DataFrame:
    return _one_source(rows, ["norm", "core"], one_country=True)


def _blocks(rows: DataFrame, limit: int, several_sources: bool) -> DataFrame:
    """Rows of blocks worth comparing, with part: the country where a block is too large as a whole."""
    rows = rows.where(F.col("norm") != "")
    held = with_group(rows, ["norm"], __n=F.count("*"), __a=F.min("ats_type"), __z=F.max("ats_type"))
    held = held.where("__n > 1" + (" AND __a <> __z" if several_sources else "")).withColumn("part", F.when(F.col("__n") > limit, F.col("country")).otherwise(""))
    held = with_group(held.drop("__a", "__z", "__n"), ["norm", "part"], __n=F.count("*"))
    return held.where(F.col("__n") <= limit).drop("__n")


def too_large(rows: DataFrame, limit: int = BLOCK_LIMIT) -> DataFrame:
    """norm, part and rows of the blocks that the passes over similar titles leave alone because they are above the limit."""
    rows = rows.where(F.col("norm") != "")
    whole = with_group(rows, ["norm"], __n=F.count("*"), __a=F.min("ats_type"), __z=F.max("ats_type")).where(F.col("__n") > limit).where("__a <> __z")
    return whole.groupBy("norm", F.col("country").alias("part")).agg(F.count("*").alias("rows")).where(F.col("rows") > limit)


def _greedy(bar: float):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        kept, gone = [], []
        for seq, ats, title, country in block.sort_values(["rank", "seq"])[["seq", "ats_type", "title", "country"]].itertuples(index=False):
            words = in_order(title)
            same = any(a != ats and (c == country or not c or not country) and alike(t, words, bar) for t, a, c in kept)
            gone.append(seq) if same else kept.append((words, ats, country))
        return pd.DataFrame({"seq": pd.Series(gone, dtype="int64")})

    return run


def by_similar_title(rows: DataFrame, limit: int = BLOCK_LIMIT) -> DataFrame:
    """In order, a row goes if a row of another source, kept before it, has a similar title and no conflicting country."""
    gone = _blocks(rows, limit, True).groupBy("norm", "part").applyInPandas(_greedy(TITLE_BAR), "seq long")
    return rows.join(gone, "seq", "left_anti")


def gated_pairs(rows: DataFrame) -> DataFrame:
    """donor and anchor: a gated posting, and the first row of the employer's own board with the same title."""
    valid = rows.where((F.col("norm") != "") & (F.col("slug") != ""))
    own = valid.where(F.col("rank") == fixed.DIRECT_RANK).groupBy("norm", "slug").agg(F.min_by("seq", F.struct("rank", "seq")).alias("anchor"))
    return valid.where(F.col("ats_type").isin(fixed.GATED_SOURCES)).join(own, ["norm", "slug"]).select(F.col("seq").alias("donor"), "anchor")


def _nearest(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values(["rank", "seq"])
    own = [(seq, in_order(slug)) for seq, slug in block[block["rank"] == fixed.DIRECT_RANK][["seq", "slug"]].itertuples(index=False)]
    pairs = []
    for seq, slug in block[block["ats_type"].isin(fixed.GATED_SOURCES)][["seq", "slug"]].itertuples(index=False):
        words = in_order(slug)
        found = next((anchor for anchor, other in own if alike(words, other, GATED_BAR)), None)
        if found is not None:
            pairs.append((seq, found))
    return pd.DataFrame(pairs, columns=["donor", "anchor"]).astype("int64")


def similar_gated_pairs(rows: DataFrame, limit: int = BLOCK_LIMIT) -> DataFrame:
    gated = rows.where(F.col("ats_type").isin(fixed.GATED_SOURCES)).select("norm").distinct()
    own = rows.join(gated, "norm", "left_semi").where((F.col("rank") == fixed.DIRECT_RANK) | F.col("ats_type").isin(fixed.GATED_SOURCES))
    held = with_group(own.where((F.col("norm") != "") & (F.col("slug") != "")), ["norm"], __n=F.count("*"))
    return held.where(F.col("__n") <= limit).drop("__n").groupBy("norm").applyInPandas(_nearest, "donor long, anchor long")


@dataclass
class Outcome:
    """survivors: rows of keys(); pairs: donor and anchor of postings that gave way to the employer's own."""

    survivors: DataFrame
    pairs: DataFrame


def written(df: DataFrame) -> DataFrame:
    return stored(df, "dedup-keys")


def exact_passes(rows: DataFrame, cut=written) -> DataFrame:
    """The passes that compare keys only. Each reads its input several times, so that lineage is cut between them."""
    for one in (by_url, by_text, by_id, by_core_and_country, by_core):
        rows = one(cut(rows))
    return cut(rows)


def deduplicated(rows: DataFrame, cut=written, limit: int = BLOCK_LIMIT) -> Outcome:
    """All passes over keys(). cut: what ends the lineage of a table that is read several times; limit: of blocks of titles."""
    rows = cut(by_similar_title(exact_passes(rows, cut), limit))
    pairs = cut(gated_pairs(rows))
    rows = cut(rows.join(pairs, F.col("seq") == F.col("donor"), "left_anti"))
    more = cut(similar_gated_pairs(rows, limit))
    return Outcome(rows.join(more, F.col("seq") == F.col("donor"), "left_anti"), pairs.unionByName(more))


def donated(survivors: DataFrame, all_rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Survivors with the pay of a gated twin where they have none; all pay columns move together, with the twin's source.

    A pair names its anchor. Gated rows that fell in earlier passes go to a survivor of the employer's own board with the
    same title. Only priced twins give, and the earliest one does.
    """
    keyed = all_rows.select("seq", "ats_type", *PAY, company_norm("company").alias("norm"), title_slug("title").alias("slug"))
    priced = keyed.where(F.col("ats_type").isin(fixed.GATED_SOURCES) & (F.col("salary_min").isNotNull() | F.col("salary_max").isNotNull()))
    priced = priced.join(survivors.select("seq"), "seq", "left_anti")
    own = survivors.where(source_rank() == fixed.DIRECT_RANK).select(F.col("seq").alias("found"), company_norm("company").alias("norm"), title_slug("title").alias("slug")).groupBy("norm", "slug").agg(F.min("found").alias("found"))
    to = priced.join(pairs, F.col("seq") == F.col("donor"), "left").join(own, ["norm", "slug"], "left").withColumn("to", F.coalesce("anchor", "found")).where("to IS NOT NULL")
    gift = to.groupBy("to").agg(F.min(F.struct("seq", F.col("ats_type").alias("giver"), *PAY)).alias("gift"))
    rows = survivors.join(gift, F.col("seq") == F.col("to"), "left")
    takes = F.col("gift").isNotNull() & F.col("salary_min").isNull() & F.col("salary_max").isNull()
    return rows.withColumns({c: F.when(takes, F.col(f"gift.{c}")).otherwise(F.col(c)) for c in PAY} | {"salary_source": F.when(takes, F.col("gift.giver"))}).drop("to", "gift")
