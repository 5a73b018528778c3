"""Filings about employers: registrants, offerings, benefit plans and work places, cleaned and rolled up to lower bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemill.functions import fixed
from rolemill.functions.text import name_key, present, trimmed
from rolemill.operators.groups import latest_of


def digits9(c) -> Column:
    """A number of nine digits, whatever stands between them, else null."""
    own = F.regexp_replace(trimmed(c), "[^0-9]", "")
    return F.when(F.length(own) == 9, own)


def positive(c) -> Column:
    """A whole number above zero; zero can't be told from a field that was skipped."""
    n = (F.col(c) if isinstance(c, str) else c).try_cast("long")
    return F.when(n > 0, n)


def said_yes(c) -> Column:
    return F.coalesce(F.lower(trimmed(c)).isin("true", "1", "y", "yes"), F.lit(False))


def filed_date(c) -> Column:
    """2024-05-31 with anything behind it, or 31-MAY-2024."""
    own = trimmed(c)
    month = F.array_position(F.array(*[F.lit(m) for m in ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")]), F.upper(F.regexp_extract(own, r"^\d{1,2}-([A-Za-z]{3})-\d{4}", 1)))
    worded = F.concat_ws("-", F.regexp_extract(own, r"(\d{4})$", 1), F.lpad(month.cast("string"), 2, "0"), F.lpad(F.regexp_extract(own, r"^(\d{1,2})-", 1), 2, "0"))
    return F.coalesce(F.substring(own, 1, 10).try_cast("date"), F.when(month > 0, worded.try_cast("date")))


def registrants(names: DataFrame, tickers: DataFrame) -> DataFrame:
    """name, key, ticker and is_public: all names, with tickers where the key has one; a ticker's own name counts too."""
    listed = tickers.groupBy("key").agg(F.min("ticker").alias("ticker"))
    every = names.select("name", "key").unionByName(tickers.select("name", "key")).distinct()
    return every.join(listed, "key", "left").select("name", "key", "ticker", F.col("ticker").isNotNull().alias("is_public"))


def offerings(filings: DataFrame) -> DataFrame:
    """Offerings of operating companies: no tests, no pooled funds, no investment companies; amounts and dates read."""
    rows = filings.where(F.coalesce(F.upper(trimmed("testorlive")), F.lit("LIVE")) != "TEST")
    fund = said_yes("is_pooled_fund") | said_yes("is_40_act") | F.coalesce(F.col("industry").isin(*fixed.FUND_INDUSTRIES), F.lit(False)) | present("fund_type").isNotNull()
    return rows.where(~fund).withColumns({"filed": filed_date("filing_date"), "amount": F.regexp_replace("amount", r"[^0-9.\-]", "").try_cast("double")})


def last_amendments(rows: DataFrame, root: str, order: str) -> DataFrame:
    """Of each chain of amendments the last filing, so that a round counts once."""
    return latest_of(rows, [root], F.desc_nulls_last("filed"), F.desc(order))


def plan_sponsors(plans: DataFrame, single_employer: str, floor: int = 1000, ratio: float = 50.0, most: int = 3_000_000) -> DataFrame:
    """ein, sponsor, participants, state and as_of of plans of single employers that can bound a head count.

    Counts at the start and the end of a year describe one workforce: where they are apart by more than ratio and one is above
    floor, the filing is in error and goes. The current count is the answer, the earlier one fills a gap.
    """
    rows = plans.where(F.trim(F.replace(trimmed("entity_code"), F.lit('"'), F.lit(""))) == single_employer)
    rows = rows.withColumns({"ein": digits9("ein"), "__now": positive("active_current"), "__was": positive("active_boy"), "business_code": trimmed("business_code")})
    high, low = F.greatest("__now", "__was"), F.least("__now", "__was")
    apart = F.col("__now").isNotNull() & F.col("__was").isNotNull() & (high > floor) & (high > low * ratio)
    rows = rows.where(~apart).withColumn("participants", F.coalesce("__now", "__was"))
    rows = rows.where(F.col("ein").isNotNull() & F.col("participants").between(1, most) & ~F.coalesce(F.col("business_code").isin(*fixed.NO_EMPLOYER_CODES), F.lit(False)))
    return rows.select("ein", "sponsor", "participants", F.upper(F.coalesce(present("state"), present("state_alt"))).alias("state"), F.substring(trimmed("tax_period"), 1, 10).alias("as_of"))


def sponsor_floors(sponsors: DataFrame, least: int = 6) -> DataFrame:
    """A lower bound for each name key: of each employer the largest plan of its newest year, never the sum; ambiguous ones counted."""
    newest = sponsors.groupBy("ein").agg(F.max("as_of").alias("as_of"))
    own = sponsors.join(newest, ["ein", "as_of"]).groupBy("ein").agg(F.max("participants").alias("participants"), F.min("sponsor").alias("sponsor"), F.min("as_of").alias("as_of"), F.count("*").alias("plans"))
    keyed = own.withColumn("name_key", name_key("sponsor")).where(F.length("name_key") >= least)
    return keyed.groupBy("name_key").agg(F.max("participants").alias("floor"), F.countDistinct("ein").alias("eins"), F.sum("plans").alias("plans"))


def work_places(places: DataFrame, least: int = 6, most: int = 25_000, hours: float = 20.0) -> DataFrame:
    """Establishments that can be added up: a plausible number of people, and hours that they can have worked."""
    rows = places.withColumns({"employees": F.col("employees").try_cast("long"), "hours": F.col("hours").try_cast("double"), "reported": F.coalesce(present("company_name"), present("establishment_name"))})
    rows = rows.where(F.col("employees").between(1, most) & ~F.coalesce((F.col("hours") > 0) & (F.col("hours") / F.col("employees") < hours), F.lit(False)))
    return rows.withColumn("name_key", name_key("reported")).where(F.length("name_key") >= least)


def place_floors(places: DataFrame) -> DataFrame:
    """A lower bound for each name key: the sum over its establishments, with how many there are and their states."""
    return places.groupBy("name_key").agg(F.sum("employees").alias("floor"), F.count("*").alias("establishments"), F.array_sort(F.collect_set("state")).alias("states"), F.min("reported").alias("name"))


def subsidiaries_up(tenants: DataFrame, parents: DataFrame) -> DataFrame:
    """Tenants without a ticker get that of the parent that lists them; basis says whose it is."""
    up = parents.groupBy("name_key").agg(F.min("parent").alias("parent"), F.min("ticker").alias("parent_ticker"), F.countDistinct("ticker").alias("n")).where("n = 1").drop("n")
    rows = tenants.join(up, "name_key", "left")
    basis = F.when(F.col("ticker").isNotNull(), "self").when(F.col("parent_ticker").isNotNull(), "parent")
    return rows.withColumns({"basis": basis, "ticker": F.coalesce("ticker", "parent_ticker"), "parent": F.when(basis == "parent", F.col("parent"))}).drop("parent_ticker")


def freshest(candidates: DataFrame, key: str) -> DataFrame:
    """Of several head counts the freshest, then that of the better source, then the larger."""
    return latest_of(candidates, [key], F.desc_nulls_last("as_of"), F.asc("source_rank"), F.desc("employees"))


def precision(verdicts: DataFrame, by: str) -> DataFrame:
    """Of labelled matches by stratum: labelled, correct, wrong, and the share that is correct among those that are either."""
    known = {"correct", "wrong", "ambiguous", "no_claim"}
    rows = verdicts.withColumn("verdict", F.when(F.col("verdict").isin(*known), F.col("verdict")).otherwise(F.raise_error(F.concat(F.lit("unknown verdict "), F.coalesce("verdict", F.lit("null")))).cast("string")))
    return rows.groupBy(by).agg(F.count("*").alias("labelled"), F.count_if(F.col("verdict") == "correct").alias("correct"), F.count_if(F.col("verdict") == "wrong").alias("wrong")).withColumn("precision", F.try_divide(F.col("correct"), F.col("correct") + F.col("wrong")))


def flag_recall(verdicts: DataFrame, flags: str) -> DataFrame:
    """How many wrong matches carry a flag, and how many flagged ones are wrong."""
    flagged = F.coalesce(F.col(flags) != "", F.lit(False))
    wrong = F.col("verdict") == "wrong"
    sums = verdicts.agg(F.count_if(wrong).alias("wrong"), F.count_if(wrong & flagged).alias("caught"), F.count_if(flagged).alias("flagged"))
    return sums.withColumns({"recall": F.try_divide(F.col("caught"), F.col("wrong")), "share_wrong": F.try_divide(F.col("caught"), F.col("flagged"))})
