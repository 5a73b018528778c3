"""Facts in urls and prose of postings: which board a careers url belongs to, disclosed pay, head counts, shared openings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemill.functions import fixed
from rolemill.functions.classify import currency, pay_period

_SLUG = "([A-Za-z0-9_.-]+)"
# --- fixed values: hosts of boards, with the tenant in the path or as the first label of the host ---
PATH_BOARDS = {
    "greenhouse": r"(?:job-)?boards(?:\.eu)?\.greenhouse\.io", "lever": r"jobs(?:\.eu)?\.lever\.co", "ashby": r"jobs\.ashbyhq\.com",
    "workable": r"apply\.workable\.com", "smartrecruiters": r"(?:jobs|careers)\.smartrecruiters\.com", "jobvite": r"jobs\.jobvite\.com",
    "rippling": r"ats\.rippling\.com", "gem": r"jobs\.gem\.com", "join_com": r"join\.com/companies",
    "welcometothejungle": r"(?:www\.)?welcometothejungle\.com/[a-z]{2}/companies",
}
HOST_BOARDS = {
    "recruitee": r"recruitee\.com", "bamboohr": r"bamboohr\.com", "teamtailor": r"teamtailor\.com", "personio": r"jobs\.personio\.(?:de|com)",
    "breezy": r"breezy\.hr", "pinpoint": r"pinpointhq\.com", "icims": r"icims\.com", "jazzhr": r"applytojob\.com",
    "softgarden": r"softgarden\.io", "gupy": r"gupy\.io", "darwinbox": r"darwinbox\.(?:in|com)", "keka": r"keka\.com", "avature": r"avature\.net",
    "taleo": r"taleo\.net", "eightfold": r"eightfold\.ai", "recruiterbox": r"recruiterbox\.com", "workday": r"wd\d+\.myworkdayjobs\.com",
    "herp": r"herp\.careers", "successfactors": r"successfactors\.(?:com|eu)",
}


def board_of(url: Column) -> Column:
    """struct(ats, slug) of a careers url, or null where no known board is in it."""
    found = []
    for ats, host in PATH_BOARDS.items():
        found.append((ats, rf"(?i)^(?:https?://)?{host}/{_SLUG}"))
    for ats, host in HOST_BOARDS.items():
        found.append((ats, rf"(?i)^(?:https?://)?{_SLUG}\.{host}(?:[/?#:]|$)"))
    return F.coalesce(*[F.when(url.rlike(p), F.struct(F.lit(ats).alias("ats"), F.lower(F.regexp_extract(url, p, 1)).alias("slug"))) for ats, p in found])


_MONEY = r"(?:US|CA|A|NZ|HK|S|R)?[$£€¥]\s?(\d[\d,.]*)\s*([kK])?"
_PAY = rf"(?is)(.{{0,80}}?)({_MONEY}\s*(?:-|–|—|to|and)\s*{_MONEY}(?:\s*(?-i:({'|'.join(fixed.CURRENCY_CODES)}))\b)?(.{{0,40}}))"
_LABEL = r"(?i)(?:base (?:pay|salary)|salary|pay|compensation|hiring|annual|hourly) ?(?:range|scale|rate|salary|band)?"


def _money(number: Column, unit: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(number, r"[.,]$", ""), r"[.,](?=\d{3}(?:\D|$))", "")
    return plain.try_cast("double") * F.when(F.lower(unit) == "k", 1000.0).otherwise(1.0)


def disclosed_pay(description: Column, country: Column) -> Column:
    """struct(min, max, currency, period) of the first pay range in prose; small amounts need a label or a period beside them."""
    # The passage is looked for once in the whole text; its parts are read from the passage.
    found = F.when(description.rlike(rf"(?is){_MONEY}\s*(?:-|–|—|to|and)\s*{_MONEY}"), F.regexp_extract(description, _PAY, 0))
    return F.transform(F.array(found), lambda passage: _pay_of(passage, country))[0]


def _pay_of(passage: Column, country: Column) -> Column:
    def part(i: int) -> Column:
        return F.regexp_extract(passage, _PAY, i)

    low, high = _money(part(3), part(4)), _money(part(5), part(6))
    near = F.concat(part(1), F.lit(" "), part(8))
    period = F.coalesce(pay_period(near), F.when(low >= 10000, "YEAR"))
    trusted = (low >= 10000) | near.rlike(_LABEL) | period.isNotNull()
    pay = F.struct(F.least(low, high).alias("min"), F.greatest(low, high).alias("max"), F.coalesce(F.nullif(F.upper(part(7)), F.lit("")), currency(part(2), country)).alias("currency"), period.alias("period"))
    return F.when(passage.rlike(_PAY) & low.isNotNull() & high.isNotNull() & trusted, pay)


def headcount(text: Column) -> Column:
    """The largest number of employees that the text claims, but for hires, layoffs and shares of them."""
    kept = F.regexp_replace(text, r"(?i)(?:hired|laid off|hiring|added|cut|up to|fewer than|per cent|percent)[^.]{0,40}?\d[\d,]*\s+(?:full-time\s+)?(?:employees|people)", " ")
    found = F.regexp_extract_all(kept, F.lit(r"(?i)(\d[\d,]*)\s*(?:full-time |permanent |total |global )?(?:employees|team members|associates|people worldwide)"), 1)
    return F.array_max(F.transform(found, lambda x: F.regexp_replace(x, ",", "").try_cast("long")))


def common_openings(df: DataFrame, keys: list[str], text: str, least_rows: int = 3, least_chars: int = 120) -> DataFrame:
    """What all texts of a group begin with: the common opening of the smallest and the largest text is that of all."""
    ends = df.where(F.col(text).isNotNull()).groupBy(*keys).agg(F.min(text).alias("a"), F.max(text).alias("z"), F.count("*").alias("rows")).where(F.col("rows") >= least_rows)
    same = F.arrays_zip(F.split("a", "").alias("x"), F.split("z", "").alias("y"))
    n = F.coalesce(F.nullif(F.array_position(F.transform(same, lambda p: p["x"].eqNullSafe(p["y"])), False), F.lit(0)) - 1, F.length("a"))
    return ends.withColumn("opening", F.substring("a", F.lit(1), n.cast("int"))).where(F.length("opening") >= least_chars).select(*keys, "rows", "opening")
