"""Rules over short fields and prose, beside the same rules in SQL, over cases put together from the driver's rows.

Each case is made of parts that vary from row to row; what is expected is worked out in SQL from the parts, not looked up.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rolemill.functions import classify, fixed
from rolemill.functions import places as geo
from rolemill.functions import postings as po
from rolemill.functions import text as tx
from rolemill.operators import companies as co
from rolemill.operators import state
from rolemill.plans import enrich
from rolemill.plans.adapted import LISTINGS_SQL, listings, table
from rolemill.queries import query


def _in(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _nth(values: list[str], n: str) -> str:
    """SQL, for Spark and DuckDB alike, of one of some texts by number."""
    return f"CASE CAST({n} AS BIGINT) % {len(values)} " + " ".join(f"WHEN {k} THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in enumerate(values)) + " END"


# ---- places ----

_TOWNS = [*fixed.DELAWARE_TOWNS[:9], *fixed.INDIAN_CITIES[:9], *fixed.INDONESIAN_CITIES[:9], "Springfield", "Lakeside", "Ashford", "Kingsport"]
_CODES = [*[c for c in fixed.STATES if c != "PR"], *fixed.PROVINCES, *[c for c, _ in fixed.COUNTRY_NAMES]]
_TOWN, _CODE = _nth(_TOWNS, "doc_id"), _nth(_CODES, "floor(doc_id / 7)")
_PLACE = f"CASE doc_id % 8 WHEN 0 THEN ({_TOWN}) || ', ON, ' || ({_CODE}) WHEN 1 THEN ({_CODE}) || ' (' || ({_CODE}) || '300)' WHEN 2 THEN upper({_TOWN}) || ' (' || ({_CODE}) || ')' ELSE ({_TOWN}) || ', ' || ({_CODE}) END"
_DE, _ID, _IN = (_in(x) for x in (fixed.DELAWARE_TOWNS, fixed.INDONESIAN_CITIES, fixed.INDIAN_CITIES))


@query(f"""WITH p AS (SELECT doc_id, {_PLACE} AS place, lower({_TOWN}) AS town, {_CODE} AS code FROM documents)
 SELECT doc_id, place, CASE WHEN doc_id % 8 = 1 THEN code WHEN code = 'CA' THEN CASE WHEN doc_id % 8 = 0 THEN 'CA' ELSE 'US' END WHEN code = 'DE' THEN CASE WHEN town IN ({_DE}) AND doc_id % 8 <> 2 THEN 'US' ELSE 'DE' END
  WHEN code = 'IN' THEN CASE WHEN town IN ({_IN}) AND doc_id % 8 <> 2 THEN 'IN' ELSE 'US' END WHEN code = 'ID' THEN CASE WHEN town IN ({_ID}) AND doc_id % 8 <> 2 THEN 'ID' ELSE 'US' END
  WHEN code IN ({_in(c for c, _ in fixed.COUNTRY_NAMES)}) THEN code WHEN code IN ({_in(fixed.STATES)}) THEN 'US' WHEN code IN ({_in(fixed.PROVINCES)}) THEN 'CA' ELSE '' END AS country FROM p""")
def countries(spark, sf):
    rows = table(spark, sf, "documents").selectExpr("doc_id", f"{_PLACE} AS place")
    return rows.withColumn("country", geo.country_of(F.col("place")))


# ---- titles ----

_FIRST = ["", "Senior ", "Sr. ", "Junior ", "Lead ", "Staff ", "Principal ", "Chief ", "Head of ", "Graduate ", "Mid-level ", "Assistant ", "VP "]
_SECOND = ["Software Engineer", "Product Manager", "Store Manager", "Art Director", "Sales Director", "Nurse", "of Staff", "Living Advisor", "Generation Specialist", "Data Scientist", "Intern", "Account Executive", "Program"]
_THIRD = ["", " (Remote)", " - hybrid", ", on-site", " / work from home", " II", " Manager"]
_TITLE = f"({_nth(_FIRST, 'doc_id')}) || ({_nth(_SECOND, 'floor(doc_id / 13)')}) || ({_nth(_THIRD, 'floor(doc_id / 5)')})"
_RANK = " ".join(f"WHEN regexp_matches(title, '{p.replace(chr(39), chr(39) * 2)}')" + (f" AND NOT regexp_matches(title, '{x.replace(chr(39), chr(39) * 2)}')" if x else "") + f" THEN '{name}'" for name, p, x in fixed.SENIORITY)


def _has(column: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({column}), '{w}')" for w in words) + ")"


@query(f"""WITH t AS (SELECT doc_id, {_TITLE} AS title FROM documents)
 SELECT doc_id, title, CASE {_RANK} END AS seniority, CASE WHEN {_has('title', fixed.HYBRID_WORDS)} THEN 'hybrid' WHEN {_has('title', fixed.REMOTE_WORDS)} THEN 'remote' WHEN {_has('title', fixed.ONSITE_WORDS)} THEN 'onsite' END AS placement,
  CASE WHEN {_has('title', fixed.REMOTE_TITLE_WORDS)} THEN true END AS remote FROM t""")
def title_classes(spark, sf):
    rows = table(spark, sf, "documents").selectExpr("doc_id", f"{_TITLE} AS title")
    return rows.select("doc_id", "title", classify.seniority().alias("seniority"), classify.placement("title").alias("placement"), classify.is_remote().alias("remote"))


_KINDS = [(w, kind) for kind, words in fixed.EMPLOYMENT_WORDS.items() for w in words]
_SAID = f"({_nth(['', 'Very ', 'no ', 'x', 'Employee, '], 'floor(doc_id / 3)')}) || ({_nth([w for w, _ in _KINDS], 'doc_id')}) || ({_nth(['', 's', ' / stage', ' (m/f)', ' only', ' contract'], 'floor(doc_id / 7)')})"


@query(f"""WITH s AS (SELECT doc_id, {_SAID} AS said FROM documents), w(k, word, kind) AS (VALUES {', '.join(f"({k}, '{w}', '{kind}')" for k, (w, kind) in enumerate(_KINDS))})
 SELECT doc_id, said, (SELECT arg_min(kind, k - 1000 * length(word)) FROM w WHERE contains(lower(said), word)) AS kind FROM s""")
def employment_kinds(spark, sf):
    rows = table(spark, sf, "documents").selectExpr("doc_id", f"{_SAID} AS said")
    return rows.select("doc_id", "said", classify.employment_type("said").alias("kind"))


# ---- pay and head counts ----

_LOW, _HIGH = "(20 + doc_id % 180)", "(20 + floor(doc_id / 3) % 180)"
_RANGE = f"""CASE doc_id % 7 WHEN 0 THEN '$' || CAST({_LOW} AS BIGINT) || 'K - $' || CAST({_HIGH} AS BIGINT) || 'K' WHEN 1 THEN CAST({_LOW} AS BIGINT) || ',000 to ' || CAST({_HIGH} AS BIGINT) || ',500' WHEN 2 THEN '€' || CAST({_LOW} AS BIGINT) || '.5k – €' || CAST({_HIGH} AS BIGINT) || 'k'
 WHEN 3 THEN 'CA$' || CAST({_LOW} AS BIGINT) || ' thousand' WHEN 4 THEN '£' || CAST({_LOW} AS BIGINT) || ' 000' WHEN 5 THEN '$' || CAST(doc_id % 9 + 1 AS BIGINT) || '.25M' ELSE 'competitive' END"""


@query(f"""WITH s AS (SELECT doc_id, {_RANGE} AS summary, {_LOW}::DOUBLE AS lo, {_HIGH}::DOUBLE AS hi FROM documents),
 v AS (SELECT doc_id, summary, CASE doc_id % 7 WHEN 0 THEN lo * 1000 WHEN 1 THEN lo * 1000 WHEN 2 THEN lo * 1000 + 500 WHEN 3 THEN lo * 1000 WHEN 4 THEN lo * 1000 WHEN 5 THEN (doc_id % 9 + 1.25) * 1000000 END AS a,
  CASE doc_id % 7 WHEN 0 THEN hi * 1000 WHEN 1 THEN hi * 1000 + 500 WHEN 2 THEN hi * 1000 WHEN 3 THEN lo * 1000 WHEN 4 THEN lo * 1000 WHEN 5 THEN (doc_id % 9 + 1.25) * 1000000 END AS b FROM s)
 SELECT doc_id, summary, least(a, b) AS low, greatest(a, b) AS high FROM v""")
def pay_ranges(spark, sf):
    rows = table(spark, sf, "documents").selectExpr("doc_id", f"{_RANGE} AS summary")
    return rows.withColumn("pay", classify.salary_range("summary")).select("doc_id", "summary", F.col("pay.min").alias("low"), F.col("pay.max").alias("high"))


_PROSE = f"""coalesce(substr(regexp_replace(text, '[0-9$£€¥]', ' '), 1, 400), '') || '. ' || CASE doc_id % 5 WHEN 0 THEN 'Annual salary: $' || CAST({_LOW} AS BIGINT) || ',000 - $' || CAST({_HIGH} AS BIGINT) || ',000 USD' WHEN 1 THEN 'Pay range €' || CAST({_LOW} AS BIGINT) || 'k to €' || CAST({_HIGH} AS BIGINT) || 'k'
 WHEN 2 THEN 'We pay $' || CAST({_LOW} AS BIGINT) || '.50 - $' || CAST({_HIGH} AS BIGINT) || '.00 per hour' WHEN 3 THEN 'between $' || CAST({_LOW} AS BIGINT) || ' and $' || CAST({_HIGH} AS BIGINT) || ' off' ELSE 'no figures' END || '.'"""


@query(f"""WITH s AS (SELECT doc_id, {_LOW}::DOUBLE AS lo, {_HIGH}::DOUBLE AS hi FROM documents),
 v AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN lo * 1000 WHEN 1 THEN lo * 1000 WHEN 2 THEN lo + 0.5 END AS a, CASE doc_id % 5 WHEN 0 THEN hi * 1000 WHEN 1 THEN hi * 1000 WHEN 2 THEN hi END AS b FROM s)
 SELECT doc_id, least(a, b) AS low, greatest(a, b) AS high, CASE doc_id % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'USD' END AS currency, CASE doc_id % 5 WHEN 0 THEN 'YEAR' WHEN 1 THEN 'YEAR' WHEN 2 THEN 'HOUR' END AS period FROM v""")
def disclosed_pay(spark, sf):
    """Pay stated behind the beginning of each document's own text."""
    rows = table(spark, sf, "documents").selectExpr("doc_id", f"{_PROSE} AS d")
    return rows.withColumn("p", po.disclosed_pay(F.col("d"), F.lit("US"))).select("doc_id", F.col("p.min").alias("low"), F.col("p.max").alias("high"), "p.currency", "p.period")


_CLAIM = """coalesce(regexp_replace(text, '[0-9]', ' '), '') || '. ' || CASE doc_id % 4 WHEN 0 THEN 'We have ' || CAST(doc_id + 10 AS BIGINT) || ' employees and ' || CAST(doc_id * 3 + 5 AS BIGINT) || ' associates.' WHEN 1 THEN 'It has ' || CAST(doc_id + 7 AS BIGINT) || ' full-time employees.' WHEN 2 THEN 'We laid off ' || CAST(doc_id + 7 AS BIGINT) || ' employees.' ELSE 'none' END"""


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN greatest(doc_id + 10, doc_id * 3 + 5) WHEN 1 THEN doc_id + 7 END::BIGINT AS employees FROM documents")
def headcounts(spark, sf):
    """Head counts claimed behind each document's own text."""
    rows = table(spark, sf, "documents").selectExpr("doc_id", f"{_CLAIM} AS d")
    return rows.select("doc_id", po.headcount(F.col("d")).alias("employees"))


# ---- addresses of boards ----

_HOSTS = [("greenhouse", "https://boards.greenhouse.io/", ""), ("lever", "jobs.lever.co/", "/x"), ("ashby", "https://jobs.ashbyhq.com/", "?a=1"), ("join_com", "https://join.com/companies/", ""), ("recruitee", "https://", ".recruitee.com/o/1"), ("workday", "https://", ".wd5.myworkdayjobs.com/Ext"), ("personio", "", ".jobs.personio.de"), ("bamboohr", "https://", ".bamboohr.com"), (None, "https://careers.example/", ""), ("rippling", "https://ats.rippling.com/", "/jobs")]
_SLUG = "'Firm-' || CAST(doc_id AS VARCHAR(12))"
_BOARD = f"({_nth([a for _, a, _ in _HOSTS], 'doc_id')}) || {_SLUG} || ({_nth([z for _, _, z in _HOSTS], 'doc_id')})"


@query(f"SELECT doc_id, {_BOARD} AS url, CASE doc_id % {len(_HOSTS)} " + " ".join(f"WHEN {k} THEN {'NULL' if s is None else repr(s)}" for k, (s, _, _) in enumerate(_HOSTS)) + f" END AS ats, CASE WHEN doc_id % {len(_HOSTS)} <> 8 THEN lower({_SLUG}) END AS slug FROM documents")
def careers_urls(spark, sf):
    rows = table(spark, sf, "documents").selectExpr("doc_id", f"{_BOARD} AS url")
    return rows.withColumn("b", po.board_of(F.col("url"))).select("doc_id", "url", "b.ats", "b.slug")


# ---- state, enrichment, companies ----

@query("""WITH d AS (SELECT a.doc_id, a.text AS cached, b.text AS fresh FROM documents a LEFT JOIN documents b ON b.doc_id = a.doc_id + 3)
 SELECT doc_id, CASE WHEN length(cached) > coalesce(length(fresh), 0) THEN cached ELSE fresh END AS description FROM d""")
def description_cache(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("cached"))
    fresh = docs.select((F.col("doc_id") - 3).alias("doc_id"), F.col("cached").alias("fresh"))
    return docs.join(fresh, "doc_id", "left").select("doc_id", state.longer_wins(F.col("cached"), F.col("fresh")).alias("description"))


@query(f"""WITH l AS ({LISTINGS_SQL}), t AS (SELECT CASE WHEN country_iso <> '' THEN 'provider' ELSE 'rules' END AS country_iso_source,
 CASE WHEN commitment IS NOT NULL THEN 'rules' ELSE 'none' END AS employment_type_source, CASE WHEN (CASE {_RANK} END) IS NOT NULL THEN 'rules' ELSE 'none' END AS seniority_source FROM l)
 SELECT 'country_iso' AS field, country_iso_source AS source, count(*) AS rows FROM t GROUP BY 2 UNION ALL SELECT 'employment_type', employment_type_source, count(*) FROM t GROUP BY 2 UNION ALL SELECT 'seniority', seniority_source, count(*) FROM t GROUP BY 2""")
def enrichment_coverage(spark, sf):
    return enrich.coverage(enrich.tier0(listings(spark, sf), ["country_iso"]), ["country_iso", "employment_type", "seniority"])


_OWN = "CASE s_suppkey % 4 WHEN 0 THEN 'Solo' || CAST(s_suppkey AS VARCHAR(9)) || ' Inc.' WHEN 1 THEN 'North & Sons ' || CAST(s_suppkey AS VARCHAR(9)) || ', LLC' ELSE 'Blue Harbor ' || CAST(s_suppkey AS VARCHAR(9)) || ' Holdings, Inc' END"
_REF = "CASE s_suppkey % 4 WHEN 0 THEN 'SOLO' || CAST(s_suppkey AS VARCHAR(9)) || ' Corp' WHEN 1 THEN 'north and sons ' || CAST(s_suppkey AS VARCHAR(9)) WHEN 2 THEN 'Blue Harbor ' || CAST(s_suppkey AS VARCHAR(9)) || ' Ltd' ELSE 'Red Harbor ' || CAST(s_suppkey AS VARCHAR(9)) END"


@query("SELECT s_suppkey, s_suppkey AS ref FROM supplier WHERE s_suppkey % 4 < 3")
def company_matching(spark, sf):
    """Tenants against reference names that are spelled otherwise, or name somebody else."""
    rows = table(spark, sf, "supplier").selectExpr("s_suppkey", f"{_OWN} AS name", f"{_REF} AS ref_label", "s_acctbal AS employees")
    s, ref = rows.select("s_suppkey", "name").withColumn("k", tx.name_key("name")), rows.select(F.col("s_suppkey").alias("ref"), "ref_label", "employees").withColumn("rk", tx.name_key("ref_label"))
    core = s.withColumn("name", tx.without_suffix("name")), ref.withColumn("ref_label", tx.without_suffix("ref_label"))
    return co.matched(*core, [("k", "rk")], "s_suppkey", "ref", "name", "ref_label", "employees").select("s_suppkey", "ref")
