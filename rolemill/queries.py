"""Every operator as a query over the driver's tables, beside the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolemill.functions import classify, fixed, keys
from rolemill.functions import places as geo
from rolemill.functions import postings as po
from rolemill.functions import text as tx
from rolemill.operators import companies as co
from rolemill.operators import dedup, groups, profile, quarantine, search, sinks, state
from rolemill.operators.listings import source_rank, typed, union_relaxed
from rolemill.plans import enrich
from rolemill.plans.adapted import LISTING, LISTINGS_SQL, NOW, listings, table
from rolemill.plans.samples import SAMPLES
from rolemill.shared import shared_path, stored
from rolemill.sources import payloads
from rolemill.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
_L = f"WITH l AS ({LISTINGS_SQL})"


def query(sql: str | None = None):
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return keep


def _in(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# ---- sources and sinks ----

@query(f"{_L} SELECT ats_type, count(*) AS n, count(salary_min) AS priced, sum(salary_min) AS total, count(nullif(ats_id, '')) AS with_id FROM l GROUP BY ats_type")
def slices_round_trip(spark, sf):
    path = shared_path(spark, "slices")
    sinks.write_slices(listings(spark, sf).select("ats_type", "ats_id", "title", "salary_min"), path)
    text = spark.read.schema("ats_type string, ats_id string, title string, salary_min string").option("header", True).option("multiLine", True).option("escape", '"').option("nullValue", "").csv(path)
    rows = typed(text)
    return rows.groupBy("ats_type").agg(F.count("*").alias("n"), F.count("salary_min").alias("priced"), F.sum("salary_min").alias("total"), F.count(tx.present("ats_id")).alias("with_id"))


@query(f"{_L} SELECT ats_type, count(*) AS rows FROM l GROUP BY ats_type")
def snapshot_publish(spark, sf):
    path = shared_path(spark, "snapshot")
    manifest = sinks.publish(listings(spark, sf), path, {"by_ats": {}}, NOW)
    rows = spark.read.parquet(path)
    assert manifest["all"]["rows"] == sum(e["rows"] for e in manifest["by_ats"].values())
    return rows.groupBy("ats_type").agg(F.count("*").alias("rows"))


@query("SELECT event_type, count(*) AS n, sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS k FROM events GROUP BY event_type")
def json_columns(spark, sf):
    k = F.from_json("props", "struct<k: bigint>", {"mode": "PERMISSIVE"})["k"]
    return table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("k"))


@query("SELECT doc_id, lang FROM documents ORDER BY md5(doc_id::VARCHAR || '|0'), doc_id LIMIT 25")
def exact_sample(spark, sf):
    return groups.exact_sample(table(spark, sf, "documents").select("doc_id", "lang"), 25, F.col("doc_id"))


@query("SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 40")
def stable_prefix(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "source").orderBy("doc_id").limit(40)


@query("""WITH RECURSIVE b AS (SELECT row_number() OVER (ORDER BY doc_id) AS i, octet_length(encode(text)) + 1 AS bytes FROM documents WHERE text IS NOT NULL),
 g AS (SELECT i, 0 AS shard, 1 AS held, bytes AS total, bytes FROM b WHERE i = 1 UNION ALL
  SELECT b.i, CASE WHEN g.held + 1 > 100 OR g.total + b.bytes > 200000 THEN g.shard + 1 ELSE g.shard END, CASE WHEN g.held + 1 > 100 OR g.total + b.bytes > 200000 THEN 1 ELSE g.held + 1 END,
   CASE WHEN g.held + 1 > 100 OR g.total + b.bytes > 200000 THEN b.bytes ELSE g.total + b.bytes END, b.bytes FROM g JOIN b ON b.i = g.i + 1)
 SELECT shard, count(*) AS rows, sum(bytes)::BIGINT AS bytes FROM g GROUP BY shard""")
def line_shards(spark, sf):
    rows = sinks.sharded(table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", "text"), "doc_id", "text", 100, 200_000)
    return rows.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes"))


@query("SELECT page_id, nullif(trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')), '') AS title, regexp_extract(lower(url), '^https?://(?:www\\.)?([a-z0-9.-]+)', 1) AS host FROM pages")
def page_facts(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.page_title("html").alias("title"), tx.domain_of("url").alias("host"))


def _filled(template: str | None) -> str:
    """SQL, for Spark and DuckDB alike, of a text with its placeholders filled in from a row of documents."""
    if template is None:
        return "CAST(NULL AS VARCHAR(9))"
    text = "'" + template.replace("'", "''") + "'"
    for mark, value in (("@I", "CAST(doc_id AS VARCHAR(20))"), ("@T", "'Role ' || CAST(n_chars AS VARCHAR(20))"), ("@C", "'Town ' || upper(lang)")):
        text = f"replace({text}, '{mark}', {value})"
    return text


_BOARDS = sorted(SAMPLES)
@query("SELECT x.ats_type AS ats_type, x.ats_id AS ats_id, x.title AS title, x.url AS url, x.location AS location FROM (SELECT CASE " + " ".join(
    f"WHEN doc_id % {len(_BOARDS)} = {k} THEN struct_pack(ats_type := '{s}', ats_id := {_filled(SAMPLES[s].ats_id)}, title := {_filled('@T')}, url := {_filled(SAMPLES[s].url)}, location := {_filled(SAMPLES[s].location)})"
    for k, s in enumerate(_BOARDS)) + " END AS x FROM documents WHERE lang IS NOT NULL)")
def board_payloads(spark, sf):
    """A payload of one of all boards for each document, written by board and read back."""
    docs = table(spark, sf, "documents").where("lang IS NOT NULL")
    which = lambda value: "CASE " + " ".join(f"WHEN doc_id % {len(_BOARDS)} = {k} THEN {value(b)}" for k, b in enumerate(_BOARDS)) + " END"
    path = shared_path(spark, "payloads")
    made = docs.selectExpr(f"{which(lambda b: repr(b))} AS source", "'acme' AS company", f"{which(lambda b: _filled(SAMPLES[b].payload))} AS payload")
    made.write.partitionBy("source").parquet(path)
    return payloads.mixed_postings(spark.read.parquet(path)).select("ats_type", "ats_id", "title", "url", "location")


# ---- projections and filters ----

@query(f"{_L} SELECT seq, lower(regexp_replace(lower(company), '[^a-z0-9]', '', 'g')) AS norm, trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')) AS slug, CASE WHEN ats_id <> '' THEN ats_type || '|' || ats_id ELSE url END AS seen, CASE WHEN ats_id <> '' THEN ats_type || ':' || ats_id END AS global_id FROM l")
def posting_keys(spark, sf):
    return listings(spark, sf).select("seq", tx.company_norm().alias("norm"), tx.title_slug().alias("slug"), tx.seen_key().alias("seen"), tx.global_id().alias("global_id"))


@query(f"{_L} SELECT seq, substr(sha256('v1|url' || chr(0) || url), 1, 32) AS job_key, greatest(1, floor(length(description) / 3.6))::INT AS tokens FROM l")
def posting_digests(spark, sf):
    return listings(spark, sf).select("seq", keys.job_key(F.col("url")).alias("job_key"), tx.estimate_tokens(F.col("description")).alias("tokens"))


@query(f"{_L} SELECT seq, title FROM l WHERE contains(lower(title), 'th') AND contains(lower(location), 'austin') AND coalesce(salary_max, 0) >= 60000")
def search_text(spark, sf):
    return search.search(listings(spark, sf), query="TH", location="austin", salary_min=60000).select("seq", "title")


@query(f"{_L} SELECT seq FROM l WHERE coalesce(is_remote, contains(lower(location), 'remote'))")
def search_remote(spark, sf):
    return search.search(listings(spark, sf), remote=True).select("seq")


@query(f"{_L} SELECT seq FROM l WHERE is_remote = false AND coalesce(experience, 0) <= 4 AND ats_type = 'lever'")
def search_on_site(spark, sf):
    return search.search(listings(spark, sf), remote=False, experience_max=4, ats="lever").select("seq")


@query(f"{_L} SELECT seq FROM l WHERE coalesce(salary_min, 'inf'::DOUBLE) <= 45000 AND contains(lower(company), 'firm t')")
def search_pay(spark, sf):
    return search.search(listings(spark, sf), salary_max=45000, company="Firm T").select("seq")


@query("SELECT s_suppkey AS seq, s_name AS name, 2 * (lower('s' || s_suppkey) <> 'supplier#00000000')::INT + (lower(s_name) <> 'supplier#00000000')::INT AS rank FROM supplier WHERE contains(lower(s_name), 'supplier#00000000') OR contains('s' || s_suppkey, 'supplier#00000000') ORDER BY rank, seq LIMIT 10")
def find_company(spark, sf):
    rows = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("seq"), F.col("s_name").alias("name"), F.concat(F.lit("s"), "s_suppkey").alias("slug"))
    return search.find_company(rows, "Supplier#00000000").select("seq", "name", "rank")


_CEIL = " ".join(f"WHEN '{p}' THEN {v}" for p, v in fixed.PAY_CEILING.items())
_UNITS = " ".join(f"WHEN '{c}' THEN {v}" for c, v in fixed.UNITS_PER_DOLLAR.items())
_REASON = f"""CASE WHEN try_cast(posted_at AS TIMESTAMP) > TIMESTAMP '{NOW}' + INTERVAL 2 DAYS THEN 'future_posted_at'
 WHEN greatest(salary_min, salary_max) > (CASE salary_period {_CEIL} END) * (CASE salary_currency {_UNITS} ELSE 1.0 END) THEN 'implausible_salary'
 WHEN {' OR '.join(f"(salary_period = '{p}' AND NOT regexp_matches(salary_summary, '{fixed.PERIOD_WORDS[p]}') AND (" + ' OR '.join(f"regexp_matches(salary_summary, '{w}')" for q, w in fixed.PERIOD_WORDS.items() if q != p) + "))" for p in fixed.PERIOD_WORDS)} THEN 'contradicted_salary_period'
 WHEN lower(trim(company)) IN ({_in(fixed.PLACEHOLDER_EMPLOYERS)}) OR regexp_matches(lower(trim(company)), '{fixed.HOSTNAME}') THEN 'placeholder_employer' END"""


@query(f"{_L} SELECT seq, {_REASON} AS reason FROM l")
def quarantine_reasons(spark, sf):
    rows = listings(spark, sf)
    return rows.select("seq", quarantine.reason(rows, NOW).alias("reason"))


# The rules over the tables' own columns, all rows of them, which SQL can't express; rule_queries.py holds them against SQL.

def _postings(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Columns of the postings of all documents, those without a text as well."""
    return table(spark, sf, "documents").selectExpr("doc_id", *[f"{LISTING[c]} AS {c}" for c in columns])


@query()
def posting_countries(spark, sf):
    return _postings(spark, sf, "location").withColumn("country", geo.country_of(F.col("location")))


@query()
def posting_classes(spark, sf):
    rows = _postings(spark, sf, "title", "location")
    return rows.select("doc_id", "title", classify.seniority().alias("seniority"), classify.placement("title", "location").alias("placement"), classify.is_remote().alias("remote"))


@query()
def posting_pay(spark, sf):
    rows = _postings(spark, sf, "salary_summary").withColumn("pay", classify.salary_range())
    return rows.select("doc_id", "salary_summary", F.col("pay.min").alias("low"), F.col("pay.max").alias("high"))


@query()
def page_boards(spark, sf):
    return table(spark, sf, "pages").withColumn("b", po.board_of(F.col("url"))).select("page_id", "url", "b.ats", "b.slug")


@query()
def described_pay(spark, sf):
    rows = _postings(spark, sf, "description", "country_iso").withColumn("p", po.disclosed_pay(F.col("description"), F.col("country_iso")))
    return rows.select("doc_id", F.col("p.min").alias("low"), F.col("p.max").alias("high"), "p.currency", "p.period")


@query()
def described_headcounts(spark, sf):
    return _postings(spark, sf, "description").select("doc_id", po.headcount(F.col("description")).alias("employees"))


@query("""WITH g AS (SELECT user_id, min('Welcome to team ' || user_id || ': ' || event_type) AS a, max('Welcome to team ' || user_id || ': ' || event_type) AS z, count(*) AS rows FROM events GROUP BY user_id)
 SELECT user_id, rows, left(a, (SELECT max(i) FROM range(0, length(a) + 1) r(i) WHERE left(a, i::INT) = left(z, i::INT))::INT) AS opening FROM g WHERE rows >= 3""")
def common_openings(spark, sf):
    rows = table(spark, sf, "events").select("user_id", F.concat(F.lit("Welcome to team "), F.col("user_id").cast("string"), F.lit(": "), "event_type").alias("text"))
    return po.common_openings(rows, ["user_id"], "text", 3, 1)


# ---- joins ----

@query("SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F' GROUP BY c_custkey")
def left_join(spark, sf):
    done = table(spark, sf, "orders").where("o_orderstatus = 'F'")
    return table(spark, sf, "customer").join(done, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"))


@query("SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS ordered FROM customer")
def semi_and_anti_joins(spark, sf):
    customers, orders = table(spark, sf, "customer").select("c_custkey"), table(spark, sf, "orders")
    on = F.col("c_custkey") == F.col("o_custkey")
    return customers.join(orders, on, "left_semi").withColumn("ordered", F.lit(True)).unionByName(customers.join(orders, on, "left_anti").withColumn("ordered", F.lit(False)))


@query("SELECT coalesce(c_nationkey, s_nationkey) AS nation, c.n AS customers, s.n AS suppliers FROM (SELECT c_nationkey, count(*) AS n FROM customer WHERE c_nationkey < 15 GROUP BY 1) c FULL JOIN (SELECT s_nationkey, count(*) AS n FROM supplier WHERE s_nationkey > 8 GROUP BY 1) s ON c_nationkey = s_nationkey")
def full_join(spark, sf):
    a = table(spark, sf, "customer").where("c_nationkey < 15").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("customers"))
    b = table(spark, sf, "supplier").where("s_nationkey > 8").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("suppliers"))
    return a.join(b, ["nation"], "full")


@query("SELECT DISTINCT s_suppkey, c_custkey FROM supplier JOIN customer ON (s_suppkey = c_custkey) OR (s_name = replace(c_name, 'Customer', 'Supplier'))")
def join_on_any_key(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    c = table(spark, sf, "customer").select("c_custkey", F.replace("c_name", F.lit("Customer"), F.lit("Supplier")).alias("as_supplier"))
    return groups.on_any_key(s, c, [("s_suppkey", "c_custkey"), ("s_name", "as_supplier")], "s_suppkey", "c_custkey")


@query("WITH p AS (SELECT p_partkey AS node, CASE WHEN p_partkey > 3 THEN p_partkey // 3 END AS parent FROM part), RECURSIVE_STEP AS (SELECT 1), r AS (WITH RECURSIVE x(node, root, d) AS (SELECT node, coalesce(parent, node), 1 FROM p UNION ALL SELECT x.node, p.parent, d + 1 FROM x JOIN p ON x.root = p.node WHERE p.parent IS NOT NULL AND d < 10) SELECT node, arg_max(root, d) AS root FROM x GROUP BY node) SELECT node, root FROM r")
def chain_roots(spark, sf):
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("node"), F.when(F.col("p_partkey") > 3, F.floor(F.col("p_partkey") / 3)).alias("parent"))
    return groups.roots(parts, "node", "parent")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey IN (SELECT l_partkey FROM lineitem GROUP BY l_partkey HAVING count(*) <= 25)")
def fan_out_cap(spark, sf):
    return groups.within_fan_out(table(spark, sf, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber"), "l_partkey", 25).drop("l_partkey")


@query("""WITH a AS (SELECT s_suppkey AS k, 0 AS strategy, s_acctbal AS v FROM supplier WHERE s_suppkey % 2 = 0), b AS (SELECT s_suppkey AS k, 1 AS strategy, s_acctbal * 2 AS v FROM supplier),
 u AS (SELECT * FROM a UNION ALL SELECT * FROM b) SELECT k, strategy, v FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY strategy) AS rn FROM u) WHERE rn = 1""")
def best_strategy(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("v"))
    return groups.best_strategy([s.where("k % 2 = 0"), s.withColumn("v", F.col("v") * 2)], ["k"])


# ---- aggregates and windows ----

_GAPS = ["salary_min", "salary_max", "commitment", "ats_id", "country_iso", "experience"]


@query(f"{_L} SELECT ats_type, count(*) AS rows, " + ", ".join(f"avg(CASE WHEN {c} IS NULL OR trim({c}::VARCHAR) = '' THEN 1.0 ELSE 0.0 END) AS {c}_blank" for c in _GAPS) + " FROM l GROUP BY ats_type")
def gap_profile(spark, sf):
    return profile.gaps(listings(spark, sf), _GAPS, ["ats_type"])


@query("SELECT median(length(text)) AS median, quantile_cont(length(text), 0.9) AS p90, max(length(text))::INT AS longest FROM documents WHERE text IS NOT NULL")
def text_lengths(spark, sf):
    return profile.lengths(table(spark, sf, "documents"), "text")


@query(r"""WITH d AS (SELECT source, trim(lower(regexp_replace(text, '\s+', ' ', 'g'))) AS t, lang FROM documents WHERE trim(text) <> '')
 SELECT count(*) AS rows, count(DISTINCT md5(source || chr(0) || t)) AS postings, count(DISTINCT md5(t)) AS bodies, count(DISTINCT md5(source || chr(0) || t || chr(0) || lang)) AS placed, 1 - count(DISTINCT md5(source || chr(0) || t)) / count(*) AS saved FROM d""")
def dedup_savings(spark, sf):
    return profile.dedup_savings(table(spark, sf, "documents"), "source", "text", "lang")


@query("SELECT ats_type, company, count(*) AS postings, count(*) FILTER (WHERE is_remote) AS remote, min(salary_min) AS pay_min, max(salary_max) AS pay_max, min(url) AS sample_url FROM (" + LISTINGS_SQL + ") WHERE (CASE WHEN country_iso <> '' THEN country_iso = 'US' ELSE location IN ('Austin, TX', 'Remote - US', 'DE (DE300)') END) AND (salary_min IS NOT NULL OR salary_summary <> '' OR regexp_matches(description, '" + fixed.PAY_RANGE + "') OR regexp_matches(description, '" + fixed.PAY_PHRASE + "')) GROUP BY ats_type, company")
def us_pay_cohort(spark, sf):
    return co.cohort(co.us_paid(listings(spark, sf)))


@query("""WITH f AS (SELECT o_custkey AS issuer, o_orderkey AS filing_id, o_totalprice AS amount, CAST(o_orderdate AS DATE) AS filed, o_orderstatus = 'O' AS eq FROM orders)
 SELECT issuer, count(*) AS filings, round(sum(amount), 2) AS total, round(sum(amount) FILTER (WHERE eq), 2) AS equity_total, count(*) FILTER (WHERE eq) AS equity_rounds, min(filed)::VARCHAR AS first_filed, max(filed)::VARCHAR AS last_filed,
 arg_max(amount, filed::VARCHAR || lpad(filing_id::VARCHAR, 12, '0')) AS last_amount, count(*) AS rounds FROM f GROUP BY issuer""")
def funding_rollup(spark, sf):
    filings = table(spark, sf, "orders").select(F.col("o_custkey").alias("issuer"), F.col("o_orderkey").alias("filing_id"), F.col("o_totalprice").alias("amount"), F.col("o_orderdate").cast("date").alias("filed"), (F.col("o_orderstatus") == "O").alias("is_equity"))
    return co.funding(filings, "issuer").withColumns({"total": F.round("total", 2), "equity_total": F.round("equity_total", 2), "rounds": F.size("rounds").cast("long"), "first_filed": F.col("first_filed").cast("string"), "last_filed": F.col("last_filed").cast("string")})


@query("SELECT l_suppkey, y AS period, max(l_quantity) AS l_quantity FROM (SELECT l_suppkey, year(l_shipdate) AS y, l_quantity, max(year(l_shipdate)) OVER (PARTITION BY l_suppkey) AS latest FROM lineitem) WHERE y = latest GROUP BY l_suppkey, y")
def latest_period_max(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_suppkey", F.year("l_shipdate").cast("long").alias("period"), "l_quantity")
    return groups.latest_period_max(rows, "l_suppkey", "period", "l_quantity")


@query("SELECT c_nationkey, c_mktsegment AS mode, n AS times FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, c_mktsegment) AS rn FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2)) WHERE rn = 1 AND n >= 2")
def commonest_value(spark, sf):
    return groups.mode(table(spark, sf, "customer"), ["c_nationkey"], "c_mktsegment")


@query("SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds, count(DISTINCT event_type) AS n_kinds FROM events GROUP BY user_id")
def sorted_sets(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("kinds"), F.countDistinct("event_type").alias("n_kinds"))


@query("SELECT c_nationkey, c_custkey, place FROM (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer) WHERE place <= 3")
def top_n_per_group(spark, sf):
    return groups.top_n(table(spark, sf, "customer"), ["c_nationkey"], 3, F.desc("c_acctbal"), F.col("c_custkey")).select("c_nationkey", "c_custkey", "place")


@query("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR || '|3'), doc_id) AS rn FROM documents) WHERE rn <= 5")
def stratified_sample(spark, sf):
    return groups.stratified(table(spark, sf, "documents").select("source", "doc_id"), "source", 5, F.col("doc_id"), 3)


@query("SELECT r_regionkey::VARCHAR AS k, r_name AS name, NULL::VARCHAR AS extra FROM region UNION ALL SELECT n_name AS k, n_name AS name, n_regionkey::VARCHAR AS extra FROM nation")
def union_of_unlike(spark, sf):
    a = table(spark, sf, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name"))
    b = table(spark, sf, "nation").select(F.col("n_name").alias("k"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("string").alias("extra"))
    return union_relaxed([a, b])


# ---- cross-source deduplication ----

_RANKS = " ".join(f"WHEN ats_type = '{s}' THEN {rank}" for s, rank in fixed.SOURCE_RANK.items())
_COUNTRY = "CASE WHEN country_iso <> '' AND country_iso <> 'DE' THEN country_iso WHEN location IN ('Austin, TX', 'Remote - US') THEN 'US' WHEN location = 'Paris, France' THEN 'FR' WHEN location = 'DE (DE300)' THEN 'DE' ELSE 'ES' END"
_PASSES = rf"""{_L}, k AS (SELECT seq, ats_type, CASE {_RANKS} ELSE 2 END AS rank, url, lower(trim(title, E' \t\n\r\f\x0B')) AS title, lower(company) AS company, lower(location) AS location, {_COUNTRY} AS country, ats_id,
   regexp_replace(lower(company), '[^a-z0-9]', '', 'g') AS norm, trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')) AS slug,
   trim(regexp_replace(lower(CASE WHEN len(regexp_extract_all(title, '\([^()]*\)')) >= 2 THEN regexp_replace(title, '\s*\([^()]*\)\s*$', '') ELSE title END), '\s+', ' ', 'g')) AS core FROM l),
 p1 AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY rank, seq) AS rn FROM k) WHERE rn = 1),
 p2 AS (SELECT * EXCLUDE (rn, a, z) FROM (SELECT *, row_number() OVER (PARTITION BY company, title, location ORDER BY rank, seq) AS rn, min(ats_type) OVER (PARTITION BY company, title, location) AS a, max(ats_type) OVER (PARTITION BY company, title, location) AS z FROM p1) WHERE company = '' OR title = '' OR a = z OR rn = 1),
 p3 AS (SELECT * EXCLUDE (rn, a, z) FROM (SELECT *, row_number() OVER (PARTITION BY norm, ats_id ORDER BY rank, seq) AS rn, min(ats_type) OVER (PARTITION BY norm, ats_id) AS a, max(ats_type) OVER (PARTITION BY norm, ats_id) AS z FROM p2) WHERE norm = '' OR ats_id = '' OR a = z OR rn = 1),
 p4 AS (SELECT * EXCLUDE w FROM (SELECT *, first_value(ats_type) OVER (PARTITION BY norm, core, country ORDER BY rank, seq) AS w FROM p3) WHERE norm = '' OR core = '' OR country = '' OR ats_type = w),
 p5 AS (SELECT * EXCLUDE (w, c, d) FROM (SELECT *, first_value(ats_type) OVER (PARTITION BY norm, core ORDER BY rank, seq) AS w, min(nullif(country, '')) OVER (PARTITION BY norm, core) AS c, max(nullif(country, '')) OVER (PARTITION BY norm, core) AS d FROM p4) WHERE norm = '' OR core = '' OR ats_type = w OR c IS DISTINCT FROM d)"""


@query(f"{_PASSES} SELECT seq, ats_type, rank, country FROM p5")
def dedup_exact_passes(spark, sf):
    return dedup.exact_passes(dedup.keys(listings(spark, sf)), lambda df: stored(df, "keys")).select("seq", "ats_type", "rank", "country")


@query(f"""{_PASSES}, own AS (SELECT norm, slug, arg_min(seq, rank * 1000000000 + seq) AS anchor FROM p5 WHERE rank = 1 AND norm <> '' AND slug <> '' GROUP BY norm, slug)
 SELECT p5.seq AS donor, own.anchor FROM p5 JOIN own USING (norm, slug) WHERE p5.ats_type = 'welcometothejungle'""")
def dedup_gated_pairs(spark, sf):
    return dedup.gated_pairs(dedup.exact_passes(dedup.keys(listings(spark, sf)), lambda df: stored(df, "keys")))


@query()
def dedup_similar_titles(spark, sf):
    """Rows that the pass over similar titles keeps; greedy in order, so held against small fixtures instead of SQL."""
    return dedup.by_similar_title(dedup.exact_passes(dedup.keys(listings(spark, sf)))).select("seq", "ats_type", "norm", "title")


@query()
def publish_snapshot(spark, sf):
    from rolemill.plans.publish import published

    blank = spark.createDataFrame([], "seen_key string, first_seen_at timestamp")
    rows = published(listings(spark, sf), blank, NOW, lambda df: stored(df, "publish")).snapshot
    return rows.select("seq", "ats_type", "title", "company", "country_iso", "seniority", "salary_min", "salary_max", "salary_source", "first_seen_at", "last_seen_at")


_SOUND = _PASSES.replace(LISTINGS_SQL, f"SELECT * FROM (SELECT *, {_REASON} AS reason FROM ({LISTINGS_SQL})) WHERE reason IS NULL")


@query(f"""{_SOUND}, own AS (SELECT norm, slug, arg_min(seq, rank * 1000000000 + seq) AS anchor FROM p5 WHERE rank = 1 AND norm <> '' AND slug <> '' GROUP BY norm, slug),
 pairs AS (SELECT p5.seq AS donor, own.anchor FROM p5 JOIN own USING (norm, slug) WHERE p5.ats_type = 'welcometothejungle'), left_over AS (SELECT * FROM p5 WHERE seq NOT IN (SELECT donor FROM pairs)),
 priced AS (SELECT k.seq, k.ats_type, k.norm, k.slug, l.salary_min, l.salary_max, l.salary_currency FROM k JOIN l USING (seq) WHERE k.ats_type = 'welcometothejungle' AND (l.salary_min IS NOT NULL OR l.salary_max IS NOT NULL) AND k.seq NOT IN (SELECT seq FROM left_over)),
 direct AS (SELECT norm, slug, min(seq) AS found FROM left_over WHERE rank = 1 GROUP BY norm, slug),
 gifts AS (SELECT coalesce(anchor, found) AS target, min(struct_pack(seq := seq, giver := ats_type, a := salary_min, b := salary_max, c := salary_currency)) AS gift FROM priced LEFT JOIN pairs ON donor = seq LEFT JOIN direct USING (norm, slug) WHERE coalesce(anchor, found) IS NOT NULL GROUP BY 1)
 SELECT s.seq, s.ats_type, s.country AS country_iso, CASE WHEN takes THEN gift.a ELSE salary_min END AS salary_min, CASE WHEN takes THEN gift.b ELSE salary_max END AS salary_max, CASE WHEN takes THEN gift.c ELSE salary_currency END AS salary_currency,
  CASE WHEN takes THEN gift.giver END AS salary_source, TIMESTAMP '{NOW}' AS first_seen_at FROM (SELECT left_over.*, l.salary_min, l.salary_max, l.salary_currency, gift, gift IS NOT NULL AND l.salary_min IS NULL AND l.salary_max IS NULL AS takes FROM left_over JOIN l USING (seq) LEFT JOIN gifts ON target = seq) s""")
def publish_equal_keys(spark, sf):
    """Publishing as a whole, but for the two passes over similar titles, which SQL can't express."""
    from rolemill.plans.publish import published

    blank = spark.createDataFrame([], "seen_key string, first_seen_at timestamp")
    rows = published(listings(spark, sf), blank, NOW, lambda df: stored(df, "publish"), limit=0).snapshot
    return rows.select("seq", "ats_type", "country_iso", "salary_min", "salary_max", "salary_currency", "salary_source", "first_seen_at")


# ---- state ----

@query(f"""{_L}, k AS (SELECT seq, CASE WHEN ats_id <> '' THEN ats_type || '|' || ats_id ELSE url END AS seen_key FROM l), old AS (SELECT DISTINCT seen_key FROM k WHERE seq % 3 = 0)
 SELECT k.seq, CASE WHEN old.seen_key IS NULL THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS first_seen_at, TIMESTAMP '{NOW}' AS last_seen_at FROM k LEFT JOIN old USING (seen_key)""")
def liveness(spark, sf):
    rows, blank = listings(spark, sf), spark.createDataFrame([], "seen_key string, first_seen_at timestamp")
    before = state.sightings_of(state.stamped(rows.where("seq % 3 = 0"), blank, F.lit("2024-01-01 00:00:00").cast("timestamp")))
    return state.stamped(rows, before, F.lit(NOW).cast("timestamp")).select("seq", "first_seen_at", "last_seen_at")


@query("""WITH s AS (SELECT user_id AS k, event_id AS v FROM events WHERE event_id % 2 = 0), old AS (SELECT k, max(v) AS v FROM s WHERE k % 3 = 0 GROUP BY k),
 new AS (SELECT user_id AS k, max(event_id) AS v FROM events WHERE event_id % 2 = 1 AND user_id % 2 = 0 GROUP BY 1)
 SELECT k, v FROM new UNION ALL SELECT k, v FROM old WHERE k NOT IN (SELECT k FROM new)""")
def upsert(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("k"), F.col("event_id").alias("v"))
    old = e.where("v % 2 = 0 AND k % 3 = 0").groupBy("k").agg(F.max("v").alias("v"))
    return state.upserted(old, e.where("v % 2 = 1 AND k % 2 = 0"), ["k"], F.desc("v"))


@query("SELECT coalesce(a.k, b.k) AS k, coalesce(b.x, a.x) AS x, coalesce(b.y, a.y) AS y FROM (SELECT s_suppkey AS k, s_name AS x, NULL::DOUBLE AS y FROM supplier WHERE s_suppkey % 2 = 0) a FULL JOIN (SELECT s_suppkey AS k, NULL::VARCHAR AS x, s_acctbal AS y FROM supplier WHERE s_suppkey % 3 = 0) b ON a.k = b.k")
def merge_fields(spark, sf):
    s = table(spark, sf, "supplier")
    old = s.where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("x"), F.lit(None).cast("double").alias("y"))
    new = s.where("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("k"), F.lit(None).cast("string").alias("x"), F.col("s_acctbal").alias("y"))
    return state.merged(old, new, ["k"], ["x", "y"])


@query("""WITH r AS (SELECT doc_id::VARCHAR AS job_key, md5(text) AS h FROM documents), s AS (SELECT doc_id, doc_id::VARCHAR AS job_key, CASE WHEN doc_id % 5 = 1 THEN 'old' ELSE md5(text) END AS h, CASE WHEN doc_id % 7 = 2 THEN 1 ELSE 2 END AS v FROM documents WHERE doc_id % 4 <> 0),
 c AS (SELECT CASE WHEN s.h IS NULL THEN 'new' WHEN s.h <> r.h THEN 'changed' WHEN s.v < 2 THEN 'stale' ELSE 'unchanged' END AS delta FROM r LEFT JOIN s USING (job_key))
 SELECT delta, count(*) AS rows, count(*) / sum(count(*)) OVER () AS share FROM c GROUP BY delta""")
def delta_classes(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id"), F.col("doc_id").cast("string").alias("job_key"), F.md5("text").alias("content_hash"))
    old = docs.where("doc_id % 4 <> 0").select("job_key", F.when(F.col("doc_id") % 5 == 1, "old").otherwise(F.col("content_hash")).alias("content_hash"), F.when(F.col("doc_id") % 7 == 2, 1).otherwise(2).alias("version"), F.lit("p").alias("prompt_hash"))
    return state.delta_counts(state.classified(docs, old, 2))


# ---- enrichment and companies ----

@query("""WITH p AS (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN 'xx' ELSE lang END AS got, CASE WHEN doc_id % 6 = 0 THEN NULL ELSE lang END AS want FROM documents),
 s AS (SELECT count(*) FILTER (WHERE want = got) AS hit, count(*) FILTER (WHERE want <> got) AS wrong, count(*) FILTER (WHERE want IS NOT NULL AND got IS NULL) AS missed, count(*) FILTER (WHERE want IS NULL AND got IS NOT NULL) AS over_claimed, count(*) FILTER (WHERE want IS NULL AND got IS NULL) AS correct_abstain FROM p)
 SELECT 'lang' AS field, *, hit / (hit + wrong + missed) AS recall, hit / (hit + wrong + over_claimed) AS precision, over_claimed / (over_claimed + correct_abstain) AS over_claim FROM s""")
def evaluation(spark, sf):
    docs = table(spark, sf, "documents")
    want = docs.select("doc_id", F.when(F.col("doc_id") % 6 == 0, None).otherwise(F.col("lang")).alias("lang"))
    got = docs.select("doc_id", F.when(F.col("doc_id") % 10 == 0, None).when(F.col("doc_id") % 7 == 0, "xx").otherwise(F.col("lang")).alias("lang"))
    return profile.evaluated(want, got, "doc_id", ["lang"])


@query("""SELECT s_suppkey, CASE WHEN bal * 1.15 >= flr THEN 'agrees' WHEN bal * 2 >= flr THEN 'contradicted' ELSE 'withdrawn' END AS floor_check,
 concat_ws(',', CASE WHEN bal < 0 THEN 'negative' END, CASE WHEN bal > 5000 THEN 'large' END, CASE WHEN s_nationkey = 3 THEN 'home' END) AS flags, CASE WHEN s_nationkey = 3 THEN NULL ELSE bal END AS shown FROM (SELECT *, s_acctbal AS bal, s_suppkey * 20.0 AS flr FROM supplier)""")
def company_checks(spark, sf):
    s = table(spark, sf, "supplier").withColumns({"bal": F.col("s_acctbal"), "flr": F.col("s_suppkey") * F.lit(20.0), "shown": F.col("s_acctbal")})
    out = s.select("s_suppkey", co.checked_floor(F.col("bal"), F.col("flr")).alias("floor_check"), profile.flags_of(negative=F.col("bal") < 0, large=F.col("bal") > 5000, home=F.col("s_nationkey") == 3).alias("flags"), "shown", "s_nationkey")
    return co.withheld(out, ["shown"], F.col("s_nationkey") == 3).drop("s_nationkey")


# ---- streams ----

@query("SELECT user_id, event_type, count(*) AS rows FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY user_id, event_type")
def stream_once(spark, sf):
    root = shared_path(spark, "stream")
    events = table(spark, sf, "events").select("user_id", "event_type")
    events.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
    ingest.run_available(ingest.once(stream, ["user_id", "event_type"]), f"{root}/progress", lambda batch, n: batch.write.mode("overwrite").parquet(f"{root}/out/batch={n}"))
    return spark.read.schema(events.schema).option("recursiveFileLookup", "true").parquet(f"{root}/out").groupBy("user_id", "event_type").agg(F.count("*").alias("rows"))


@query("SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id")
def stream_upsert(spark, sf):
    root = shared_path(spark, "stream")
    events = table(spark, sf, "events").select("user_id", "event_id")
    events.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
    ingest.run_available(stream, f"{root}/progress", ingest.upsert_into(spark, f"{root}/table", ["user_id"], F.desc("event_id")))
    last = spark.read.parquet(f"{root}/table").agg(F.max("version").alias("v")).head()["v"]
    return spark.read.schema(events.schema).parquet(f"{root}/table/version={last}")


def source_ranks(spark, sf):
    return listings(spark, sf).select("seq", source_rank().alias("rank"))


query(f"{_L} SELECT seq, CASE {_RANKS} ELSE 2 END AS rank FROM l")(source_ranks)
