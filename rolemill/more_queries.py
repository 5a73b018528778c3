"""Queries over keys, names, readers, sinks, filings and what runs leave behind, beside the SQL that says the same."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import functions as F

from rolemill.functions import classify, fixed, keys, names, prose, sites
from rolemill.functions import text as tx
from rolemill.operators import filings, gazetteer, groups, lifecycle, profile, sinks, state
from rolemill.plans.adapted import LISTINGS_SQL, listings, table
from rolemill.queries import query
from rolemill.shared import shared_path
from rolemill.sources import readers
from rolemill.streaming import ingest

_L = f"WITH l AS ({LISTINGS_SQL})"


def _in(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# ---- keys ----

#: Addresses of every awkward kind, told from a document's id.
_URL = """CASE doc_id % 3 WHEN 0 THEN 'HTTPS://Jobs.' WHEN 1 THEN 'http://WWW.' ELSE 'https://' END || CASE doc_id % 5 WHEN 0 THEN 'Acme.Example' WHEN 1 THEN 'beta.example' ELSE 'Tenant-' || CAST(doc_id % 11 AS VARCHAR(9)) || '.example' END
 || CASE doc_id % 7 WHEN 0 THEN ':443' WHEN 1 THEN ':80' WHEN 2 THEN ':8443' ELSE '' END || CASE WHEN doc_id % 13 = 0 THEN '' WHEN doc_id % 13 = 1 THEN '/' WHEN doc_id % 2 = 0 THEN '/Job/' || CAST(doc_id AS VARCHAR(9)) || '/' ELSE '/Job/' || CAST(doc_id AS VARCHAR(9)) END
 || CASE doc_id % 6 WHEN 0 THEN '?utm_source=x&b=2&a=1' WHEN 1 THEN '?gh_jid=9&GH_SRC=q&empty=' WHEN 2 THEN '?ref=home&TrackingId=5' WHEN 3 THEN '?site=CX_1&a=3&a=1' ELSE '' END
 || CASE doc_id % 4 WHEN 0 THEN '#' || CAST(doc_id * 7 AS VARCHAR(9)) WHEN 1 THEN '#Apply' WHEN 2 THEN '#job-details' ELSE '' END"""
_CANONICAL = rf"""WITH u AS (SELECT doc_id, {_URL} AS url FROM documents),
 p AS (SELECT *, lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) AS scheme, lower(regexp_extract(url, '^[A-Za-z]+://([^/:?#]+)', 1)) AS host, regexp_extract(url, '^[A-Za-z]+://[^/:?#]+:([0-9]+)', 1) AS port,
   regexp_extract(url, '^[A-Za-z]+://[^/?#]+([^?#]*)', 1) AS path, regexp_extract(url, '\?([^#]*)', 1) AS q, regexp_extract(url, '#(.*)$', 1) AS frag FROM u),
 k AS (SELECT *, list_sort(list_filter(string_split(q, '&'), lambda x: x <> '' AND split_part(x, '=', 2) <> '' AND NOT starts_with(lower(x), 'utm_') AND NOT list_contains([{_in(sorted(fixed.TRACKING_PARAMETERS))}], lower(split_part(x, '=', 1))))) AS kept FROM p),
 c AS (SELECT doc_id, url, scheme || '://' || host || CASE WHEN port IN ('') OR (scheme = 'http' AND port = '80') OR (scheme = 'https' AND port = '443') THEN '' ELSE ':' || port END
   || CASE WHEN length(path) > 1 THEN regexp_replace(path, '/$', '') ELSE path END || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END
   || CASE WHEN lower(frag) IN ({_in(sorted(fixed.PAGE_ANCHORS))}) THEN '' ELSE '#' || frag END AS canonical FROM k)"""


@query(f"{_CANONICAL} SELECT doc_id, canonical, substr(sha256('v1|url' || chr(0) || canonical), 1, 32) AS job_key FROM c")
def canonical_urls(spark, sf):
    rows = table(spark, sf, "documents").selectExpr("doc_id", f"{_URL} AS url")
    return rows.select("doc_id", keys.canonical_url("url").alias("canonical"), keys.job_key(F.col("url")).alias("job_key"))


_FOLD = "trim(regexp_replace(lower(strip_accents(trim(coalesce({}, ''), E' \\t\\n\\r\\f\\x0B'))), '\\s+', ' ', 'g'))"


@query(f"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN ' ' ELSE source END AS company, substr(text, 1, 60) AS title, lang AS location FROM documents),
 f AS (SELECT doc_id, {_FOLD.format('company')} AS c, {_FOLD.format('title')} AS t, {_FOLD.format('location')} AS l FROM d)
 SELECT doc_id, CASE WHEN c <> '' AND t <> '' THEN substr(sha256('v1|ctl' || chr(0) || c || chr(0) || t || chr(0) || l), 1, 32) END AS fallback_key FROM f""")
def fallback_keys(spark, sf):
    rows = table(spark, sf, "documents").selectExpr("doc_id", "CASE WHEN doc_id % 9 = 0 THEN ' ' ELSE source END AS company", "substr(text, 1, 60) AS title", "lang AS location")
    return rows.select("doc_id", keys.fallback_key().alias("fallback_key"))


_SQUEEZE = "trim(regexp_replace(trim(coalesce({}, ''), E' \\t\\n\\r\\f\\x0B'), '\\s+', ' ', 'g'))"


@query(f"{_L} SELECT seq, substr(sha256('v1|content' || chr(0) || {_SQUEEZE.format('title')} || chr(0) || substr({_SQUEEZE.format('description')}, 1, 500) || chr(0) || {_SQUEEZE.format('location')} || chr(0) || {_SQUEEZE.format('salary_summary')} || chr(0) || {_SQUEEZE.format('commitment')} || chr(0) || {_SQUEEZE.format('employment_type')}), 1, 32) AS content_hash FROM l")
def content_hashes(spark, sf):
    return listings(spark, sf).select("seq", keys.content_hash(truncate=500).alias("content_hash"))


@query(f"""{_CANONICAL}, z AS (SELECT c.doc_id, CASE WHEN d.n_chars % 3 > 0 THEN coalesce(d.source, '') || chr(0) || CAST(d.n_chars AS VARCHAR) ELSE c.canonical END AS k FROM c JOIN documents d USING (doc_id))
 SELECT min(doc_id) AS doc_id FROM z GROUP BY k""")
def run_once(spark, sf):
    rows = table(spark, sf, "documents").selectExpr("doc_id", "source AS company", "CASE WHEN n_chars % 3 > 0 THEN CAST(n_chars AS STRING) END AS ats_id", f"{_URL} AS url")
    return lifecycle.each_once(rows, keys.run_key(), F.asc("doc_id")).select("doc_id")


# ---- names and places ----

@query("""WITH n AS (SELECT c_custkey, c_name || CASE c_custkey % 5 WHEN 0 THEN ' Careers' WHEN 1 THEN ' Jobs  Page' WHEN 2 THEN ' (US) careers' WHEN 3 THEN ' External Careers' ELSE '' END AS name FROM customer)
 SELECT c_custkey, regexp_extract(name, '^(Customer#[0-9]+)', 1) AS shown FROM n""")
def display_names(spark, sf):
    ends = F.element_at(F.array(*[F.lit(x) for x in (" Careers", " Jobs  Page", " (US) careers", " External Careers", "")]), (F.col("c_custkey") % 5).cast("int") + 1)
    return table(spark, sf, "customer").select("c_custkey", names.display_name(F.concat("c_name", ends)).alias("shown"))


_ENDS_SQL = " ".join(f"WHEN ends_with(x, '{s}') AND length(x) - {len(s)} >= 5 THEN left(x, -{len(s)})" for s in sorted(set(fixed.LEGAL_FORMS), key=lambda s: (-len(s), s)))


@query(f"""WITH w AS (SELECT p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') || CASE p_partkey % 4 WHEN 0 THEN 'inc' WHEN 1 THEN 'holdingsllc' WHEN 2 THEN 'company' ELSE '' END AS x FROM part),
 a AS (SELECT p_partkey, CASE {_ENDS_SQL} END AS first, x FROM w), b AS (SELECT p_partkey, first, first AS x FROM a)
 SELECT p_partkey, first, CASE {_ENDS_SQL} END AS second FROM b""")
def run_together_names(spark, sf):
    ends = F.element_at(F.array(*[F.lit(x) for x in ("inc", "holdingsllc", "company", "")]), (F.col("p_partkey") % 4).cast("int") + 1)
    rows = table(spark, sf, "part").select("p_partkey", names.run_together(F.concat(F.regexp_replace(F.lower("p_name"), "[^a-z0-9]", ""), ends)).alias("k"))
    return rows.select("p_partkey", F.get("k", F.lit(0)).alias("first"), F.get("k", F.lit(1)).alias("second"))


_PLACE = "CASE doc_id % 6 WHEN 0 THEN 'Austin, TX' WHEN 1 THEN 'Remote (CA)' WHEN 2 THEN 'Boise/ID, USA' WHEN 3 THEN 'London, Uk' WHEN 4 THEN 'Paris' ELSE source || ', NY 10001' END"


@query(f"""WITH p AS (SELECT doc_id, {_PLACE} AS place, CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 4 = 1 THEN 'tx' ELSE 'CA' END AS own FROM documents),
 s AS (SELECT doc_id, own, nullif(regexp_extract(coalesce(place, ''), '[,/(]\\s*([A-Z]{{2}})\\b', 1), '') AS state FROM p)
 SELECT doc_id, state, CASE WHEN state IN ({_in(fixed.STATES)}) AND own IS NOT NULL THEN upper(state) = upper(own) END AS agrees FROM s""")
def state_agreement(spark, sf):
    rows = table(spark, sf, "documents").selectExpr("doc_id", f"{_PLACE} AS place", "CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 4 = 1 THEN 'tx' ELSE 'CA' END AS own").withColumn("state", names.state_code("place"))
    return rows.select("doc_id", "state", names.state_agrees(F.col("state"), F.col("own")).alias("agrees"))


@query("""SELECT s_suppkey, CASE WHEN cap IS NULL THEN 'missing' WHEN price IS NULL THEN 'unverified' WHEN abs(1000.0 * price - cap) / cap <= 0.15 THEN 'verified' ELSE 'disagrees' END AS cap_check,
 CASE WHEN price IS NOT NULL THEN price * 3.0 < 1000.0 OR price > 15000.0 END AS conflict
 FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 5000000.0 END AS cap, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_acctbal END AS price FROM supplier)""")
def cap_checks(spark, sf):
    rows = table(spark, sf, "supplier").selectExpr("s_suppkey", "CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 5000000.0D END AS cap", "CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_acctbal END AS price")
    return rows.select("s_suppkey", names.cap_check(F.col("cap"), F.lit(1000.0), F.col("price")).alias("cap_check"), names.band_conflict(F.col("price"), F.lit(1000.0), F.lit(5000.0)).alias("conflict"))


def _score(words: list[str]) -> str:
    return f"len(list_intersect(w, [{_in(words)}]))"


_BEST = " ".join(f"WHEN {_score(w)} = best THEN '{c}'" for c, w in sorted(fixed.COMMON_WORDS.items()))


@query(f"""WITH s AS (SELECT doc_id, substr(concat_ws(' ', nullif(trim(coalesce(source, '')), ''), nullif(trim(coalesce(text, ''), E' \\t\\n\\r\\f\\x0B'), '')), 1, 400) AS t FROM documents),
 w AS (SELECT doc_id, t, regexp_split_to_array(lower(t), '[^\\p{{L}}'']+') AS w FROM s), b AS (SELECT *, greatest({', '.join(_score(w) for w in fixed.COMMON_WORDS.values())}) AS best FROM w)
 SELECT doc_id, CASE WHEN length(trim(t)) < 8 OR best = 0 THEN NULL ELSE CASE {_BEST} END END AS language FROM b""")
def languages(spark, sf):
    return table(spark, sf, "documents").select("doc_id", names.language("source", "text").alias("language"))


# ---- readers ----

@query("SELECT 'n' || n_regionkey AS slice, count(*) AS rows, count(*) FILTER (WHERE n_nationkey % 2 = 0) AS with_url, sum(n_nationkey)::BIGINT AS total FROM nation GROUP BY n_regionkey")
def slice_folder(spark, sf):
    """Slices with columns that drift, an empty one, one with but a header, and one without a file."""
    root, nation = shared_path(spark, "folder"), table(spark, sf, "nation")
    for r in range(5):
        rows = nation.where(f"n_regionkey = {r}").selectExpr("CAST(n_nationkey AS STRING) AS id", *(["CASE WHEN n_nationkey % 2 = 0 THEN concat('https://x.example/', n_nationkey) END AS url"] if r != 3 else ["CASE WHEN n_nationkey % 2 = 0 THEN 'u' END AS url", "'extra' AS more"]))
        sinks.write_text(spark, f"{root}/n{r}/jobs.csv", "\n".join([",".join(rows.columns), *[",".join(x or "" for x in row) for row in rows.collect()]]) + "\n")
    sinks.write_text(spark, f"{root}/none/jobs.csv", "")
    sinks.write_text(spark, f"{root}/head/jobs.csv", "id,url\n")
    out = readers.slices(spark, root)
    return out.groupBy("slice").agg(F.count("*").alias("rows"), F.count("url").alias("with_url"), F.sum(F.col("id").cast("long")).alias("total"))


@query("SELECT n_name AS name, n_nationkey::BIGINT AS key FROM nation")
def keyed_lines(spark, sf):
    path = f"{shared_path(spark, 'lines')}/names.txt"
    rows = table(spark, sf, "nation").select("n_name", "n_nationkey").collect()
    sinks.write_text(spark, path, "\n".join([f"{r.n_name}:{r.n_nationkey:010d}:" for r in rows] + ["", "no number here", ":5:"]))
    return readers.keyed_lines(spark, path)


@query("SELECT r_name AS ticker, n_name AS name, nullif(n_nationkey * 1000.5, 0) AS market_cap, NULL::DOUBLE AS last_sale FROM nation JOIN region ON n_regionkey = r_regionkey")
def screener(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    row = F.struct(F.concat(F.lit(" "), F.lower("r_name")).alias("symbol"), F.col("n_name").alias("name"), F.concat(F.lit("$"), F.format_number(F.col("n_nationkey") * 1000.5, 1)).alias("marketCap"), F.lit("--").alias("lastsale"))
    return readers.screener_rows(n.agg(F.to_json(F.struct(F.struct(F.collect_list(row).alias("rows")).alias("data"))).alias("payload")))


@query("SELECT r_regionkey::VARCHAR AS cik, r_name AS title, NULL::VARCHAR AS gone FROM region")
def columnar_json(spark, sf):
    r = table(spark, sf, "region")
    data = F.collect_list(F.array(F.lit("x"), "r_name", F.col("r_regionkey").cast("string")))
    made = r.agg(data.alias("data")).select(F.to_json(F.struct(F.array(F.lit("other"), F.lit("title"), F.lit("cik")).alias("fields"), "data")).alias("payload"))
    return readers.columnar_rows(made, ["cik", "title", "gone"])


@query("SELECT n_regionkey::VARCHAR AS item, max(n_name) AS name, count(*) AS n FROM nation GROUP BY n_regionkey")
def sparql_bindings(spark, sf):
    nation = table(spark, sf, "nation")
    cell = lambda c: F.struct(F.lit("literal").alias("type"), F.col(c).cast("string").alias("value"))
    b = F.struct(cell("n_regionkey").alias("item"), cell("n_name").alias("name"))
    made = nation.agg(F.to_json(F.struct(F.struct(F.collect_list(b).alias("bindings")).alias("results"))).alias("payload"))
    return readers.binding_rows(made, ["item", "name"], "item", "name").join(nation.groupBy(F.col("n_regionkey").cast("string").alias("item")).agg(F.count("*").alias("n")), "item")


@query("SELECT 'part' || (n_nationkey % 2) || '.tsv' AS member, n_nationkey::VARCHAR AS id, CASE WHEN n_nationkey % 5 > 0 THEN n_name END AS name, NULL::VARCHAR AS gone FROM nation")
def archived_rows(spark, sf):
    root, rows = shared_path(spark, "archive"), table(spark, sf, "nation").select("n_nationkey", "n_name").collect()
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for k in range(2):
            lines = ["NAME\tID" if k else "ID\tNAME"]
            for r in rows:
                if r.n_nationkey % 2 == k:  # rows too short and too long
                    name = r.n_name if r.n_nationkey % 5 else ""
                    lines.append(f"{name}\t{r.n_nationkey}" if k else f"{r.n_nationkey}\t{name}\tmore" if name else f"{r.n_nationkey}")
            z.writestr(f"part{k}.tsv", "\n".join(lines) + "\n")
    made = spark.createDataFrame([(bytearray(held.getvalue()),)], "content binary")
    fs, path = sinks._place(spark, f"{root}/a.zip")
    out = fs.create(path, True)
    out.write(made.head()["content"])
    out.close()
    return readers.zipped_rows(spark, f"{root}/a.zip", "part", ["id", "name", "gone"], ("id",))


@query("""WITH d AS (SELECT lang, source, doc_id % 3 AS m FROM documents), a AS (SELECT count(*) AS n FROM d), b AS (SELECT lang, count(*) AS n FROM d GROUP BY 1), c AS (SELECT lang, source, count(*) AS n FROM d GROUP BY 1, 2),
 e AS (SELECT lang, source, m, count(*) AS n FROM d GROUP BY 1, 2, 3)
 SELECT 0 AS level, NULL::VARCHAR AS lang, NULL::VARCHAR AS source, NULL::VARCHAR AS m, n AS rows FROM a WHERE n <= 60
 UNION ALL SELECT 1, b.lang, NULL, NULL, b.n FROM b, a WHERE a.n > 60 AND b.n <= 60
 UNION ALL SELECT 2, c.lang, c.source, NULL, c.n FROM c JOIN b ON b.lang IS NOT DISTINCT FROM c.lang, a WHERE a.n > 60 AND b.n > 60 AND c.n <= 60
 UNION ALL SELECT 3, e.lang, e.source, e.m::VARCHAR, e.n FROM e JOIN c ON c.lang IS NOT DISTINCT FROM e.lang AND c.source IS NOT DISTINCT FROM e.source WHERE c.n > 60""")
def facet_plan(spark, sf):
    return readers.facet_plan(table(spark, sf, "documents").selectExpr("lang", "source", "doc_id % 3 AS m"), ["lang", "source", "m"], 60)


# ---- sinks ----

@query("""WITH p AS (SELECT n_regionkey AS r, count(*) AS targets, sum(CASE WHEN n_nationkey % 4 = 0 THEN 0 ELSE n_nationkey END) AS found, count(*) FILTER (WHERE n_nationkey % 4 = 0) AS error, count(*) FILTER (WHERE n_nationkey % 4 = 1) AS missing FROM nation GROUP BY 1)
 SELECT 'r' || r AS source, CASE WHEN r = 4 AND error > 0 THEN 'streaming_failed' WHEN r = 3 AND found = 0 THEN 'empty' WHEN (CASE WHEN r % 2 = 1 THEN error ELSE 0 END) + (CASE WHEN r = 2 THEN missing ELSE 0 END) > 0 THEN 'shards_failed'
 WHEN found = 0 AND error >= greatest(1, (targets + 1) // 2) THEN 'failed' ELSE 'publish' END AS verdict FROM p""")
def run_verdicts(spark, sf):
    n = table(spark, sf, "nation")
    runs = n.selectExpr("concat('r', n_regionkey) AS source", "CASE n_nationkey % 4 WHEN 0 THEN 'error' WHEN 1 THEN 'not_found' ELSE 'ok' END AS status", "CASE WHEN n_nationkey % 4 = 0 THEN 0 ELSE n_nationkey END AS rows")
    policies = n.select("n_regionkey").distinct().selectExpr("concat('r', n_regionkey) AS source", "n_regionkey = 4 AS streaming", "n_regionkey = 3 AS fail_closed_on_empty", "n_regionkey % 2 = 1 AS fail_closed_on_any_error", "n_regionkey = 2 AS fail_closed_on_not_found")
    return sinks.verdicts(runs, policies)


@query(f"{_L}, s AS (SELECT ats_type, count(*) AS rows FROM l GROUP BY 1) SELECT ats_type, rows, rows AS parquet_rows, rows AS csv_rows, 2 AS files FROM s")
def published_both_ways(spark, sf):
    root = shared_path(spark, "published")
    rows = listings(spark, sf).select("ats_type", "seq", "title")
    sinks.publish_all(rows, root, "2024-05-01", True)
    made = sinks.publish_all(rows.where("seq >= 0"), root, "2024-06-01")
    held = spark.createDataFrame([(s, e["rows"], int("size_bytes" in e) + int("csv" in e)) for s, e in made["by_ats"].items()], "ats_type string, rows long, files int")
    parquet = spark.read.parquet(made["all"]["parquet"]).groupBy("ats_type").agg(F.count("*").alias("parquet_rows"))
    csv = readers.text_csv(spark, made["all"]["csv"]).groupBy(F.col("slice").alias("ats_type")).agg(F.count("*").alias("csv_rows"))
    return held.join(parquet, "ats_type").join(csv, "ats_type")


# ---- what runs leave behind ----

@query("""WITH r AS (SELECT user_id AS batch_id, event_id AS moment, CASE event_type WHEN 'click' THEN 'submitted' WHEN 'view' THEN 'running' WHEN 'purchase' THEN 'completed' ELSE 'failed' END AS status FROM events)
 SELECT batch_id, arg_max(status, moment) AS status, min(moment) AS submitted_at, CASE WHEN arg_max(status, moment) IN ('completed', 'failed') THEN max(moment) END AS completed_at FROM r GROUP BY batch_id""")
def batch_states(spark, sf):
    kind = F.when(F.col("event_type") == "click", "submitted").when(F.col("event_type") == "view", "running").when(F.col("event_type") == "purchase", "completed").otherwise("failed")
    rows = table(spark, sf, "events").select(F.col("user_id").alias("batch_id"), F.lit("s").alias("shard"), kind.alias("status"), F.col("event_id").alias("at"))
    return lifecycle.batches(rows).drop("shard")


@query("""SELECT l_returnflag AS stage, l_linestatus AS model_id, count(*) AS calls, sum(l_partkey)::BIGINT AS input_tokens, sum(l_suppkey)::BIGINT AS output_tokens,
 CASE WHEN l_linestatus = 'O' THEN round(sum((l_partkey * 2.0 + l_suppkey * 8.0) / 1e6 * CASE WHEN l_linenumber % 2 = 0 THEN 0.5 ELSE 1.0 END), 6) END AS cost_usd FROM lineitem GROUP BY 1, 2""")
def call_costs(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("stage"), F.col("l_linestatus").alias("model_id"), (F.col("l_linenumber") % 2 == 0).alias("batched"), F.lit(1).alias("calls"), F.col("l_partkey").alias("input_tokens"), F.col("l_suppkey").alias("output_tokens"))
    prices = spark.createDataFrame([("O", 2.0, 8.0)], "model_id string, input_price double, output_price double")
    return lifecycle.costs(rows, prices).withColumn("cost_usd", F.round("cost_usd", 6))


@query("""SELECT doc_id, CASE WHEN length(trim(coalesce(left(text, 300), ''))) >= 200 THEN 'head' WHEN length(trim(coalesce(text, ''))) >= 200 THEN 'whole' END AS tool,
 CASE WHEN length(trim(coalesce(left(text, 300), ''))) >= 200 THEN 1 ELSE 2 END AS tried FROM documents""")
def recovery(spark, sf):
    docs = table(spark, sf, "documents")
    return lifecycle.recovered(docs, [("head", F.substring("text", 1, 300)), ("whole", F.col("text"))]).select("doc_id", "tool", "tried")


@query("""WITH w AS (SELECT doc_id, lang FROM documents), c AS (SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN NULL ELSE 'p' || doc_id END AS page FROM documents WHERE doc_id % 3 = 0)
 SELECT w.doc_id FROM w WHERE doc_id NOT IN (SELECT doc_id FROM c)""")
def pages_to_fetch(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    crawled = docs.where("doc_id % 3 = 0").selectExpr("doc_id", "CASE WHEN doc_id % 6 = 0 THEN NULL ELSE concat('p', doc_id) END AS page")
    return lifecycle.to_fetch(docs, crawled, ["doc_id"])


@query("""SELECT doc_id, coalesce(CASE WHEN doc_id % 3 = 0 THEN lang END, CASE WHEN doc_id % 5 > 1 THEN 'c' || doc_id END) AS lang FROM documents""")
def replayed_answers(spark, sf):
    docs = table(spark, sf, "documents")
    cache = docs.selectExpr("doc_id", "CASE WHEN doc_id % 5 = 0 THEN 'broken' ELSE concat('{\"lang\": \"c', doc_id, '\"}') END AS payload").where("doc_id % 5 <> 1")
    rows = docs.selectExpr("doc_id", "CASE WHEN doc_id % 3 = 0 THEN lang END AS lang")
    return lifecycle.replayed(rows, cache, ["doc_id"], "lang string", ["lang"]).select("doc_id", "lang")


# ---- filings ----

@query(f"""WITH r AS (SELECT CASE WHEN o_custkey % 9 = 0 THEN '12-345' ELSE lpad(o_custkey::VARCHAR, 9, '0') END AS ein, o_orderkey AS k, (round(o_totalprice)::BIGINT % 7000) AS cur, CASE WHEN o_orderkey % 4 = 0 THEN 3 ELSE o_custkey % 900 + 500 END AS boy,
   CASE WHEN o_orderkey % 11 = 0 THEN '813930' ELSE '541511' END AS code, CASE WHEN o_orderkey % 5 = 0 THEN '1' ELSE '2' END AS ent, substr(o_orderdate::VARCHAR, 1, 10) AS as_of FROM orders),
 k AS (SELECT *, nullif(cur, 0) AS c, nullif(boy, 0) AS b FROM r WHERE ent = '2' AND length(ein) = 9 AND code <> '813930'),
 g AS (SELECT ein, coalesce(c, b) AS participants, as_of FROM k WHERE NOT coalesce(greatest(c, b) > 1000 AND greatest(c, b) > least(c, b) * 50.0 AND c IS NOT NULL AND b IS NOT NULL, false))
 SELECT ein, max(participants) AS participants, as_of FROM (SELECT *, max(as_of) OVER (PARTITION BY ein) AS newest FROM g) WHERE as_of = newest GROUP BY ein, as_of""")
def plan_sponsors(spark, sf):
    o = table(spark, sf, "orders")
    rows = o.selectExpr("CASE WHEN o_custkey % 9 = 0 THEN '12-345' ELSE lpad(CAST(o_custkey AS STRING), 9, '0') END AS ein", "concat('Firm number ', o_custkey) AS sponsor", "CAST(CAST(round(o_totalprice) AS BIGINT) % 7000 AS STRING) AS active_current",
                        "CAST(CASE WHEN o_orderkey % 4 = 0 THEN 3 ELSE o_custkey % 900 + 500 END AS STRING) AS active_boy", "CASE WHEN o_orderkey % 11 = 0 THEN ' 813930' ELSE '541511' END AS business_code", "CASE WHEN o_orderkey % 5 = 0 THEN '1' ELSE '\"2\"' END AS entity_code",
                        "'tx' AS state", "'' AS state_alt", "concat(CAST(CAST(o_orderdate AS DATE) AS STRING), 'T00') AS tax_period")
    own = filings.plan_sponsors(rows, "2")
    newest = own.groupBy("ein").agg(F.max("as_of").alias("as_of"))
    return own.join(newest, ["ein", "as_of"]).groupBy("ein", "as_of").agg(F.max("participants").alias("participants"))


@query("""WITH p AS (SELECT 'supplierno' || (l_suppkey % 50) AS name_key, l_partkey AS employees, l_quantity * 400 AS hours, l_returnflag AS state FROM lineitem)
 SELECT name_key, sum(employees)::BIGINT AS floor, count(*) AS establishments, string_agg(DISTINCT state, ',' ORDER BY state) AS states FROM p WHERE employees BETWEEN 1 AND 25000 AND NOT (hours > 0 AND hours / employees < 20) GROUP BY name_key""")
def work_place_floors(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr("concat('Supplier No. ', l_suppkey % 50, ', Inc.') AS company_name", "'x' AS establishment_name", "CAST(l_partkey AS STRING) AS employees", "CAST(l_quantity * 400 AS STRING) AS hours", "l_returnflag AS state")
    return filings.place_floors(filings.work_places(rows)).select("name_key", "floor", "establishments", F.array_join("states", ",").alias("states"))


@query("""WITH f AS (SELECT o_custkey AS root, o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) END AS d, o_totalprice FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderpriority <> '1-URGENT')
 SELECT root, o_orderkey AS filing_id, d::VARCHAR AS filed FROM (SELECT *, row_number() OVER (PARTITION BY root ORDER BY d DESC NULLS LAST, o_orderkey DESC) AS rn FROM f) WHERE rn = 1""")
def last_offerings(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_custkey AS root", "o_orderkey AS filing_id", "CASE WHEN o_orderkey % 10 = 0 THEN ' test' WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'LIVE' END AS testorlive", "CASE WHEN o_orderpriority = '1-URGENT' THEN 'true' ELSE '0' END AS is_pooled_fund", "CAST(NULL AS STRING) AS is_40_act",
                                                "'Biotech' AS industry", "'' AS fund_type", "CASE WHEN o_orderkey % 4 = 0 THEN upper(date_format(CAST(o_orderdate AS DATE), 'dd-MMM-yyyy')) WHEN o_orderkey % 2 = 0 THEN concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 10:00') ELSE 'soon' END AS filing_date", "CAST(o_totalprice AS STRING) AS amount")
    return filings.last_amendments(filings.offerings(rows), "root", "filing_id").select("root", "filing_id", F.col("filed").cast("string").alias("filed"))


@query("""SELECT c_mktsegment AS stratum, count(*) AS labelled, count(*) FILTER (WHERE c_custkey % 4 = 0) AS wrong, count(*) FILTER (WHERE c_custkey % 4 IN (1, 2)) AS correct,
 count(*) FILTER (WHERE c_custkey % 4 IN (1, 2)) / count(*) FILTER (WHERE c_custkey % 4 < 3) AS precision FROM customer GROUP BY 1""")
def match_precision(spark, sf):
    rows = table(spark, sf, "customer").selectExpr("c_mktsegment AS stratum", "CASE c_custkey % 4 WHEN 0 THEN 'wrong' WHEN 3 THEN 'ambiguous' ELSE 'correct' END AS verdict")
    return filings.precision(rows, "stratum")


@query("""SELECT n_nationkey AS id, CASE WHEN n_nationkey % 3 = 0 THEN 'T' || n_nationkey WHEN n_regionkey < 3 THEN 'P' || n_regionkey END AS ticker, CASE WHEN n_nationkey % 3 = 0 THEN 'self' WHEN n_regionkey < 3 THEN 'parent' END AS basis FROM nation""")
def subsidiaries(spark, sf):
    tenants = table(spark, sf, "nation").selectExpr("n_nationkey AS id", "concat('k', n_regionkey) AS name_key", "CASE WHEN n_nationkey % 3 = 0 THEN concat('T', n_nationkey) END AS ticker")
    parents = table(spark, sf, "region").where("r_regionkey < 3").selectExpr("concat('k', r_regionkey) AS name_key", "r_name AS parent", "concat('P', r_regionkey) AS ticker")
    both = table(spark, sf, "region").where("r_regionkey = 3").selectExpr("concat('k', r_regionkey) AS name_key", "r_name AS parent", "explode(array('X', 'Y')) AS ticker")
    return filings.subsidiaries_up(tenants, parents.unionByName(both)).select("id", "ticker", "basis")


@query("SELECT event_type AS name, count(*) AS rows FROM events GROUP BY 1 ORDER BY rows DESC, name")
def counts_in_order(spark, sf):
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("name")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "name")


@query("SELECT DISTINCT name, key FROM (SELECT n_name AS name, n_nationkey AS key FROM nation UNION ALL SELECT r_name, r_regionkey FROM region UNION ALL SELECT n_name, n_nationkey FROM nation)")
def stacked_once(spark, sf):
    n, r = table(spark, sf, "nation").selectExpr("n_name AS name", "n_nationkey AS key"), table(spark, sf, "region").selectExpr("r_name AS name", "r_regionkey AS key")
    return n.unionByName(r).unionByName(n).distinct()


@query("SELECT regexp_replace(lower(n_name), '[^a-z0-9]', '', 'g') AS name_key, sum(c_acctbal) AS total FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def sums_by_name_key(spark, sf):
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy(tx.name_key("n_name").alias("name_key")).agg(F.sum("c_acctbal").alias("total"))


# ---- places and pages ----

@query("""WITH n AS (SELECT lower(n_name) AS name, 'R' || n_regionkey AS country, n_nationkey * 1.5 AS lat, n_nationkey * 2.5 AS lon, n_nationkey * 10 AS population FROM nation), r AS (SELECT lower(r_name) AS name, 'R' || r_regionkey AS country FROM region),
 c AS (SELECT c_custkey, lower(a.n_name) AS town, CASE c_custkey % 4 WHEN 1 THEN 'R' || a.n_regionkey WHEN 2 THEN 'R' || (c_custkey % 5) WHEN 3 THEN 'R' || (c_custkey % 5) END AS said, c_custkey % 4 AS kind FROM customer JOIN nation a ON c_nationkey = a.n_nationkey),
 seat AS (SELECT country, arg_max(lat, population) AS lat, arg_max(lon, population) AS lon FROM n GROUP BY country)
 SELECT c_custkey, coalesce(said, n.country) AS country, CASE WHEN kind < 3 AND (said IS NULL OR said = n.country) THEN n.lat ELSE seat.lat END AS lat, CASE WHEN kind < 3 AND (said IS NULL OR said = n.country) THEN 'city' ELSE 'country' END AS precision
 FROM c JOIN n ON n.name = c.town JOIN seat ON seat.country = coalesce(said, n.country)""")
def places_resolved(spark, sf):
    """Towns with no country, the right one, any one, and countries alone."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    cities = nation.selectExpr("lower(n_name) AS name", "concat('R', n_regionkey) AS country", "n_nationkey * 1.5D AS lat", "n_nationkey * 2.5D AS lon", "n_nationkey * 10 AS population")
    countries = region.selectExpr("lower(r_name) AS token", "concat('R', r_regionkey) AS country")
    own = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr("n_nationkey", "n_name", "r_name AS own")
    rows = table(spark, sf, "customer").join(own, F.col("c_nationkey") == F.col("n_nationkey")).join(region.selectExpr("r_regionkey AS k", "r_name AS other"), F.col("c_custkey") % 5 == F.col("k"))
    place = F.when(F.col("c_custkey") % 4 == 0, F.col("n_name")).when(F.col("c_custkey") % 4 == 1, F.concat_ws(", ", "n_name", "own")).when(F.col("c_custkey") % 4 == 2, F.concat_ws(" / ", "n_name", "other")).otherwise(F.col("other"))
    return gazetteer.resolved(rows.select("c_custkey", place.alias("place")), "place", countries, cities).select("c_custkey", "country", "lat", "precision")


@query()
def page_descriptions(spark, sf):
    """What each page says of itself, over whole pages; tests hold it against pages of all kinds."""
    return table(spark, sf, "pages").select("page_id", "url", prose.page_description(F.col("html")).alias("description"))


# ---- joins, caches, scores ----

@query("SELECT l_orderkey, l_linenumber, o_custkey, o_orderstatus FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderkey % 3 > 0")
def checked_join(spark, sf):
    orders = table(spark, sf, "orders").where("o_orderkey % 3 > 0").selectExpr("o_orderkey AS l_orderkey", "o_custkey", "o_orderstatus")
    return groups.joined_once(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), orders, ["l_orderkey"])


@query("""WITH t AS (SELECT * FROM documents WHERE length(text) BETWEEN 400 AND 20000)
 SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM t) WHERE rn <= 6""")
def tenant_samples(spark, sf):
    return groups.samples(table(spark, sf, "documents").select("source", "doc_id", "text"), ["source"], "text", "doc_id").select("source", "doc_id")


@query("""WITH c AS (SELECT 'a' || doc_id AS key, 'first' || doc_id AS v FROM documents WHERE doc_id % 4 = 0 UNION ALL SELECT 'u' || doc_id, 'second' || doc_id FROM documents WHERE doc_id % 3 = 0)
 SELECT d.doc_id, coalesce(a.v, u.v) AS description FROM documents d LEFT JOIN c a ON d.doc_id % 5 > 0 AND a.key = 'a' || d.doc_id LEFT JOIN c u ON u.key = 'u' || d.doc_id""")
def cached_under_any_key(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    text = F.col("doc_id").cast("string")
    cache = docs.where("doc_id % 4 = 0").select(F.concat(F.lit("a"), text).alias("key"), F.concat(F.lit("first"), text).alias("description")).unionByName(docs.where("doc_id % 3 = 0").select(F.concat(F.lit("u"), text).alias("key"), F.concat(F.lit("second"), text).alias("description")))
    return state.first_cached(docs, cache, [F.when(F.col("doc_id") % 5 > 0, F.concat(F.lit("a"), text)).otherwise(""), F.concat(F.lit("u"), text)], "description")


@query("""WITH p AS (SELECT lang, CASE WHEN doc_id % 6 = 0 THEN NULL ELSE source END AS w1, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN 'zz' ELSE upper(source) END AS g1, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 1000.0 + doc_id END AS w2, 1000.0 + doc_id + doc_id % 40 AS g2, doc_id % 9 AS w3, doc_id % 7 AS g3 FROM documents),
 o AS (SELECT lang, 'source' AS field, CASE WHEN w1 IS NULL THEN CASE WHEN g1 IS NULL THEN 'correct_abstain' ELSE 'over_claimed' END WHEN g1 IS NULL THEN 'missed' WHEN upper(w1) = upper(g1) THEN 'hit' ELSE 'wrong' END AS outcome FROM p
  UNION ALL SELECT lang, 'pay', CASE WHEN w2 IS NULL THEN 'over_claimed' WHEN abs(w2 - g2) <= w2 * 0.02 THEN 'hit' ELSE 'wrong' END FROM p UNION ALL SELECT lang, 'years', CASE WHEN w3 = g3 THEN 'hit' WHEN abs(w3 - g3) <= 1 THEN 'near' ELSE 'wrong' END FROM p)
 SELECT lang, field, outcome, count(*) AS rows FROM o GROUP BY ALL""")
def graded_fields(spark, sf):
    rows = table(spark, sf, "documents").selectExpr("lang", "CASE WHEN doc_id % 6 = 0 THEN NULL ELSE source END AS want_source", "CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN 'zz' ELSE upper(source) END AS got_source",
                                                    "CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 1000.0D + doc_id END AS want_pay", "1000.0D + doc_id + doc_id % 40 AS got_pay", "doc_id % 9 AS want_years", "doc_id % 7 AS got_years")
    return profile.graded(rows, {"source": ("text",), "pay": ("money", 0.02), "years": ("number", 1)}, ["lang"])


@query(f"{_L} SELECT seq, regexp_matches(description, '{classify.PAY_HINT}') AND salary_min IS NULL AS hinted FROM l")
def pay_hints(spark, sf):
    return listings(spark, sf).select("seq", classify.hinted(F.col("salary_min").isNull()).isNotNull().alias("hinted"))


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1")
def registered_relations(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("held_orders")
    table(spark, sf, "customer").createOrReplaceTempView("held_customers")
    return spark.sql("SELECT o_orderstatus, count(*) AS n FROM held_orders WHERE o_custkey IN (SELECT c_custkey FROM held_customers WHERE c_acctbal > 0) GROUP BY 1")


# ---- sites ----

_LABELS = [*fixed.CAREER_LABELS, "news", "blog", "shop", "eu"]
_SITE = f"CASE doc_id % 3 WHEN 0 THEN 'https://' WHEN 1 THEN 'HTTP://' ELSE '' END || CASE CAST(floor(doc_id / 3) AS BIGINT) % {len(_LABELS)} " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(_LABELS)) + " END || '.' || CASE doc_id % 4 WHEN 0 THEN 'firm' || CAST(doc_id AS VARCHAR(9)) || '.example' WHEN 1 THEN 'Firm' || CAST(doc_id AS VARCHAR(9)) || '.co.uk' WHEN 2 THEN 'firm.breezy.hr' ELSE 'jobs.firm' || CAST(doc_id AS VARCHAR(9)) || '.com' END || '/a?b'"


@query(f"""WITH s AS (SELECT doc_id, {_SITE} AS url FROM documents), h AS (SELECT doc_id, url, regexp_replace(regexp_extract(lower(url), '^(?:https?://)?([^/]+)', 1), '^www\\.', '') AS host FROM s)
 SELECT doc_id, CASE WHEN ends_with(host, '.breezy.hr') THEN NULL WHEN split_part(host, '.', 1) IN ({_in(fixed.CAREER_LABELS)}) AND doc_id % 4 = 3 THEN regexp_replace(host, '^(?:[^.]+\\.)?jobs\\.', '')
  WHEN doc_id % 4 < 2 AND split_part(host, '.', 1) IN ({_in(fixed.CAREER_LABELS)}) THEN regexp_replace(host, '^[^.]+\\.', '') ELSE host END AS domain FROM h""")
def employers_domains(spark, sf):
    rows = table(spark, sf, "documents").selectExpr("doc_id", f"{_SITE} AS url")
    return rows.select("doc_id", sites.corporate_domain("url").alias("domain"))


@query()
def page_links(spark, sf):
    """Of each page the employer's domain that it gives and the careers page that it links to; tests hold both against pages."""
    rows = table(spark, sf, "pages").withColumn("own", sites.corporate_domain("url"))
    return rows.select("page_id", "own", sites.careers_link(F.col("html"), F.col("url"), F.col("own")).alias("careers"), sites.employer_domain(F.col("html"), F.col("url"), F.split_part(F.col("own"), F.lit("."), F.lit(1))).alias("domain"))


# ---- streams ----

@query("SELECT event_type, CAST(time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01') AS VARCHAR) AS opened, count(*) AS rows, sum(event_id)::BIGINT AS value FROM events GROUP BY 1, 2")
def stream_windows(spark, sf):
    root = shared_path(spark, "stream")
    events = table(spark, sf, "events").selectExpr("event_type", "CAST(ts AS TIMESTAMP) AS ts", "event_id AS value")
    events.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
    ingest.run_available(ingest.counted(stream, "ts", "6 hours", "1 day", "event_type"), f"{root}/progress", lambda batch, n: batch.write.mode("overwrite").parquet(f"{root}/out"), "complete")
    rows = spark.read.parquet(f"{root}/out")
    return rows.select("event_type", F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("opened"), "rows", "value")
