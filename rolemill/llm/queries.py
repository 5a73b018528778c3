"""The operators as queries over the whole tables, and the same in SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolemill.llm import exact_dedup, language_id, lm_scoring, mixing, ngram_join, packing, quality_classifier, quality_rules, repeat_removal, secrets
from rolemill.llm.common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scanned(table(spark, sf_dir, "documents"))


def op2_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_removal.without_repeats(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.trained(*quality_classifier.sample(docs, table(spark, sf_dir, "labels")))
    return quality_classifier.scored(docs, model)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identified(docs, language_id.trained(*language_id.sample(docs)))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.drawn(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    words = lm_scoring.words(docs)
    vocabulary = lm_scoring.vocabulary(words)
    return lm_scoring.scored(docs, lm_scoring.trained(docs, vocabulary), vocabulary, words)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.judged(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_repeat_removal, op3_best_fit_packing, op4_exact_dedup, op5_quality_classifier, op6_language_id, op7_source_mixing, op8_lm_scoring, op9_ngram_join, op10_quality_rules)}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE = {
    "op4_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)""",
    "op7_source_mixing": rf"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
         -ln((('0x' || substr(md5(doc_id::VARCHAR), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
         / greatest(0.1, 1.0 - 10.0 * len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) / greatest(length(coalesce(text, '')), 1)) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT]::DOUBLE AS w,
             source_size::DOUBLE * 2 AS cap FROM s),
c AS (SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5 AS total,
             coalesce(sum(cap) OVER before, 0.0) AS caps_before,
             sum(w) OVER () - coalesce(sum(w) OVER before, 0.0) AS weight_left
      FROM r WINDOW before AS (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min((total - caps_before) / weight_left, caps_before) AS level FROM c
      WHERE (total - caps_before) / weight_left * w <= cap),
t AS (SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(level * w, cap) END AS target FROM c, l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN least(2, floor(target / source_size)) ELSE 0 END::BIGINT AS epochs FROM t),
p AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS budget,
             coalesce(sum(d.size) OVER (PARTITION BY e.source ORDER BY d.k, d.doc_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       (least(2, epochs + CASE WHEN start < budget AND start + size / 2 <= budget THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM p""",
    "op9_ngram_join": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 4 THEN [array_to_string(words[i:i + 3], ' ') FOR i IN range(1, len(words) - 2)]
                                          WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.size + y.size - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.size, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m.low, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS low FROM r GROUP BY a) m ON m.a = d.doc_id""",
    "op10_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
l AS (SELECT doc_id, text, words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
m AS (SELECT doc_id, text, lines, len(words)::BIGINT AS n_words, length(list_aggregate(words, 'string_agg', ''))::BIGINT AS chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines
      FROM l),
w AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
f AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM w),
g AS (SELECT doc_id, least(3, lead(i, 1, i + 3) OVER (PARTITION BY doc_id ORDER BY i) - i) AS covered FROM f WHERE n > 1),
r AS (SELECT doc_id, sum(covered)::BIGINT AS n_repeat_words FROM g GROUP BY doc_id),
b AS (SELECT m.*, coalesce(chars, 0)::BIGINT AS word_chars, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed
      FROM m LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 8 * word_chars OR 100 * n_dup_lines > 40 * len(lines)
            OR 100 * len(regexp_extract_all(text, '\p{{Lu}}')) > 50 * word_chars
            OR 100 * len(regexp_extract_all(text, '[0-9]')) > 40 * word_chars
            OR word_chars > 25 * n_words OR 2 * word_chars < 3 * n_words) AS kept
FROM b""",
}
