"""The driver's tables seen as postings, companies and filings; the same expressions serve Spark and the SQL oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolemill.functions.text import upper_each

#: Source, title, place and pay of a posting, told from a document's id, text and language.
LISTING = {
    "seq": "doc_id",
    "ats_type": "CASE doc_id % 9 WHEN 0 THEN 'greenhouse' WHEN 1 THEN 'lever' WHEN 2 THEN 'welcometothejungle' WHEN 3 THEN 'eightfold' WHEN 4 THEN 'eures' WHEN 5 THEN 'builtin' WHEN 6 THEN 'seek' WHEN 7 THEN 'infojobs_es' ELSE 'workday' END",
    "url": "'https://jobs.example.org/' || CAST(CASE WHEN doc_id % 40 = 7 THEN doc_id - 7 ELSE doc_id END AS VARCHAR(20))",
    "title": "regexp_extract(text, '^[^ ]+( [^ ]+){0,2}', 0) || CASE WHEN doc_id % 5 = 0 THEN ' (m/w/d)' WHEN doc_id % 11 = 0 THEN ' (m/w/d) (Code X)' WHEN doc_id % 9 = 2 THEN ' (Team)' ELSE ', Team' END",
    "company": "CASE WHEN doc_id % 53 = 0 THEN 'n/a' WHEN doc_id % 59 = 0 THEN 'jobs.acme.com' ELSE 'Firm ' || upper(substr(text, 1, 2)) || CASE WHEN doc_id % 2 = 0 THEN ', Inc.' ELSE ' INC' END END",
    "location": "CASE WHEN doc_id % 17 = 0 THEN 'Remote - US' WHEN lang = 'en' THEN 'Austin, TX' WHEN lang = 'fr' THEN 'Paris, France' WHEN lang = 'de' THEN 'DE (DE300)' ELSE 'Madrid, Spain' END",
    "country_iso": "CASE WHEN doc_id % 3 = 0 THEN '' WHEN lang = 'en' THEN 'US' WHEN lang = 'fr' THEN 'FR' WHEN lang = 'de' THEN 'DE' ELSE 'ES' END",
    "ats_id": "CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'j' || CAST(length(text) AS VARCHAR(20)) END",
    "is_remote": "CASE doc_id % 5 WHEN 0 THEN true WHEN 1 THEN false ELSE NULL END",
    "salary_min": "CAST(CASE WHEN doc_id % 4 = 1 THEN 30000 + doc_id % 100 * 1000 WHEN doc_id % 97 = 2 THEN 9000000 ELSE NULL END AS DOUBLE)",
    "salary_max": "CAST(CASE WHEN doc_id % 4 = 1 THEN 50000 + doc_id % 100 * 1000 ELSE NULL END AS DOUBLE)",
    "salary_currency": "CASE WHEN doc_id % 2 = 0 THEN 'USD' ELSE 'SEK' END",
    "salary_period": "CASE WHEN doc_id % 6 = 5 THEN 'HOUR' ELSE 'YEAR' END",
    "salary_summary": "CASE WHEN doc_id % 31 = 0 THEN '$65.00 per hour' WHEN doc_id % 4 = 1 THEN '$30K - $50K per year' ELSE '' END",
    "commitment": "CASE doc_id % 6 WHEN 0 THEN 'Full-time' WHEN 1 THEN 'Teilzeit' WHEN 2 THEN 'Internship' WHEN 3 THEN 'CDD' WHEN 4 THEN 'Contract' ELSE NULL END",
    "employment_type": "CAST(NULL AS VARCHAR(20))",
    "experience": "CASE WHEN doc_id % 3 = 0 THEN CAST(doc_id % 12 AS INT) ELSE NULL END",
    "posted_at": "CASE WHEN doc_id % 41 = 0 THEN '2031-01-01T00:00:00' WHEN doc_id % 43 = 0 THEN 'soon' ELSE '2024-05-0' || CAST(1 + doc_id % 9 AS VARCHAR(20)) || 'T08:00:00' END",
    "description": "text",
    "language": "lang",
}
LISTINGS_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in LISTING.items()) + " FROM documents WHERE text IS NOT NULL"
#: What the gates and the clock of all runs compare with.
NOW = "2024-06-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LISTINGS_SQL on Spark, whose own upper() makes two letters of some."""
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL").withColumn("initials", upper_each(F.substring("text", 1, 2)))
    return docs.selectExpr(*[f"{e.replace('upper(substr(text, 1, 2))', 'initials')} AS {c}" for c, e in LISTING.items()])
