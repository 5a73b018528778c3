"""python -m rolemill: lists the operators, runs one over a folder of tables, searches or profiles listings, reads saved payloads."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from rolemill import more_queries, rule_queries  # noqa: F401 - they register in the same tables
from rolemill.operators import profile, search
from rolemill.queries import QUERIES
from rolemill.sources import payloads


def parser() -> argparse.ArgumentParser:
    whole = argparse.ArgumentParser(prog="rolemill", description=__doc__)
    commands = whole.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of all operators")
    one = commands.add_parser("run", help="one operator over a folder of Parquet tables")
    one.add_argument("name", choices=sorted(QUERIES))
    one.add_argument("tables")
    found = commands.add_parser("search", help="rows of a Parquet table of listings")
    found.add_argument("listings")
    for option in ("query", "location", "company", "ats"):
        found.add_argument(f"--{option}")
    for option in ("salary-min", "salary-max"):
        found.add_argument(f"--{option}", type=float)
    found.add_argument("--remote", action=argparse.BooleanOptionalAction, default=None)
    shares = commands.add_parser("profile", help="how much of each column is blank")
    shares.add_argument("listings")
    shares.add_argument("--by", nargs="*", default=[])
    read = commands.add_parser("payloads", help="postings of saved payloads, lines of JSON with source, company and payload")
    read.add_argument("path")
    for each in (one, found, shares, read):
        each.add_argument("--out", help="a folder for Parquet; without it, some rows are shown")
    return whole


def result(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    if options.command == "run":
        return QUERIES[options.name](spark, options.tables)
    if options.command == "search":
        given = {k: getattr(options, k) for k in ("query", "location", "company", "ats", "remote", "salary_min", "salary_max") if getattr(options, k) is not None}
        return search.search(spark.read.parquet(options.listings), **given)
    if options.command == "profile":
        rows = spark.read.parquet(options.listings)
        return profile.gaps(rows, [c for c in rows.columns if c not in options.by], options.by)
    return payloads.mixed_postings(payloads.read_payloads(spark, options.path))


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    options = parser().parse_args(arguments)
    if options.command == "list":
        print("\n".join(sorted(QUERIES)))
        return
    found = result(spark or SparkSession.builder.appName("rolemill").getOrCreate(), options)
    if options.out:
        found.write.parquet(options.out)
    else:
        found.show(truncate=60)


if __name__ == "__main__":
    main()
