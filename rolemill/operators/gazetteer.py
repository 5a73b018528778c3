"""Places out of free text, by joins with tables of places: country, coordinates, and how exact they are.

The tables are the caller's: countries (token, country), which has codes and names, and cities (name, country, lat, lon,
population); tokens and names are folded, as keys.folded() does. Each distinct location is resolved once. It is exploded into
tokens, and tokens meet the tables in joins; nothing is held in Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolemill.functions import fixed
from rolemill.functions.keys import folded


def _tokens(distinct: DataFrame) -> DataFrame:
    """text, at, token (folded) and upper: the pieces of each location, and each again without what is in parentheses."""
    bare = F.trim(F.regexp_replace("text", r"\b\d{4,6}(?:-\d{4})?\b", " "))
    chunks = F.filter(F.transform(F.split(bare, r"[,;/|]|\s+-\s+"), lambda c: F.trim(c)), lambda c: c != "")
    both = F.flatten(F.transform(chunks, lambda c: F.array(c, F.trim(F.regexp_replace(c, r"\([^)]*\)", " ")))))
    rows = distinct.select("text", F.posexplode(F.array_distinct(F.filter(both, lambda c: c != ""))).alias("at", "chunk"))
    return rows.select("text", "at", folded("chunk").alias("token"), F.upper(F.trim("chunk")).alias("upper"))


def resolved(df: DataFrame, location: str, countries: DataFrame, cities: DataFrame) -> DataFrame:
    """df with country, lat, lon, precision (city, admin1 or country) and placeless; null where no place is found.

    A country's name of four letters or more decides first, the longest one; then a region code such as DE (DE300); then the
    largest city, which has to lie in the country if one is known; last the codes and names of states and short codes of
    countries. A place without a city has the coordinates of its country's largest one.
    """
    distinct = df.select(F.col(location).alias("text")).where(F.trim(location) != "").distinct()
    names = countries.groupBy("token").agg(F.min("country").alias("country"))
    regions = names.where(F.length("token") == 2).select(F.upper("token").alias("code"), F.col("country").alias("by_region"))
    code = F.regexp_extract("upper", r"^([A-Z]{2})(?:\s*\([A-Z]{2}[A-Z0-9]{1,3}\)|(?=[A-Z0-9]{0,2}\d)[A-Z0-9]{1,3})$", 1)
    tokens = _tokens(distinct).join(names, "token", "left").withColumn("code", code).join(regions, "code", "left")
    state = F.when(F.col("upper").isin(*fixed.STATES) | F.col("token").isin(*fixed.STATES.values()), "US").when(F.col("upper").isin(*fixed.PROVINCES), "CA")
    tokens = tokens.withColumns({"spelt": F.when(F.length("token") >= 4, F.col("country")), "state": state, "short": F.when(F.length("token") < 4, F.col("country"))})
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("at")))
    told = tokens.groupBy("text").agg(
        F.max_by(F.struct("spelt", "token"), F.when(F.col("spelt").isNotNull(), F.struct(F.length("token"), -F.col("at")))).alias("named"),
        first("by_region").alias("by_region"), first("state").alias("state"), first("short").alias("short"),
        F.max(F.col("token").isin(*fixed.PLACELESS)).alias("placeless"),
    )
    told = told.withColumn("known", F.coalesce("named.spelt", "by_region"))
    largest = F.struct("population", "name")
    biggest = cities.groupBy("name").agg(F.max_by(F.struct("country", "lat", "lon", "population"), F.struct("population", "country")).alias("city"))
    hits = tokens.select("text", "token").distinct().join(told.select("text", "known", "named"), "text").where(~F.col("token").eqNullSafe(F.col("named.token")))
    hits = hits.join(biggest, F.col("token") == F.col("name")).where(F.col("known").isNull() | (F.col("city.country") == F.col("known")))
    cited = hits.groupBy("text").agg(F.max_by("city", F.struct("city.population", "name")).alias("city"))
    seats = cities.groupBy(F.col("country").alias("seat")).agg(F.max_by(F.struct("lat", "lon"), largest).alias("at"))
    whole = told.join(cited, "text", "left")
    by_code = F.when(F.col("known").isNull() & F.col("city").isNull(), F.coalesce("state", "short"))
    whole = whole.withColumns({
        "country": F.coalesce("known", "city.country", by_code),
        "precision": F.when(F.col("city").isNotNull(), "city").when(F.col("known").isNull() & F.col("state").isNotNull(), "admin1").when(F.coalesce("known", "short").isNotNull(), "country"),
    })
    whole = whole.join(seats, F.col("country") == F.col("seat"), "left")
    out = whole.select(F.col("text").alias("__text"), "country", F.coalesce("city.lat", "at.lat").alias("lat"), F.coalesce("city.lon", "at.lon").alias("lon"), "precision", "placeless")
    return df.join(out, F.col(location) == F.col("__text"), "left").drop("__text")
