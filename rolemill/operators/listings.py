"""The posting record: its columns and types, and reading it from slices whose columns drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rolemill.functions import fixed
from rolemill.functions.text import present

STRINGS = "url title company ats_type ats_id location country_iso region salary_currency salary_period salary_summary seniority employment_type department team requisition_id apply_url commitment description language raw".split()
DOUBLES = "lat lon salary_min salary_max".split()
BOOLEANS = "is_remote offers_equity offers_bonus offers_commission".split()
SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in STRINGS]
    + [T.StructField(c, T.DoubleType()) for c in DOUBLES]
    + [T.StructField(c, T.BooleanType()) for c in BOOLEANS]
    + [T.StructField("experience", T.IntegerType()), T.StructField("posted_at", T.TimestampType())]
)


def col_or(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column, or nulls of that type where a slice lacks it."""
    return F.col(name).try_cast(kind) if name in df.columns else F.lit(None).cast(kind)


def typed(df: DataFrame) -> DataFrame:
    """All-text rows to the record's types: blanks are null, what can't be read is null, naive times are UTC."""
    def one(field: T.StructField) -> Column:
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        text = present(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.try_to_timestamp(text).alias(field.name)
        return text.try_cast(field.dataType).alias(field.name)

    extra = [F.col(c) for c in df.columns if c not in SCHEMA.names]
    return df.select(*[one(f) for f in SCHEMA.fields], *extra)


def lookup(c: Column, table: dict[str, float | int | str], default=None) -> Column:
    """A small fixed table as an expression."""
    known = F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), c)
    return F.coalesce(known, F.lit(default)) if default is not None else known


def source_rank(ats_type="ats_type") -> Column:
    return lookup(F.col(ats_type), fixed.SOURCE_RANK, fixed.UNLISTED_RANK)


def union_relaxed(parts: list[DataFrame]) -> DataFrame:
    """Rows of all parts; columns that a part lacks are null, and columns of differing types become text."""
    kinds: dict[str, set[str]] = {}
    for p in parts:
        for name, kind in p.dtypes:
            kinds.setdefault(name, set()).add(kind)
    mixed = [c for c, found in kinds.items() if len(found) > 1]
    out = None
    for p in parts:
        p = p.withColumns({c: F.col(c).cast("string") for c in mixed if c in p.columns})
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out
