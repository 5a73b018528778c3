"""Countries from free-form locations."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from rolemill.functions import fixed
from rolemill.functions.text import trimmed

_STATES = [s for s in fixed.STATES if s != "PR"]
_UNAMBIGUOUS = [n for c, n in fixed.STATES.items() if c not in ("GA", "PR")]
_STATE_CODE = rf"(?:^|[,/(\-]\s*)(?:{'|'.join(fixed.STATES)})\b\s*(?:[,()\-]|$)"
#: Code to: what settles it, the country if settled, the country otherwise.
_AMBIGUOUS = {
    "CA": ([p.lower() for p in fixed.PROVINCES], "CA", "US"),
    "DE": (fixed.DELAWARE_TOWNS, "US", "DE"),
    "IN": (fixed.INDIAN_CITIES, "IN", "US"),
    "ID": (fixed.INDONESIAN_CITIES, "ID", "US"),
}


def looks_us(location: Column, country: Column | None = None) -> Column:
    """Whether a posting is plausibly in the United States; a known country decides."""
    text = trimmed(location)
    names = F.lower(F.regexp_extract(text, rf"(?i)\b(?:{'|'.join(fixed.STATES.values())})\b", 0))
    guess = (
        F.when(text == "", False)
        .when(text.rlike(fixed.US_COUNTRY) | text.rlike(fixed.US_REMOTE), True)
        .when(text.rlike(rf"(?i)\b(?:{fixed.OTHER_COUNTRIES})\b"), False)
        .when(text.rlike(_STATE_CODE), True)
        .otherwise((names != "") & ~names.isin(fixed.UNSAFE_STATE_NAMES))
    )
    if country is None:
        return guess
    known = trimmed(country)
    return F.when(known != "", F.upper(known) == "US").otherwise(guess)


def country_of(location: Column) -> Column:
    """Two-letter country of a location, else empty: a name, a region code in parentheses, the last code, a state."""
    text = trimmed(location)
    low = F.lower(text)
    named = [F.when(low.rlike("(?U)" + "|".join(rf"\b{re.escape(n)}\b" for n in names)), code) for code, names in fixed.COUNTRY_NAMES]
    region = F.upper(F.nullif(F.regexp_extract(text, r"^\s*([A-Za-z]{2})\s*\(", 1), F.lit("")))
    parts = F.transform(F.split(low, r"[,;|/]|\s+-\s+"), lambda p: trimmed(p))
    code = F.upper(F.nullif(F.regexp_extract(text, r"(?:^|[,\s(/])([A-Za-z]{2})(?:[\s).]*)$", 1), F.lit("")))
    settled = F.coalesce(*[F.when(code == c, F.when(F.arrays_overlap(parts, F.array(*map(F.lit, places))), yes).otherwise(no)) for c, (places, yes, no) in _AMBIGUOUS.items()])
    last = F.coalesce(
        settled,
        F.when(code.isin([c for c, _ in fixed.COUNTRY_NAMES]), code),
        F.when(code.isin(_STATES), "US"),
        F.when(code.isin(fixed.PROVINCES), "CA"),
    )
    state = F.when(F.arrays_overlap(parts, F.array(*map(F.lit, _UNAMBIGUOUS))) | looks_us(text), "US")
    return F.coalesce(*named, region, last, state, F.lit(""))


def reconciled_country(location: Column, stored: Column) -> Column:
    """The stored code, unless it is blank, or ambiguous and the location says otherwise."""
    have, derived = F.upper(trimmed(stored)), country_of(location)
    return F.when(have == "", derived).when(have.isin(list(_AMBIGUOUS)) & (derived != ""), derived).otherwise(have)


def continent_of(country: Column) -> Column:
    return F.coalesce(*[F.when(country.isin(codes), name) for name, codes in fixed.CONTINENTS.items()])
