"""Cells: how one field of a posting is read from an item of a payload, as a column expression.

An item is a variant (JSON), an HTML card or an XML element (both text). A cell takes an Item and returns a column; cells of
one field are tried in order. All of it runs in built-in functions: a payload is parsed once, and each path is a look-up.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from rolemill.functions.text import held, visible_text


@dataclass(frozen=True)
class Item:
    """An item with the tenant it belongs to and the payload it was taken from."""

    item: Column
    company: Column
    payload: Column


Cell = Callable[[Item], Column]


def _filled(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def _path(path: str) -> str:
    return "$" if path == "$" else f"$.{path}" if path[0] != "[" else f"${path}"


def _get(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, _path(path), kind)


def either(*cells: Cell) -> Cell:
    return lambda x: F.coalesce(*[c(x) for c in cells])


def text(*paths: str) -> Cell:
    """The first path that holds something."""
    return lambda x: F.coalesce(*[_filled(_get(x.item, p)) for p in paths])


def fixed(value: str) -> Cell:
    return lambda x: F.lit(value)


def tenant(x: Item) -> Column:
    return x.company


def number(*paths: str) -> Cell:
    """A number above zero: boards write zero for what isn't set."""

    return lambda x: held(F.coalesce(*[_get(x.item, p).try_cast("double") for p in paths]), lambda v: F.when(v > 0, v))


def when(*paths: str) -> Cell:
    """A date or time as ISO writes them, with or without a zone."""
    return lambda x: F.coalesce(*[_get(x.item, p).try_cast("timestamp") for p in paths])


def epoch(*paths: str, units: int = 1000) -> Cell:
    """A number of seconds since 1970, or of 1/units of them."""
    return lambda x: F.timestamp_seconds(number(*paths)(x) / units)


def us_date(*paths: str) -> Cell:
    return lambda x: slashed(text(*paths)(x))


def slashed(c: Column) -> Column:
    """Month/day/year, as a timestamp."""
    return held(c, _slashed)


def _slashed(c: Column) -> Column:
    part = lambda n: F.regexp_extract(c, r"(\d{1,2})/(\d{1,2})/(\d{4})", n)
    return F.concat_ws("-", part(3), F.lpad(part(1), 2, "0"), F.lpad(part(2), 2, "0")).try_cast("timestamp")


def named_month(c: Column) -> Column:
    """A day, an English name of a month and a year in any order, with a time and zone if there are; as a timestamp."""
    return held(c, _named_month)


def _named_month(c: Column) -> Column:
    name = F.lower(F.regexp_extract(c, r"(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*", 1))
    month = ((F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), name) + 2) / 3).cast("int")
    day, year = F.regexp_extract(c, r"\b(\d{1,2})\b(?!:)", 1), F.regexp_extract(c, r"\b(\d{4})\b", 1)
    date = F.when(name != "", F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0"), F.lpad(day, 2, "0")))
    clock = F.regexp_extract(c, r"\b(\d{2}:\d{2}(?::\d{2})?)", 1)
    zone = F.regexp_replace(F.regexp_extract(c, r"([+-]\d{2}:?\d{2})\s*$", 1), r"^(...):?(..)$", "$1:$2")
    return F.when(clock != "", F.concat(date, F.lit("T"), clock, F.when(zone != "", zone).otherwise("Z"))).otherwise(date).try_cast("timestamp")


def worded_date(*paths: str) -> Cell:
    return lambda x: named_month(text(*paths)(x))


def parts(*paths: str, sep: str = ", ") -> Cell:
    """What the paths hold, each value once, joined."""
    return lambda x: _filled(F.array_join(F.array_distinct(F.array_compact(F.array(*[text(p)(x) for p in paths]))), sep))


def each(path: str, *inner: str, sep: str = ", ", between: str = ", ") -> Cell:
    """For each element of a list what its inner paths hold, joined by between; different ones joined by sep."""

    def label(element: Column) -> Column:
        held = [_filled(_get(element, p)) for p in inner or ("$",)]
        return _filled(F.array_join(F.array_distinct(F.array_compact(F.array(*held))), between))

    def cell(x: Item) -> Column:
        labels = F.array_distinct(F.array_compact(F.transform(_get(x.item, path, "array<variant>"), label)))
        return _filled(F.array_join(labels, sep))

    return cell


def looked_up(table: str, *paths: str) -> Cell:
    """What a map elsewhere in the payload has for the key that the item holds."""
    return lambda x: _filled(F.try_element_at(_get(x.payload, table, "map<string,string>"), text(*paths)(x)))


def flag(path: str, yes: tuple[str, ...] = ("true",), no: tuple[str, ...] = ("false",)) -> Cell:
    """True or false for the values named, in lower case and without blanks and hyphens; else unknown."""

    def cell(x: Item) -> Column:
        told = lambda said: F.when(said.isin(*yes), True).when(said.isin(*no), False)
        return held(F.regexp_replace(F.lower(text(path)(x)), r"[\s_-]+", ""), told)

    return cell


def some(path: str, inner: str) -> Cell:
    """Whether any element of a list holds true; unknown without elements."""

    def cell(x: Item) -> Column:
        held = _get(x.item, path, "array<variant>")
        return F.when(F.size(held) > 0, F.exists(held, lambda e: F.coalesce(_get(e, inner) == "true", F.lit(False))))

    return cell


def link(template: str, **cells: Cell) -> Cell:
    """An address from its parts; {company} is the tenant. Null where a part is."""

    def cell(x: Item) -> Column:
        values = {"company": tenant, **cells}
        pieces = []
        for k, piece in enumerate(template.replace("}", "{").split("{")):
            if piece:
                pieces.append(values[piece](x) if k % 2 else F.lit(piece))
        return F.concat(*pieces)

    return cell


def absolute(base: str, *paths: str) -> Cell:
    """An address as it is, or below base where it is a path."""

    return lambda x: below(link(base)(x), text(*paths)(x))


def below(root: Column, address: Column) -> Column:
    def whole(said: Column) -> Column:
        return F.when(said.startswith("http"), said).when(said.startswith("//"), F.concat(F.lit("https:"), said)).when(said.startswith("/"), F.concat(root, said)).otherwise(F.concat(root, F.lit("/"), said))

    return held(address, whole)


def matched(cell: Cell, pattern: str) -> Cell:
    """The first group of a pattern in what another cell holds."""
    return lambda x: _filled(F.regexp_extract(cell(x), pattern, 1))


def marked(pattern: str) -> Cell:
    """Of an HTML card: the first group of a pattern, as text without tags."""
    return lambda x: _filled(visible_text(F.regexp_extract(x.item, f"(?is){pattern}", 1)))


def dated(cell: Cell) -> Cell:
    """A time from text that another cell holds: ISO, month/day/year, or with the name of a month."""
    return lambda x: held(cell(x), lambda c: F.coalesce(c.try_cast("timestamp"), _slashed(c), _named_month(c)))


def _entities(c: Column) -> Column:
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        c = F.replace(c, F.lit(name), F.lit(char))
    return c


def tagged(*names: str) -> Cell:
    """Of an XML element: the text of its first descendant of a name, with its prefix if it has one. Broken XML is read as far as it goes."""

    def one(x: Item, name: str) -> Column:
        bare = r"(?s)^\s*<!\[CDATA\[(.*?)\]\]>\s*$"
        plain = lambda inner: F.when(inner.rlike(bare), F.regexp_extract(inner, bare, 1)).otherwise(_entities(inner))
        return _filled(held(F.regexp_extract(x.item, rf"(?s)<{name}\b[^>]*>(.*?)</{name}>", 1), plain))

    return lambda x: F.coalesce(*[one(x, n) for n in names])
