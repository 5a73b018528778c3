"""Prose about employers: tidied, cut to whole sentences, and told apart from legal text and from copy about the vacancy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rolemill.functions import fixed
from rolemill.functions.keys import folded
from rolemill.functions.postings import board_of
from rolemill.functions.text import held, present, trimmed, unescaped

_QUOTES = r"\"'“”‘’«»"
#: Where a sentence ends: not behind an initial or a common abbreviation.
_END = r"(?<!\b[A-Z])(?<!\bInc)(?<!\bCorp)(?<!\bLtd)(?<!\bSt)(?<!\bU\.S)(?<!\be\.g)(?<!\bi\.e)(?<!\bvs)(?<!\bNo)[.!?][\"'”’)\]]*(?=\s|$)"


def tidy(c) -> Column:
    """One line without entities, invisible characters, marks of Markdown and quotes around it."""
    text = F.regexp_replace(unescaped(trimmed(c)), "[​-‏  ﻿­]", "")
    text = F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", " ")
    text = F.regexp_replace(text, r"(?m)^\s{0,3}(?:[-*+>]\s+|#{1,6}\s+)|\*{1,3}|_{2,}|`", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"\s+", " "), rf"^[{_QUOTES} ]+|[{_QUOTES} ]+$", ""))


def sentences(c: Column) -> Column:
    """Sentences with their ends, as an array."""
    return F.filter(F.transform(F.split(F.regexp_replace(c, rf"({_END})", "$1\u0001"), "\u0001"), lambda s: F.trim(s)), lambda s: s != "")


def trim(c: Column, most: int = 3, chars: int = 600) -> Column:
    """The first sentences that fit; a first one that does not is cut at a word, with an ellipsis."""

    def cut(whole: Column) -> Column:
        step = lambda kept, s: F.when((kept["n"] < most) & ~kept["over"] & (F.length(kept["t"]) + F.length(s) + F.when(kept["t"] == "", 0).otherwise(1) <= chars), F.struct((kept["n"] + 1).alias("n"), F.lit(False).alias("over"), F.concat_ws(" ", F.nullif(kept["t"], F.lit("")), s).alias("t"))).otherwise(F.struct(kept["n"].alias("n"), F.lit(True).alias("over"), kept["t"].alias("t")))
        fits = F.aggregate(sentences(whole), F.struct(F.lit(0).alias("n"), F.lit(False).alias("over"), F.lit("").alias("t")), step, lambda kept: kept["t"])
        short = F.concat(F.regexp_replace(F.regexp_replace(F.substring(whole, 1, chars), r"\s+\S*$", ""), r"[,;:\-–— ]+$", ""), F.lit("…"))
        return held(fits, lambda f: F.when(f != "", f).when(F.length(whole) <= chars, whole).otherwise(short))

    return held(F.trim(c), cut)


def is_legalese(c: Column) -> Column:
    """Employment law: one mark of it near the beginning, or two anywhere."""
    return F.coalesce((F.regexp_instr(c, F.lit(fixed.LEGALESE)).between(1, 200)) | (F.regexp_count(c, F.lit(fixed.LEGALESE)) >= 2), F.lit(False))


def is_role_copy(c: Column) -> Column:
    """Whether a text opens with the vacancy instead of the employer."""
    return F.coalesce(c.rlike(fixed.ROLE_OPENER), F.lit(False))


def mentions_name(c, name) -> Column:
    """Whether a text has a name as a whole, or its first word if that has four letters or more."""
    words = lambda x: F.concat(F.lit(" "), F.trim(F.regexp_replace(folded(x), "[^a-z0-9]+", " ")), F.lit(" "))
    whole = words(name)
    first = F.concat(F.lit(" "), F.substring_index(F.trim(whole), " ", 1), F.lit(" "))
    text = words(c)
    return (F.trim(whole) != "") & (text.contains(whole) | ((F.length(first) >= 6) & text.contains(first)))


def acceptable(c: Column, name, least: int = 40) -> Column:
    """A description that says something about the employer itself."""
    return (F.length(c) >= least) & ~is_legalese(c) & ~is_role_copy(c) & mentions_name(c, name)


def _meta(html: Column, key: str) -> Column:
    """The content of a page's meta element of that name, however its attributes are ordered and quoted."""
    tag = F.regexp_extract(html, rf"(?is)(<meta\b(?=[^>]*\b(?:name|property)\s*=\s*[\"']?{key}[\"'\s/>])[^>]*>)", 1)
    return F.coalesce(*[F.nullif(F.regexp_extract(tag, rf"(?is)\bcontent\s*=\s*{q}([^{q}]*){q}", 1), F.lit("")) for q in ("\"", "'")])


def page_description(html: Column, least: int = 40) -> Column:
    """What a page says of itself: its meta elements in order of trust, then an organisation in its linked data."""
    said = [tidy(_meta(html, key)) for key in ("og:description", "description", "twitter:description")]
    scripts = F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), 1), F.try_parse_json)
    nodes = F.flatten(F.transform(scripts, lambda v: F.coalesce(F.try_variant_get(v, "$['@graph']", "array<variant>"), F.array(v))))
    kinds = F.array(*[F.lit(k) for k in fixed.ORGANISATION_KINDS])
    of_one = F.filter(nodes, lambda n: F.array_contains(kinds, F.lower(F.coalesce(F.try_variant_get(n, "$['@type'][0]", "string"), F.try_variant_get(n, "$['@type']", "string")))))
    linked = tidy(F.get(F.filter(F.transform(of_one, lambda n: F.try_variant_get(n, "$.description", "string")), lambda d: F.length(d) >= least), F.lit(0)))
    return F.coalesce(*[F.when(F.length(s) >= least, s) for s in [*said, linked]])


def autolinked(c: Column) -> Column:
    """Bare addresses and mail addresses in angle brackets, as Markdown wants them; those that are links already stay."""
    return F.regexp_replace(F.regexp_replace(c, r"(?<![<(\"'\]!])\b(https?://[^\s<>()\"']+[^\s<>()\"'.,;:!?])(?!>)", "<$1>"), r"(?<![<\w.+:/-])([\w.+-]+@[\w-]+(?:\.[\w-]+)+)(?![>\w])", "<$1>")


def plain(c) -> Column:
    """A description as Markdown: headings, items, emphasis, links and breaks of HTML, other tags gone, entities resolved."""
    steps = [
        (r"(?is)<(script|style)\b.*?</\1\s*>", ""), (r"(?is)<h([1-6])\b[^>]*>\s*(.*?)\s*</h\1>", "\n\n### $2\n\n"), (r"(?is)<li\b[^>]*>\s*", "\n- "),
        (r"(?is)<(?:strong|b)\b[^>]*>(.*?)</(?:strong|b)>", "**$1**"), (r"(?is)<(?:em|i)\b[^>]*>(.*?)</(?:em|i)>", "*$1*"),
        (r"(?is)<a\b[^>]*href\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a>", "[$2]($1)"), (r"(?i)<br\s*/?>", "\n"), (r"(?i)</?(?:p|div|ul|ol|table|tr|section|article|blockquote)\b[^>]*>", "\n\n"),
        (r"(?s)<[^>]+>", ""), (r"[ \t]+\n", "\n"), (r"\n{3,}", "\n\n"),
    ]
    text = present(c)
    for pattern, by in steps:
        text = F.regexp_replace(text, pattern, by)
    return F.nullif(autolinked(trimmed(unescaped(text))), F.lit(""))


def belongs_to(url: Column, ats, slug) -> Column:
    """Whether an address is on the board of that kind and names that tenant."""
    words = F.filter(F.split(F.lower(F.regexp_replace(trimmed(slug), "^https?://", "")), "[^a-z0-9]+"), lambda w: (w != "") & ~w.isin("com", "www", "http", "https", "net", "org", "io", "co"))
    return F.coalesce((board_of(url)["ats"] == (F.col(ats) if isinstance(ats, str) else ats)) & (F.size(words) > 0) & F.forall(words, lambda w: F.contains(F.lower(url), w)), F.lit(False))


def board_root(url: Column, ats, slug) -> Column:
    """The board that an address of a posting is under: its host, or its host and first segment; null where neither is the tenant's."""
    host = F.regexp_extract(url, r"(?i)^((?:https?://)?[^/?#]+)", 1)
    path = F.regexp_extract(url, r"(?i)^((?:https?://)?[^/?#]+/[^/?#]+)", 1)
    return F.coalesce(*[F.when(belongs_to(c, ats, slug), c) for c in (host, path)])


def about_section(c: Column, least: int = 40) -> Column:
    """Of an annual report: the first sentence behind the heading of item 1 that says what the company is or does."""
    item = F.regexp_extract(c, r"(?is)\bitem\s+1\.?\s*(?:business)?\b(.{0,20000})", 1)
    told = F.filter(sentences(F.regexp_replace(item, r"\s+", " ")), lambda s: (F.length(s) >= least) & s.rlike(r"(?i)\b(?:we|the company|our company|[A-Z][\w.,& ]{1,60}?)\s+(?:is|are|provides?|develops?|designs?|operates?|offers?|manufactures?)\b"))
    return F.get(told, F.lit(0))
