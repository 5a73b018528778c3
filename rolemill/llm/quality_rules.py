"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a rejecting predicate over the text. On a bounded sample the operator measures how long a rule takes and how
many rows it rejects, orders the rules by rejections per second, and chains them so that a row which one rule rejects is
not evaluated by the next. The order changes the work, never the verdict.

What a rule reads of a text is one expression that holds its own intermediate values, so that no plan computes it twice,
wherever the optimiser puts it. judged() returns four counts of every row, whatever its verdict; the rules read those
there. passing() computes nothing before the rule that asks for it.

Nulls, empty texts and texts without a word have no words and fail the length rule. Very long texts are taken whole; a text's
words and windows are arrays in its row. Repeated rows are judged each alike, ties among rules go by name. Extra columns pass
through untouched, but in judged() a column with the name of one that it adds is replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemill.llm.common import SPACE, stored, text_of, word_count

#: Rows that the sample on which cost and selectivity are estimated has on average; it is drawn from the whole table.
SAMPLE_ROWS = 2000
SYMBOLS = "#*$%&|<>"
ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rejected_by", "kept")


def held(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often use reads it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def trimmed_words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, SPACE, "")).cast("long")


def worded_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def symbol_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long")


def duplicate_lines(text: Column) -> Column:
    return held(worded_lines(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def windows3(words: Column) -> Column:
    """One 64-bit hash for each window of three consecutive words."""
    n = F.size(words)
    zipped = F.arrays_zip(words.alias("a"), F.slice(words, 2, F.greatest(n, F.lit(1))).alias("b"), F.slice(words, 3, F.greatest(n, F.lit(1))).alias("c"))
    return F.transform(F.slice(zipped, 1, F.greatest(n - 2, F.lit(0))), lambda x: F.xxhash64(x["a"], x["b"], x["c"]))


def _neighbours(ordered: Column) -> Column:
    """Each (hash, place) of a sorted list with the hashes before and after it."""
    n, nothing = F.size(ordered), F.array(F.lit(None).cast("bigint"))
    return held(
        F.transform(ordered, lambda x: x["h"]),
        lambda hashes: F.arrays_zip(
            ordered.alias("s"),
            F.concat(nothing, F.slice(hashes, 1, F.greatest(n - 1, F.lit(0)))).alias("before"),
            F.concat(F.slice(hashes, 2, F.greatest(n - 1, F.lit(0))), nothing).alias("after"),
        ),
    )


def _covered(places: Column) -> Column:
    """How many words the windows at these places cover."""
    start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(-3).alias("last"))
    return F.aggregate(places, start, lambda acc, p: F.struct((acc["sum"] + F.least(F.lit(3), p - acc["last"])).cast("bigint").alias("sum"), p.alias("last")), lambda acc: acc["sum"])


def _words_in_repeats(windows: Column) -> Column:
    placed = F.arrays_zip(windows.alias("h"), F.sequence(F.lit(0), F.size(windows) - 1).alias("i"))
    again = lambda x: F.coalesce(x["s"]["h"] == x["before"], F.lit(False)) | F.coalesce(x["s"]["h"] == x["after"], F.lit(False))
    twice = held(F.sort_array(placed), lambda ordered: F.transform(F.filter(_neighbours(ordered), again), lambda x: x["s"]["i"]))
    return F.when(F.size(windows) > F.size(F.array_distinct(windows)), _covered(F.sort_array(twice))).otherwise(F.lit(0).cast("bigint"))


def repeat_words(text: Column) -> Column:
    """Number of words inside three-word windows found twice or more in the text.

    Windows are sorted by hash together with their position, so that equal ones are neighbours: n log n in the row, no
    shuffle. Texts in which no window occurs twice, which is most of them, skip the sort. Windows compare by 64-bit hash.
    """
    return held(held(trimmed_words(text), windows3), _words_in_repeats)


@dataclass(frozen=True)
class Rule:
    """rejects: from a text, and a function that gives its counts by name, whether the rule turns it away."""

    name: str
    rejects: Callable[[Column, Callable[[str], Column]], Column]


COUNTS: dict[str, Callable[[Column], Column]] = {"n_words": word_count, "word_chars": word_chars, "n_symbols": symbol_count, "n_dup_lines": duplicate_lines, "n_repeat_words": repeat_words}


def base_rules() -> list[Rule]:
    return [
        Rule("length", lambda text, count: count("n_words") < 50),
        Rule("repeats", lambda text, count: count("n_repeat_words") * 100 > count("n_words") * 50),
    ]


def verdict_rules() -> list[Rule]:
    """What the cascade holds against a text that has passed the base rules; each threshold leaves ordinary prose alone."""
    return [
        Rule("symbols", lambda text, count: count("n_symbols") * 100 > count("word_chars") * 8),
        Rule("repeated_lines", lambda text, count: count("n_dup_lines") * 100 > F.size(worded_lines(text)) * 40),
        Rule("capitals", lambda text, count: F.regexp_count(text, F.lit(r"\p{Lu}")) * 100 > count("word_chars") * 50),
        Rule("digits", lambda text, count: F.regexp_count(text, F.lit("[0-9]")) * 100 > count("word_chars") * 40),
        Rule("word_length", lambda text, count: (count("word_chars") > count("n_words") * 25) | (count("word_chars") * 2 < count("n_words") * 3)),
    ]


def computed(text: Column) -> Callable[[str], Column]:
    """Counts as expressions over the text, for rules that stand by themselves."""
    return lambda name: COUNTS[name](text)


def measured(docs: DataFrame) -> DataFrame:
    """docs with the counts that the rules read; the column text is read."""
    out = docs.withColumns({name: count(text_of()) for name, count in COUNTS.items()})
    failed = [rule.rejects(text_of(), F.col) for rule in base_rules()]
    return out.withColumn("base_failed", failed[0] | failed[1])


def ordered(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS, count: Callable[[str], Column] | None = None) -> list[tuple[Rule, float, float]]:
    """The rules by rejections per second on a sample of about sample_rows rows, with both estimates; ties by name.

    count: where the rules find their counts; without it they compute them, and that is part of what they cost.
    """
    total = docs.count()
    sample = docs.select("text").sample(min(1.0, sample_rows / max(total, 1)), seed=7)
    sample = stored(measured(sample) if count else sample, "rule-sample")

    def seconds(column: Column) -> tuple[float, float]:
        began = time.perf_counter()
        share = sample.agg(F.avg(column.cast("double")).alias("x")).head()["x"] or 0.0
        return time.perf_counter() - began, share

    seconds(F.col("text").isNull())  # compiles and opens the file
    floor = seconds(F.col("text").isNull())[0]
    found = []
    for rule in rules:
        took, share = seconds(rule.rejects(text_of(), count or computed(text_of())))
        found.append((rule, max(took - floor, 1e-4), share))
    return sorted(found, key=lambda x: (-x[2] / x[1], x[0].name))


def cascade(rules: list[Rule], count: Callable[[str], Column]) -> Column:
    """Name of the first rule that rejects the row, else null; later branches of a CASE aren't evaluated."""
    if not rules:
        return F.lit(None).cast("string")
    chain = F.when(rules[0].rejects(text_of(), count), rules[0].name)
    for rule in rules[1:]:
        chain = chain.when(rule.rejects(text_of(), count), rule.name)
    return chain


def judged(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """docs with the base counts, base_failed, rejected_by and kept; the column text is read."""
    order = [r for r, _, _ in ordered(docs, verdict_rules() if rules is None else rules, sample_rows, F.col)]
    out = measured(docs.drop(*ADDED))
    out = out.withColumn("rejected_by", F.when(F.col("base_failed"), "base").otherwise(cascade(order, F.col)))
    return out.withColumn("kept", F.col("rejected_by").isNull())


def passing(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, with their own columns; base rules and others are one cascade."""
    order = [r for r, _, _ in ordered(docs, base_rules() + verdict_rules(), sample_rows)]
    return docs.where(cascade(order, computed(text_of())).isNull())
