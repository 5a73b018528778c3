"""Similarity of short strings: normalised indel ratio over sorted or shared words, 0 to 100."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of bits at a time."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & at.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 200.0 * common_subsequence(a, b) / total if total else 100.0


def processed(text: str) -> str:
    """Lower case, anything but letters and digits a blank, trimmed."""
    return re.sub(r"[\W_]", " ", text).lower().strip()


def in_order(text: str) -> str:
    """The words of a text, sorted: what token_sort_ratio() compares."""
    return " ".join(sorted(processed(text).split()))


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(in_order(a), in_order(b))


def alike(a: str, b: str, bar: float) -> bool:
    """Whether two texts of in_order() have a ratio of bar or more; lengths that are too far apart settle it."""
    if a == b:
        return True
    return 200.0 * min(len(a), len(b)) >= bar * (len(a) + len(b)) and ratio(a, b) >= bar


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(processed(a).split()), set(processed(b).split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    if both and (x <= y or y <= x):
        return 100.0
    left, right = (" ".join(filter(None, [both, " ".join(sorted(z))])) for z in (x - y, y - x))
    return max(ratio(left, right), ratio(both, left) if both else 0.0, ratio(both, right) if both else 0.0)


def name_score(a: str, b: str) -> float:
    return max(token_sort_ratio(a, b), 0.98 * token_set_ratio(a, b))


@F.pandas_udf(T.DoubleType())
def name_score_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else name_score(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def token_sort_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else token_sort_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")
