"""Prefix-free parsing: corpus order of chosen suffixes from the suffix order of a dictionary and of a parse.

A rolling hash over a few bytes triggers where it is zero modulo a small number. Texts are cut there into phrases, each
reaching to the end of the next trigger, so that no phrase suffix longer than a trigger is a prefix of another. Two
suffixes of the corpus thus compare by the phrase suffixes they begin with and, where those agree, by the phrases that
follow: by their ranks in the sorted dictionary of phrase suffixes and in the suffix array of the parse. Repetitive text has
few distinct phrases, and only those are sorted by their bytes.
"""

from __future__ import annotations

import numpy as np

TRIGGER = 8
ONE_IN = 24
_BASE = 0x100000001B3


def rolling(raw: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of width bytes."""
    now, length = raw.astype(np.uint64) + np.uint64(1), 1
    scale = _BASE
    out, done = None, 0
    bits = width
    while bits:  # runs of 1, 2, 4, ... bytes, joined as the bits of width ask for
        if bits & 1:
            if out is None:
                out, done = now, length
            else:
                n = len(raw) - done - length + 1
                out, done = out[:n] * np.uint64(scale) + now[done : done + n], done + length
        bits >>= 1
        if bits:
            n = len(raw) - 2 * length + 1
            if n <= 0:
                return np.zeros(0, np.uint64)
            now = now[:n] * np.uint64(scale) + now[length : length + n]
            scale, length = scale * scale % (1 << 64), 2 * length
    return out


def spread(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def triggers(text: bytes) -> list[int]:
    """First bytes of the triggers inside a text; its first byte always begins a phrase."""
    if len(text) < TRIGGER:
        return [0]
    at = np.flatnonzero((spread(rolling(np.frombuffer(text, np.uint8), TRIGGER)) >> np.uint64(40)) % np.uint64(ONE_IN) == 0)
    return [0, *at[at > 0].tolist()]


def parse_order(parse: np.ndarray, longest: int) -> np.ndarray:
    """Rank of each suffix of the parse, by prefix doubling; zeros end the texts. longest: phrases of the longest text."""
    rank, step = np.unique(parse, return_inverse=True)[1].reshape(-1).astype(np.int64), 1
    ends = parse == 0
    while step <= longest:
        after = np.zeros(len(rank), np.int64)
        after[: max(0, len(rank) - step)] = rank[step:]
        after[ends] = 0  # nothing after the end of a text counts
        renewed = np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)[1].reshape(-1)
        if renewed.max() == rank.max():
            break
        rank, step = renewed, 2 * step
    return rank


def repeated(texts: list[bytes], live: list[int], lengths: tuple[int, ...]) -> list[list[np.ndarray]]:
    """For each text and each length, which of its first live starts begin a string of this length that another live start begins too.

    lengths ascend. One order serves all of them: strings that agree in their first bytes are neighbours in it.
    """
    phrases: dict[bytes, int] = {}
    parse: list[int] = []
    where: list[tuple[int, list[int]]] = []
    for t in texts:
        cuts = triggers(t)
        where.append((len(parse), cuts))
        for k, begin in enumerate(cuts):
            end = cuts[k + 1] + TRIGGER if k + 1 < len(cuts) else len(t)
            parse.append(phrases.setdefault(t[begin:end], len(phrases)))
        parse.append(-1)
    order = sorted(phrases)  # the dictionary
    place = np.empty(len(phrases) + 1, np.int64)
    for rank, phrase in enumerate(order):
        place[phrases[phrase]] = rank + 1
    place[-1] = 0
    ranks = parse_order(place[np.array(parse)], max((len(c) for _, c in where), default=1))
    tails: dict[bytes, int] = {}
    first, second, text_of, start_of = [], [], [], []
    for n, (t, count) in enumerate(zip(texts, live, strict=True)):
        at, cuts = where[n]
        k = 0
        for i in range(min(count, len(t) - lengths[0] + 1)):
            while k + 1 < len(cuts) and cuts[k + 1] <= i:
                k += 1
            end = cuts[k + 1] + TRIGGER if k + 1 < len(cuts) else len(t)
            first.append(tails.setdefault(t[i:end], len(tails)))
            second.append(at + k + 1)
            text_of.append(n)
            start_of.append(i)
    found = [[np.zeros(max(0, c), bool) for _ in lengths] for c in live]
    if len(first) < 2:
        return found
    tail_rank = np.empty(len(tails), np.int64)
    for rank, tail in enumerate(sorted(tails)):
        tail_rank[tails[tail]] = rank
    corpus = np.lexsort((ranks[np.array(second)], tail_rank[np.array(first)])).tolist()
    before: bytes | None = None
    for m, j in enumerate(corpus):
        t, i = text_of[j], start_of[j]
        now = texts[t][i : i + lengths[-1]]
        if before is not None:
            u, h = text_of[corpus[m - 1]], start_of[corpus[m - 1]]
            for k, n in enumerate(lengths):
                if len(now) < n or now[:n] != before[:n]:
                    break
                found[t][k][i] = found[u][k][h] = True
        before = now
    return found
