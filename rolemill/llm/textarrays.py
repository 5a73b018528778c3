"""Words and n-grams of whole texts as numpy arrays: hashes instead of strings, no loop over characters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [t.encode() if t is not None else b"" for t in column.to_pylist()]


def lowered(data: bytes) -> bytes:
    """A-Z in lower case, other bytes as they are."""
    return _LOWER[np.frombuffer(data, np.uint8)].tobytes()


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word."""
    space = np.ones(len(data) + 2, bool)
    space[1:-1] = _SPACE[np.frombuffer(data, np.uint8)]
    turns = np.flatnonzero(space[1:] != space[:-1])
    return turns[::2], turns[1::2]


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word, in order."""
    begin, end = word_bounds(data)
    if not len(begin):
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(data, np.uint8)
    inside = ~_SPACE[raw]
    kept = raw[inside].astype(np.uint64) + np.uint64(1)
    lengths = end - begin
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(len(kept)) - np.repeat(first, lengths)
    return mixed(np.add.reduceat(kept * powers(int(lengths.max()))[place], first) + lengths.astype(np.uint64))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n consecutive values."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        out = out * _BASE + hashes[k : k + len(out)]
    return mixed(out)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def ngram_buckets(codes: np.ndarray, sizes: tuple[int, ...], bits: int) -> list[np.ndarray]:
    """For each size, the bucket (of 2**bits) of each run of so many codes, such as characters; sizes ascend."""
    raw = codes.astype(np.uint64) + np.uint64(1)
    out, now, length = [], raw, 1
    for n in sizes:
        while length < n:
            now = now[:-1] * _BASE
            now += raw[length:]
            length += 1
        out.append(((now * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)).astype(np.int32))
    return out


def buckets(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int32)
