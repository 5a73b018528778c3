"""Secret scans: all rules compiled into one automaton, run once over the bytes of every whole text.

The automaton tells where matches of which rules are first complete. There, the rule's reversed automaton walks back to the
leftmost start, and its own forward automaton on to the longest end. Matches of a rule are leftmost, longest and don't
overlap; those whose body is too short are dropped after that, and still use up their text.

A rule is a head and a body that any longer run only makes longer; the body's length in characters is what counts. The base rules are assign, access and hex.
The others are formats that name themselves, so that ordinary text is left alone.

Null texts count as empty and have no spans. Repeated rows are scanned each. Very long texts are scanned whole, a block of
bytes at a time, and the automaton's state goes on from one to the next. Spans that begin together are ordered by kind, as
the rules are listed. Extra columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rolemill.llm.automaton import BLOCK, GAP, Scanner, backwards, combined, compiled, parsed


@dataclass(frozen=True)
class Rule:
    kind: str
    head: str
    body: str
    least: int
    fold: bool = False


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]+", 12, fold=True),
    Rule("access", "", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", "", r"[0-9a-f]{16,}", 16),
)
MORE = (
    Rule("git_token", "gh[pousr]_", r"[A-Za-z0-9]+", 36),
    Rule("chat_token", "xox[abeoprs]-", r"[A-Za-z0-9-]+", 20),
    Rule("maps_key", "AIza", r"[A-Za-z0-9_-]+", 35),
    Rule("jwt", "", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("private_key", "-----BEGIN ", r"([A-Z]+\x20)*PRIVATE KEY-----", 16),
)
RULES = BASE + MORE


class Detector:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        whole = [("cat", [parsed(r.head, r.fold), parsed(r.body, r.fold)]) for r in rules]
        self.scanner = Scanner(combined(whole))
        self.forward = [compiled(x).rows() for x in whole]
        self.reverse = [compiled(backwards(x)).rows() for x in whole]
        self.heads = [compiled(parsed(r.head, r.fold)).rows() for r in rules]
        self.bodies = [compiled(parsed(r.body, r.fold)).rows() for r in rules]

    @staticmethod
    def _longest(rows, data: bytes, at: int) -> int:
        """End of the longest match that starts at at, or -1."""
        classes, table, accepts = rows
        state, end = 0, at if accepts[0] else -1
        for i in range(at, len(data)):
            to = table[state][classes[data[i]]]
            if to == state and not accepts[to] and all(x == to for x in table[to]):
                break
            state = to
            if accepts[state]:
                end = i + 1
        return end

    def _leftmost(self, k: int, data: bytes, end: int, least: int) -> int:
        """The leftmost start, from least on, of a match that ends at end, or -1."""
        classes, table, accepts = self.reverse[k]
        state, start = 0, -1
        for i in range(end - 1, least - 1, -1):
            to = table[state][classes[data[i]]]
            if to == state and not accepts[to] and all(x == to for x in table[to]):
                break
            state = to
            if accepts[state]:
                start = i
        return start

    def _spans(self, data: bytes, ends: np.ndarray, masks: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes of one text, by start and rule; ends: bytes that first complete a match."""
        found = []
        for k, rule in enumerate(self.rules):
            mine = ends[(masks >> k) & 1 == 1]
            at, done = 0, 0
            while at < len(mine):
                start = self._leftmost(k, data, int(mine[at]) + 1, done)
                if start < 0:
                    at += 1
                    continue
                end = self._longest(self.forward[k], data, start)
                if self._body(k, data, start, end) >= rule.least:
                    found.append((start, k, end))
                done = end
                at = int(np.searchsorted(mine, end))
        return sorted(found)

    def _body(self, k: int, data: bytes, start: int, end: int) -> int:
        """Characters of the body; the head takes as much as leaves a body."""
        if not self.rules[k].head:
            return end - start
        split = self._longest(self.heads[k], data[start:end], 0)
        while split >= 0 and self._longest(self.bodies[k], data[start:end], split) < 0:
            split -= 1
        return end - start - split

    def texts(self, texts: list[bytes]) -> Iterator[list[tuple[int, str, int]]]:
        """For each text its spans (start, kind, end) in code points."""
        block: list[bytes] = []
        size = 0
        for t in texts:
            if block and size + len(t) > BLOCK:
                yield from self._block(block)
                block, size = [], 0
            block.append(t)
            size += len(t) + 1
        yield from self._block(block)

    def _block(self, block: list[bytes]) -> Iterator[list[tuple[int, str, int]]]:
        if not block:
            return
        at, masks = self.scanner.accepting(bytes([GAP]).join(block))
        begin = 0
        for t in block:
            low, high = np.searchsorted(at, [begin, begin + len(t)])
            spans = self._spans(t, at[low:high] - begin, masks[low:high]) if high > low else []
            begin += len(t) + 1
            yield [(len(t[:s].decode()), self.rules[k].kind, len(t[:e].decode())) for s, k, e in spans]


@lru_cache(1)
def detector() -> Detector:
    return Detector()


def written(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for s, kind, e in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = [r.kind for r in BASE]
    scan = detector()
    for batch in batches:
        texts = [t.as_py().encode() if t.is_valid else b"" for t in batch.column("text")]
        rows = list(scan.texts(texts))
        kept = [[x for x in spans if x[1] in base] for spans in rows]
        columns = {"doc_id": batch.column("doc_id")}
        columns |= {f"n_{kind}": pa.array([sum(x[1] == kind for x in spans) for spans in kept], pa.int64()) for kind in base}
        columns["base_sha256"] = pa.array([hashlib.sha256(written(spans).encode()).hexdigest() for spans in kept], pa.string())
        columns["spans"] = pa.array([written(spans) for spans in rows], pa.string())
        yield pa.RecordBatch.from_pydict(columns)


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, the number of spans of each base kind, a digest of the base spans, and all spans, of each row of docs."""
    schema = "doc_id long, " + ", ".join(f"n_{r.kind} long" for r in BASE) + ", base_sha256 string, spans string"
    return docs.select("doc_id", "text").mapInArrow(_scan, schema)
