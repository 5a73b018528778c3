"""Best-fit packing into sequences of several permitted lengths.

Documents are cut into pieces of at most the largest permitted length, nothing is lost. Pieces are dealt to shards of a
bounded number of tokens by a hash of document, place of reading and piece, so that rows with one doc_id spread as others
do, and each shard is packed by itself, longest piece first. A
piece goes to the open bin that it fills best. If none has room, a new bin opens, of the permitted length with the least
expected cost for a token: its cost over what it will hold, given the piece and the tokens still to come. That is done once
for each set of lengths that may be opened, and the plan with the least total cost stays, after every bin has been cut down to
the smallest permitted length that holds its contents.

Texts without words and null texts have no pieces and appear in no bin. Repeated rows are packed each. Ties go by doc_id,
piece and place of reading; reruns over the same files agree. Very long texts become many pieces of the largest length. Null doc_ids are packed as any other. Extra columns of
the input are not read; an empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolemill.llm.common import stored, text_of, word_count

LENGTHS = (512, 1024, 2048, 4096)
#: Tokens that a bin costs beyond its length: its share of a step's fixed work.
OPENING = 32
#: Tokens of a shard, on average; one task holds the lengths of a shard's pieces, not their texts.
SHARD_TOKENS = 4_000_000
SCHEMA = "doc_id long, piece int, n_tokens int, shard int, bin int, offset int, capacity int, bin_tokens int"


@dataclass
class Plan:
    """bins: of each piece its bin; offsets: where it begins there; held: tokens of each bin; capacities: of each bin."""

    bins: np.ndarray
    offsets: np.ndarray
    held: np.ndarray
    capacities: np.ndarray

    def cost(self) -> int:
        return int(self.capacities.sum()) + OPENING * len(self.capacities)


def best_fit(sizes: np.ndarray, lengths: tuple[int, ...]) -> Plan:
    """sizes: descending, none above the largest of lengths, which ascend. Every bin opens with one of lengths."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    held: list[int] = []
    opened: list[int] = []
    room: list[int] = []  # distinct amounts of room, ascending
    with_room: dict[int, list[int]] = {}
    left = int(sizes.sum())
    for i, size in enumerate(sizes.tolist()):
        at = bisect_left(room, size)
        if at < len(room):
            space = room[at]
            waiting = with_room[space]
            b = waiting.pop()
            if not waiting:
                del with_room[space]
                room.pop(at)
        else:
            fits = [c for c in lengths if c >= size]
            space = min(fits, key=lambda c: ((c + OPENING) / min(c, left), c))
            b = len(held)
            held.append(0)
            opened.append(space)
        bins[i], offsets[i] = b, held[b]
        held[b] += size
        left -= size
        if space > size:
            rest = space - size
            if rest not in with_room:
                with_room[rest] = []
                room.insert(bisect_left(room, rest), rest)
            with_room[rest].append(b)
    return Plan(bins, offsets, np.array(held, np.int64), np.array(opened, np.int64))


def downsized(plan: Plan, lengths: tuple[int, ...]) -> Plan:
    ladder = np.array(lengths)
    return Plan(plan.bins, plan.offsets, plan.held, ladder[np.searchsorted(ladder, plan.held)])


def packed(sizes: np.ndarray, lengths: tuple[int, ...] = LENGTHS) -> Plan:
    """The cheapest of the plans that open bins of the k largest lengths only, or one length beside the largest."""
    menus = dict.fromkeys([lengths[k:] for k in range(len(lengths))] + [(c, lengths[-1]) if c != lengths[-1] else (c,) for c in lengths])
    return min((downsized(best_fit(sizes, menu), lengths) for menu in menus), key=Plan.cost)


def pieces(docs: DataFrame, largest: int, size=None) -> DataFrame:
    """doc_id, at, piece and n_tokens: each document cut into pieces of at most the largest length; at: its place of reading."""
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("at"), (word_count(text_of()) if size is None else size).alias("size")).where("size > 0")
    cut = F.explode(F.sequence(F.lit(0), F.ceil(F.col("size") / largest).cast("int") - 1)).alias("piece")
    return rows.select("doc_id", "at", "size", cut).select("doc_id", "at", "piece", F.least(F.lit(largest), F.col("size") - F.col("piece") * largest).cast("int").alias("n_tokens"))


def _shard(lengths: tuple[int, ...]):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("at", "ascending")])
        plan = packed(rows.column("n_tokens").to_numpy().astype(np.int64), lengths)
        columns = {"bin": plan.bins, "offset": plan.offsets, "capacity": plan.capacities[plan.bins], "bin_tokens": plan.held[plan.bins]}
        for name, values in columns.items():
            rows = rows.append_column(name, pa.array(values, pa.int32()))
        return rows.select([c.split()[0] for c in SCHEMA.split(", ")])

    return run


def packed_documents(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row a piece: its document, tokens, bin (by shard and number), offset there, the bin's length and contents."""
    lengths = tuple(sorted(set(lengths)))
    rows = stored(pieces(docs, lengths[-1]), "pack-pieces")
    total = rows.agg(F.sum("n_tokens").alias("n")).head()["n"] or 0
    shards = max(1, -(-total // shard_tokens))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "at", "piece"), F.lit(shards)).cast("int"))
    return rows.groupBy("shard").applyInArrow(_shard(lengths), SCHEMA)

