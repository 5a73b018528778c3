"""Connected components of a table of links, in rounds of pointer jumps over DataFrames.

Links point from the larger node to the smaller one. A round sends each link on to the smallest node that its end points at,
and deals links by their larger node. Before and after that, every task replaces the links that it meets by a forest in which
each node points at the smallest one of its tree; so a node has a row a task at most, however many links it has. A round's
links are written to the shared folder, so that neither lineage nor any one task grows. Nothing is gathered on the driver
but whether a round still found something to do: rows that moved, or nodes that pointed at several others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolemill.llm.common import release, stored

SCHEMA = "a long, b long, moved boolean"
#: Links that a task holds before it makes a forest of them, and nodes of a forest before it is sent on.
HELD, FOREST = 1 << 19, 1 << 22


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of these links but the smallest of its tree, and that smallest node; hooks and jumps until nothing moves."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    up = np.arange(len(nodes))
    while True:
        before, above = up.copy(), up[up]
        for x, y in ((u, v), (v, u)):
            np.minimum.at(up, before[x], above[y])
            np.minimum.at(up, x, above[y])
        up = np.minimum(up, up[up])
        if (up == before).all():
            break
    below = np.flatnonzero(up != np.arange(len(nodes)))
    return nodes[below], nodes[up[below]]


def _rows(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(np.zeros(len(a), bool))], ["a", "b", "moved"])


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task as forests. Where rows are sorted by a and b, a node that points at several others is noticed.

    A row without nodes says that there is more to do.
    """
    tree, held, size, moved, last = (np.zeros(0, np.int64),) * 2, [], 0, False, None
    for batch in batches:
        moved = moved or bool(batch.column("moved").to_numpy(zero_copy_only=False).any())
        rows = batch.filter(batch.column("a").is_valid())
        a, b = rows.column("a").to_numpy(), rows.column("b").to_numpy()
        if not len(a):
            continue
        moved = moved or bool(((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any()) or (last is not None and last[0] == a[0] and last[1] != b[0])
        last = a[-1], b[-1]
        held.append((a, b))
        size += len(a)
        if size >= HELD:
            tree, held, size = forest(*(np.concatenate(x) for x in zip(tree, *held, strict=True))), [], 0
            if len(tree[0]) >= FOREST:
                yield _rows(*tree)
                tree = (np.zeros(0, np.int64),) * 2
    if held:
        tree = forest(*(np.concatenate(x) for x in zip(tree, *held, strict=True)))
    if len(tree[0]):
        yield _rows(*tree)
    if moved:
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([True])], ["a", "b", "moved"])


def components(links: DataFrame) -> DataFrame:
    """links: a, b, numbers of nodes. Each node that has a link to another, with the smallest node of its component."""
    turned = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), F.lit(False).alias("moved"))
    now = stored(turned.mapInArrow(_contracted, SCHEMA), "links").where("a IS NOT NULL")
    while True:
        # The keys are turned over so that both sides are dealt anew for the join: only then can Spark split a node of many links.
        least = now.groupBy("a").agg(F.min("b").alias("m")).select(F.bitwise_not("a").alias("c"), "m")
        jumped = now.join(least.hint("merge"), F.bitwise_not("b") == F.col("c"), "left").select("a", F.coalesce("m", "b").alias("b"), F.col("m").isNotNull().alias("moved"))
        # Without a number, so that few links make few tasks and files: for each file executors start processes that set modes.
        dealt = jumped.mapInArrow(_contracted, SCHEMA).repartition("a").sortWithinPartitions("a", "b")
        after = stored(dealt.mapInArrow(_contracted, SCHEMA), "links")
        now = after.where("a IS NOT NULL")
        release(links.sparkSession)
        if after.where("moved").isEmpty():
            break
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
