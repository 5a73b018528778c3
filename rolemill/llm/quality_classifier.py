"""Quality classifier: supervised subword embeddings.

Word and character n-grams of a text are hashed into buckets. Each bucket has a learned vector; a document is the sum of
the averages of its word vectors and of its character vectors, and a softmax over the labels stands on that. Vectors and
softmax are trained by stochastic gradient descent in numpy, on a bounded sample of labelled rows. Words that repeat the
word before, and three-word windows that the text has had already, count as n-grams of their own kind.

With two labels, the softmax of averages depends on each bucket through one number, so that scoring adds those up.

Nulls count as empty; empty texts score by the bias alone. Repeated rows get equal scores, very long texts are scored whole.
Rows of labels without a document, null labels and labels other than 0 and 1 are left out; of several labels for a document
the largest counts, and rows that tie in doc_id are learned from in the order of their texts. Extra columns are not read. An
empty table of documents gives an empty table; without any labelled row every text scores 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolemill.llm.textarrays import as_bytes, buckets, code_points, ngram_buckets, windows, word_hashes

#: Labelled rows that training takes at most, chosen by a hash of doc_id, and bytes of their texts.
SAMPLE_ROWS = 2500
SAMPLE_BYTES = 1 << 26
BITS = 16
BUCKETS = 1 << BITS
#: Buckets of words, buckets of characters, and one for each kind of repetition.
SAME, SEEN, SIZE = 2 * BUCKETS, 2 * BUCKETS + 1, 2 * BUCKETS + 2
WIDTH = 8
EPOCHS = 6
RATE = 4.0
BATCH = 32
FOLDS = 5
THRESHOLD = 0.3


def ngrams(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the word n-grams and of the character n-grams of a whole text."""
    words = word_hashes(data)
    pairs, triples = windows(words, 2), windows(words, 3)
    same = np.count_nonzero(words[1:] == words[:-1])
    seen = len(triples) - len(np.unique(triples))
    word = np.concatenate([buckets(words, BITS), buckets(pairs, BITS), np.full(same, SAME, np.int32), np.full(seen, SEEN, np.int32)])
    return word, np.concatenate(ngram_buckets(code_points(data.decode()), (3, 4, 5), BITS)) + BUCKETS


@dataclass(frozen=True)
class Model:
    """weight: by bucket, what it adds to the log odds of label 1; bias: the log odds of nothing."""

    weight: np.ndarray
    bias: float

    def score(self, data: bytes) -> float:
        odds = self.bias
        for part in ngrams(data):
            if len(part):
                odds += float(self.weight[part].mean(dtype=np.float64))
        return 1 / (1 + float(np.exp(-np.clip(odds, -60, 60))))


def trained(texts: list[bytes], labels: list[int], seed: int = 7) -> Model:
    if not texts:
        return Model(np.zeros(SIZE, np.float32), 0.0)
    columns, shares, starts = [], [], [0]
    for t in texts:  # a sparse row a document: its buckets and their shares
        n = 0
        for part in ngrams(t):
            bucket, count = np.unique(part, return_counts=True)
            columns.append(bucket)
            shares.append((count / max(len(part), 1)).astype(np.float32))
            n += len(bucket)
        starts.append(starts[-1] + n)
    column, share, start, goal = np.concatenate(columns), np.concatenate(shares), np.array(starts), np.array(labels)
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((SIZE, WIDTH), np.float32) - 0.5) / WIDTH).astype(np.float32)
    out, bias = np.zeros((WIDTH, 2), np.float32), np.zeros(2, np.float32)
    steps, done = EPOCHS * -(-len(texts) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for low in range(0, len(order), BATCH):
            docs = order[low : low + BATCH]
            rate = RATE * (1 - done / steps)
            done += 1
            at = np.concatenate([np.arange(start[d], start[d + 1]) for d in docs])
            sizes = start[docs + 1] - start[docs]
            row, first = np.repeat(np.arange(len(docs)), sizes), np.cumsum(sizes) - sizes
            weighted = np.append(vectors[column[at]] * share[at, None], np.zeros((1, WIDTH), np.float32), axis=0)
            mean = np.add.reduceat(weighted, first)
            mean[sizes == 0] = 0
            logits = mean @ out + bias
            chance = np.exp(logits - logits.max(1, keepdims=True))
            chance /= chance.sum(1, keepdims=True)
            chance[np.arange(len(docs)), goal[docs]] -= 1  # the gradient of the softmax
            back = chance @ out.T
            out -= rate / len(docs) * (mean.T @ chance)
            bias -= rate / len(docs) * chance.sum(0)
            for k in range(WIDTH):
                vectors[:, k] += np.bincount(column[at], (-rate * back[:, k])[row] * share[at], SIZE)
    return Model((vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def held_out(folds: int, fold: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)).eqNullSafe(F.lit(fold))


def within(rows: list, most: int) -> list:
    """Those of the rows, which have bytes, that fit into so many bytes when taken in order; what doesn't fit is passed over."""
    kept, left = [], most
    for r in rows:
        if r["bytes"] <= left:
            kept.append(r)
            left -= r["bytes"]
    return kept


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, most: int = SAMPLE_BYTES) -> tuple[list[bytes], list[int]]:
    """Whole texts and labels of at most so many labelled rows and bytes outside the held-out fold.

    Ids and lengths are looked at first, so that no task and not the driver holds more texts than that.
    """
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out(FOLDS, 0)).groupBy("doc_id").agg(F.max("quality").alias("label"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sizes = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes")).join(F.broadcast(picked), "doc_id")
    sizes = sizes.groupBy("doc_id", "label").agg(F.sum("bytes").alias("bytes"))  # rows with one doc_id come together
    chosen = within(sizes.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect(), most)
    if not chosen:
        return [], []
    wanted = docs.sparkSession.createDataFrame([(r["doc_id"], r["label"]) for r in chosen], "doc_id long, label int")
    found = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(rows)
    got = found.select("text", "label").toArrow()
    return as_bytes(got.column("text").combine_chunks()), got.column("label").to_pylist()


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.array([model.score(t) for t in as_bytes(batch.column("text"))], np.float64)
            predicted = pa.array((score >= THRESHOLD).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), predicted], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", held_out(FOLDS, 0).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
