"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Weights are trained with follow-the-regularised-leader steps under an elastic-net penalty, which leaves most weights at
exactly zero; a temperature fitted on rows that training left aside then calibrates the probabilities. Training takes a
bounded sample of labelled rows, spread evenly over the languages; document frequencies are part of that fit.

Null texts and texts without a letter are und with score 0. Rows with a null language are not learned from. Repeated rows
get equal predictions, very long texts are read whole; rows that tie in doc_id are learned from in the order of their texts.
Extra columns are not read. An empty table gives an empty table; without any labelled row every text is und.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolemill.llm.quality_classifier import held_out, within
from rolemill.llm.textarrays import code_points, ngram_buckets

#: Labelled rows that training takes on average, chosen by a hash of doc_id; twice as many and so many bytes at most.
SAMPLE_ROWS = 3000
SAMPLE_BYTES = 1 << 26
BITS = 15
BUCKETS = 1 << BITS
LETTER = re.compile(r"[^\W\d_]")
FOLDS, FOLD = 3, 1


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of one to four characters of the whole text in lower case, and how often each occurs."""
    codes = code_points(f" {text.lower()} ")
    found = np.bincount(np.concatenate(ngram_buckets(codes, (1, 2, 3, 4), BITS)), minlength=BUCKETS)
    bucket = np.flatnonzero(found)
    return bucket, found[bucket]


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    weight: np.ndarray
    bias: np.ndarray
    temperature: float

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        bucket, count = counts(text)
        value = (1 + np.log(count)) * self.idf[bucket]
        return bucket, value / max(float(np.sqrt((value * value).sum())), 1e-12)

    def logits(self, text: str) -> np.ndarray:
        bucket, value = self.features(text)
        return value @ self.weight[bucket] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or text is None or not LETTER.search(text):
            return "und", 0.0
        logits = self.logits(text) / self.temperature
        chance = np.exp(logits - logits.max())
        best = int(chance.argmax())
        return self.languages[best], float(chance[best] / chance.sum())


def trained(texts: list[str], labels: list[str], alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02, epochs: int = 2, seed: int = 7) -> Model:
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros(BUCKETS), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    seen = np.zeros(BUCKETS)
    for t in texts:
        seen[counts(t)[0]] += 1
    idf = np.log((1 + len(texts)) / (1 + seen)) + 1
    shape = (BUCKETS, len(languages))
    blank = Model(languages, idf, np.zeros(shape), np.zeros(len(languages)), 1.0)
    rows = [blank.features(t) for t in texts]
    goal = np.array([languages.index(x) for x in labels])
    order = np.random.default_rng(seed).permutation(len(texts))
    aside, learn = order[: len(order) // 5], order[len(order) // 5 :]
    z, n = np.zeros(shape), np.zeros(shape)
    bias = np.zeros(len(languages))

    def weight(at):
        rate = (beta + np.sqrt(n[at])) / alpha + l2
        return np.where(np.abs(z[at]) <= l1, 0.0, (np.sign(z[at]) * l1 - z[at]) / rate)

    for _ in range(epochs):
        for i in learn:
            bucket, value = rows[i]
            now = weight(bucket)
            logits = value @ now + bias
            chance = np.exp(logits - logits.max())
            chance /= chance.sum()
            chance[goal[i]] -= 1
            gradient = value[:, None] * chance
            step = (np.sqrt(n[bucket] + gradient**2) - np.sqrt(n[bucket])) / alpha
            z[bucket] += gradient - step * now
            n[bucket] += gradient**2
            bias -= 0.05 * chance
    model = Model(languages, idf, weight(slice(None)), bias, 1.0)
    return Model(languages, idf, model.weight, bias, calibrated(model, [rows[i] for i in aside], goal[aside]))


def calibrated(model: Model, rows: list, goal: np.ndarray) -> float:
    """The temperature with the least mean log loss on rows that weren't learned from."""
    if not rows:
        return 1.0
    logits = np.array([value @ model.weight[bucket] + model.bias for bucket, value in rows])

    def loss(temperature: float) -> float:
        x = logits / temperature
        x = x - x.max(1, keepdims=True)
        return float((np.log(np.exp(x).sum(1)) - x[np.arange(len(goal)), goal]).mean())

    return min((float(t) for t in np.geomspace(0.05, 20, 120)), key=loss)


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS, most: int = SAMPLE_BYTES) -> tuple[list[str], list[str]]:
    """Whole texts and languages of rows outside the held-out fold, about as many for each language.

    Of more languages than rows the commonest are learned. Ids and lengths are looked at first, so that no task and not the
    driver holds more texts than the bound says.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(FOLDS, FOLD))
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(rows).collect()
    if not sizes:
        return [], []
    each, spark = max(1, rows // len(sizes)), docs.sparkSession
    share = spark.createDataFrame([(r["lang"], min(1.0, each / r["n"])) for r in sizes], "lang string, share double")
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000.0
    drawn = known.select("doc_id", "lang", F.octet_length("text").alias("bytes")).join(F.broadcast(share), "lang").where(draw < F.col("share"))
    drawn = drawn.groupBy("doc_id").agg(F.sum("bytes").alias("bytes")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * rows)
    chosen = within(drawn.collect(), most)
    if not chosen:
        return [], []
    wanted = spark.createDataFrame([(r["doc_id"],) for r in chosen], "doc_id long")
    got = known.select("doc_id", "text", "lang").join(F.broadcast(wanted), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(2 * rows).select("text", "lang").toArrow()
    return got.column("text").to_pylist(), got.column("lang").to_pylist()


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array([x for x, _ in found], pa.string()), pa.array([p for _, p in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", held_out(FOLDS, FOLD).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
