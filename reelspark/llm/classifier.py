"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

A text's features are its words, its pairs of neighbouring words, and two marks for a word that repeats
the one before it or the one before that, hashed into buckets. Their counts, scaled to length 1, are a
sparse vector; a score is the logistic function of its dot product with the weights. Training keeps two
numbers per bucket, the gradients' adjusted sum z and the sum of their squares n, and derives each
weight from them (proximal form, per-coordinate rates, L1 and L2), so weights without evidence stay 0.

The training sample is bounded: of each class at most `rows` labelled rows of the training fold (those of the
smallest hashes of key and text, repeated rows once) within `SAMPLE_BYTES`; a text of more than `ROW_CHARS`
characters teaches by `PIECES` even pieces. Classes weigh alike in training; `balanced=False` then moves
the intercept to the label shares of the whole training fold. Scoring reads whole texts.

Defined cases: a null or empty text, or one without words, scores as the intercept alone; without labels of
both kinds (or texts of both) every score is the share of high labels (0.5 without any label); a key with
several labels is high only if all are; null labels and keys teach nothing; keys may be null or repeat;
other columns are never read.
"""
from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import checkpointed, fold, slices

BUCKETS = 1 << 18
#: Bounds of the training sample: rows of a class, bytes of text of a class, characters of a text and their pieces.
ROWS, SAMPLE_BYTES = 4_000, 8 << 20
ROW_CHARS, PIECES = 1 << 14, 16
#: Training: rate, L1, L2, passes over the sample.
RATE, L1, L2, ROUNDS = 0.5, 1e-3, 1e-3, 6
#: Words and single marks, in bytes: ASCII letters, digits and everything beyond ASCII make words.
_TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+|[^a-z0-9\x80-\xff\s]")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def features(text: str | None, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets in order, values of length 1) of a text."""
    words = _TOKEN.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    word = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    again = [np.full(np.count_nonzero(word[k:] == word[:-k]), k, np.uint64) for k in (1, 2)]
    pair = (word[:-1] * _MIX) ^ word[1:]
    every = np.concatenate([word << np.uint64(2), (pair << np.uint64(2)) | np.uint64(1), *(x << np.uint64(2) | np.uint64(2) for x in again)])
    place = ((every * _MIX) >> np.uint64(32)) % np.uint64(buckets)
    at, n = np.unique(place.astype(np.int64), return_counts=True)
    return at, n / np.sqrt(np.square(n, dtype=np.float64).sum())


def leader(z: np.ndarray, n: np.ndarray, rate: float, l1: float, l2: float) -> np.ndarray:
    """The weights that the regularised leader has after gradients with sums z and squares n."""
    return -np.sign(z) * np.maximum(np.abs(z) - l1, 0) / ((1 + np.sqrt(n)) / rate + l2)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, buckets: int, rounds: int = ROUNDS, rate: float = RATE,
        l1: float = L1, l2: float = L2) -> tuple[np.ndarray, float]:
    """Weights and intercept; both classes weigh alike."""
    z, n, z0, n0 = np.zeros(buckets), np.zeros(buckets), 0.0, 0.0
    share = 0.5 / np.maximum(np.bincount(label, minlength=2) / max(len(label), 1), 1e-9)
    rng = np.random.default_rng(0)
    for _ in range(rounds):
        for k in rng.permutation(len(rows)):
            at, x = rows[k]
            w, w0 = leader(z[at], n[at], rate, l1, l2), float(leader(np.array(z0), np.array(n0), rate, 0.0, 0.0))
            p = 1 / (1 + np.exp(-np.clip(w @ x + w0, -35, 35)))
            slope = (p - label[k]) * share[label[k]]
            grad = slope * x
            z[at] += grad - (np.sqrt(n[at] + grad * grad) - np.sqrt(n[at])) / rate * w
            n[at] += grad * grad
            z0 += slope - (np.sqrt(n0 + slope * slope) - np.sqrt(n0)) / rate * w0
            n0 += slope * slope
    return leader(z, n, rate, l1, l2), float(leader(np.array(z0), np.array(n0), rate, 0.0, 0.0))


class Model:
    """score = 1 / (1 + exp(-(weights · features + intercept)))."""

    def __init__(self, weights: np.ndarray, intercept: float):
        self.weights, self.intercept = weights, intercept

    def score(self, text: str | None) -> float:
        at, x = features(text, len(self.weights))
        return float(1 / (1 + np.exp(-np.clip(self.weights[at] @ x + self.intercept, -700, 700))))


def sample(docs: DataFrame, known: DataFrame, rows: int, key: str, text: str) -> DataFrame:
    """(label, text) of the bounded sample: first chosen by lengths, then read."""
    last, piece = F.length("text") - ROW_CHARS // PIECES, F.lit(ROW_CHARS // PIECES)
    pieces = F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), lambda i: F.substr(
        F.col("text"), (F.floor(last.cast("long") * i / (PIECES - 1)) + 1).cast("int"), piece))
    body = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(key, text).alias("h")).filter("text is not null")

    def least(table: DataFrame, *by: str) -> DataFrame:
        """The first `rows` of either class; every task sends that many at most."""
        classes = [table.filter(F.col("label") == v).orderBy(*by).limit(rows) for v in (0, 1)]
        return classes[0].unionByName(classes[1])
    some = F.broadcast(least(known.withColumn("known_h", F.xxhash64("known_key")), "known_h", "known_key").select("known_key", "label"))
    sizes = (body.join(some, F.col("key") == F.col("known_key"))
             .groupBy("label", "key", "h").agg(F.max(F.least(F.octet_length("text"), F.lit(4 * ROW_CHARS))).alias("bytes")))
    first = W.partitionBy("label").orderBy("h", "key").rowsBetween(W.unboundedPreceding, 0)       # of 2 * rows at most
    chosen = (least(sizes, "h", "key").withColumn("so_far", F.sum("bytes").over(first))
              .filter((F.col("so_far") <= SAMPLE_BYTES) | (F.col("so_far") == F.col("bytes")))
              .select("label", F.col("key").alias("of"), F.col("h").alias("of_h")))
    bounded = F.when(F.length("text") > ROW_CHARS, F.array_join(pieces, " ")).otherwise(F.col("text"))
    return (body.join(F.broadcast(chosen), (F.col("key") == F.col("of")) & (F.col("h") == F.col("of_h")))        # 2 * rows at most
            .groupBy("label", "key", "h").agg(F.min(bounded).alias("text")))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", folds: int = 3,
          held_out: int = 1, buckets: int = BUCKETS, rows: int = ROWS, balanced: bool = False) -> Model:
    known = checkpointed(labels.select(F.col(key).alias("known_key"), (F.col(label) == 1).cast("int").alias("label"))
                         .filter((fold("known_key", folds) != held_out) & F.col("label").isNotNull())
                         .groupBy("known_key").agg(F.min("label").alias("label")))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    high, low = counts.get(1, 0), counts.get(0, 0)
    if high and low:
        got = sample(docs, known, rows, key, text).toArrow().sort_by([("label", "ascending"), ("h", "ascending"), ("key", "ascending")])
        of = got.column("label").to_numpy().astype(int)
        if len(set(of)) == 2:
            weights, intercept = fit([features(t.as_py(), buckets) for t in got.column("text")], of, buckets)
            return Model(weights.astype(np.float32), intercept + (0.0 if balanced else float(np.log(high / low))))
    share = high / (high + low) if high + low else 0.5
    return Model(np.zeros(buckets, np.float32), float(np.clip(np.log(max(share, 1e-300)) - np.log(max(1 - share, 1e-300)), -700, 700)))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, predicted) of every row."""
    parts = model.weights, model.intercept
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*parts)
        for batch in (part for whole in batches for part in slices(whole, 1)):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([own.score(x.as_py()) for x in batch.column(1)], pa.float64())],
                                             names=["key", "score"])
    return (docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, score double")
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")).withColumnRenamed("key", key))
