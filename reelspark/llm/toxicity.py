"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is itself and its character n-grams, hashed into buckets. The mean of a window's bucket embeddings
goes through a linear layer and a softmax; a text scores as its highest window, so that one bad
sentence counts alike in a short and in a long text. Windows overlap by half and cover the whole text.
Embeddings and layer are trained jointly in numpy: some rounds on the means of whole texts, then on every
text's highest window. A misspelt word shares most n-grams with the word, so it shares its vector.

The training sample is bounded: at most `positives` and `negatives` labelled rows of the training fold
(those of the smallest key hashes) and at most `SAMPLE_BYTES` of their texts, shared between the classes as
the rows are; a text of more than `ROW_CHARS` characters teaches by `PIECES` even pieces, so no text takes
the others' place. The intercept is then moved to the label shares of the whole training fold. Scoring sends one number per bucket to the tasks.

Defined cases: a null or empty text, or one without words, scores as the share of toxic labels; without labels
of both kinds every score is 0 (nothing is known to be toxic); with both, but texts of one kind only, every text
scores as the share of toxic labels; a key with several labels is toxic if any
is; null labels and keys teach nothing; keys may be null or repeat; other columns are never read.
"""
from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain, groupby, repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fold, release, slices
from .decontaminate import words

BUCKETS, DIM = 1 << 18, 4
#: Words of a window; the next one starts after half of them.
WINDOW = 16
#: Bounds of the training sample, in rows and in bytes of text.
POSITIVES, NEGATIVES, SAMPLE_BYTES = 1_000, 2_000, 16 << 20
#: Characters of one text that enter the sample, at most, and the pieces that a longer text gives.
ROW_CHARS, PIECES = 1 << 16, 16
#: Buckets seen in fewer texts of the sample stay at zero.
LEAST_ROWS = 3
#: Texts whose subwords training looks at together.
BAG_TEXTS = 50
#: Words that a task keeps the sums of, besides those of the texts at hand; longer words are never kept.
CACHE_WORDS, LONG_WORD = 1 << 17, 64


def cuts(length: int, low: int, high: int) -> Iterator[slice]:
    """Where a marked word of so many characters and its n-grams stand."""
    yield slice(0, length)
    for n in range(low, min(high, length - 1) + 1):
        yield from (slice(i, i + n) for i in range(length - n + 1))


def subwords(some: list[bytes], buckets: int, low: int = 3, high: int = 5) -> Iterator[tuple[list[int], np.ndarray]]:
    """Buckets of words and of their character n-grams, with marks at their ends. Words of one length at a time: their
    places in the list, and a row of buckets for each."""
    marked = ["<" + w.decode("utf-8", "replace") + ">" for w in some]
    for length, same in groupby(sorted(range(len(some)), key=lambda i: len(marked[i])), lambda i: len(marked[i])):
        same = list(same)
        if low < length <= LONG_WORD:
            parts = chain.from_iterable(map(itemgetter(*cuts(length, low, high)), (marked[i] for i in same)))
        else:
            parts = (marked[i][at] for i in same for at in cuts(length, low, high))
        hashes = np.fromiter(map(zlib.crc32, map(str.encode, parts)), np.int64)
        yield same, (hashes % buckets).reshape(len(same), -1)


def starts(n: int) -> np.ndarray:
    """Where the windows of a text of n words start."""
    return np.arange(0, max(n - WINDOW // 2, 1), WINDOW // 2) if n else np.zeros(0, np.int64)


def fit(texts: Iterable[str], label: np.ndarray, buckets: int, dim: int = DIM, mean_rounds: int = 12, top_rounds: int = 60,
        rate: float = 1.0) -> tuple[np.ndarray, float]:
    """Slope of every bucket (its embedding through the layer) and intercept, for the second class against the first.

    Texts are read once, one at a time; few and plain arrays stand for them, as the driver keeps what many small ones leave behind."""
    ids: dict[bytes, int] = {}
    coded, ends = array("i"), array("q", [0])
    for t in texts:
        coded.extend(ids.setdefault(w, len(ids)) for w in words(t))
        ends.append(len(coded))
    flat, text_ends, n_texts = np.frombuffer(coded, np.int32), np.frombuffer(ends, np.int64), len(ends) - 1
    groups = [(same, rows.astype(np.int32)) for same, rows in subwords(list(ids), buckets)]
    sizes = np.zeros(len(ids), np.int64)
    for same, rows in groups:
        sizes[same] = rows.shape[1]
    word_ends = np.concatenate([[0], np.cumsum(sizes)])
    places = np.empty(word_ends[-1], np.int32)
    for same, rows in groups:
        places[word_ends[same][:, None] + np.arange(rows.shape[1])] = rows
    del ids, coded, ends, groups, sizes
    pairs = flat.astype(np.int64) * n_texts
    pairs += np.repeat(np.arange(n_texts, dtype=np.int32), np.diff(text_ends))
    pairs.sort()                                                             # in how many texts a bucket stands, by its words
    per_word = np.bincount(pairs[np.diff(pairs, prepend=-1) != 0] // max(n_texts, 1), minlength=len(word_ends) - 1)
    del pairs
    rows_of = np.bincount(places, weights=np.repeat(per_word, np.diff(word_ends)), minlength=buckets)
    live = rows_of >= LEAST_ROWS
    n_live = int(live.sum())
    places = np.where(live, np.cumsum(live) - 1, -1).astype(np.int32)[places]     # from here on the live ones are counted through
    size_sum = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(np.diff(word_ends).astype(np.int32)[flat], out=size_sum[1:])
    first = [starts(n) + at for n, at in zip(np.diff(text_ends).tolist(), text_ends.tolist())]
    owner = np.repeat(np.arange(n_texts), [len(f) for f in first])
    begin = np.concatenate(first) if first else np.zeros(0, np.int64)
    del first
    end = np.minimum(begin + WINDOW, text_ends[owner + 1])
    size = np.maximum(size_sum[end] - size_sum[begin], 1)
    heads = np.flatnonzero(np.diff(owner, prepend=-1))                       # every text's first window
    windows = np.diff(heads, append=len(owner))

    rng = np.random.default_rng(0)
    table = rng.normal(0, 0.1, (buckets, dim))[live].astype(np.float32)      # all others stay at zero
    layer = rng.normal(0, 0.5, (dim, 2)).astype(np.float32)
    shift = np.zeros(2, np.float32)
    target = np.eye(2, dtype=np.float32)[label]
    weight = (0.5 / np.maximum(target.sum(0), 1))[label][:, None].astype(np.float32)
    state = {name: [np.zeros_like(x), np.zeros_like(x)] for name, x in (("table", table), ("layer", layer), ("shift", shift))}

    def spread(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Live buckets of the words in the ranges [a, b), their range, and the range's number of buckets."""
        words_at = np.repeat(a - np.concatenate([[0], np.cumsum(b - a)[:-1]]), b - a) + np.arange((b - a).sum())
        word, of = flat[words_at], np.repeat(np.arange(len(a)), b - a)
        length = word_ends[word + 1] - word_ends[word]
        at = np.repeat(word_ends[word] - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
        place, of = places[at], np.repeat(of, length)
        return place[place >= 0], of[place >= 0], np.maximum(size_sum[b] - size_sum[a], 1)

    def bags() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Live buckets of whole texts, text by text, their shares, and where each text's end. Room for every subword is
        reserved and only used as far as buckets differ."""
        kind, room = np.uint16 if n_live <= 1 << 16 else np.int32, int(size_sum[-1])
        held, shares, ends, at = np.empty(room, kind), np.empty(room, np.float32), np.zeros(n_texts + 1, np.int64), 0
        for low in range(0, n_texts, BAG_TEXTS):
            own = text_ends[low:low + BAG_TEXTS + 1]
            place, of, total = spread(own[:-1], own[1:])
            pair, n = np.unique(of.astype(np.int64) * buckets + place, return_counts=True)
            held[at:at + len(pair)], shares[at:at + len(pair)] = pair % buckets, n / total[pair // buckets]
            ends[low + 1:low + len(own)] = at + np.cumsum(np.bincount(pair // buckets, minlength=len(own) - 1))
            at += len(pair)
        return held, shares, ends

    def whole(held: np.ndarray, shares: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Buckets, texts and shares of whole texts, a few texts at a time."""
        for low in range(0, n_texts, BAG_TEXTS):
            own = ends[low:low + BAG_TEXTS + 1]
            of = np.repeat(np.arange(low, low + len(own) - 1), np.diff(own))
            yield held[own[0]:own[-1]].astype(np.int64), of, shares[own[0]:own[-1]]

    def highest() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Buckets, texts and shares of every text's highest window, some windows at a time."""
        for some in np.array_split(top, len(top) // 250 + 1):
            place, of, total = spread(begin[some], end[some])
            yield place, owner[some][of], (1 / total).astype(np.float32)[of]

    kept = bags() if mean_rounds else None
    for turn in range(mean_rounds + top_rounds):
        if turn >= mean_rounds:
            kept = None
            slope = np.append(table @ (layer[:, 1] - layer[:, 0]), np.float32(0))      # the last one for those at -1
            word_sum = np.add.reduceat(slope[places], word_ends[:-1])
            running = np.zeros(len(flat) + 1)
            np.cumsum(word_sum[flat], dtype=np.float64, out=running[1:])
            value = (running[end] - running[begin]) / size
            del running
            best = np.flatnonzero(value == np.repeat(np.maximum.reduceat(value, heads), windows)) if len(value) else heads
            top = best[np.diff(owner[best], prepend=-1) != 0]
            chosen = list(highest())
        mean, column = np.zeros((n_texts, dim)), np.ascontiguousarray(table.T)
        for place, of, share in whole(*kept) if kept else chosen:
            for d in range(dim):
                mean[:, d] += np.bincount(of, weights=column[d][place] * share, minlength=n_texts)
        mean = mean.astype(np.float32)
        logits = mean @ layer + shift
        p = np.exp(logits - logits.max(1, keepdims=True))
        wrong = (p / p.sum(1, keepdims=True) - target) * weight
        back = wrong @ layer.T
        push, pull = np.zeros((dim, n_live), np.float32), np.ascontiguousarray(back.T)
        for place, of, share in whole(*kept) if kept else chosen:
            for d in range(dim):
                push[d] += np.bincount(place, weights=pull[d][of] * share, minlength=n_live)
        grads = {"layer": mean.T @ wrong, "shift": wrong.sum(0), "table": np.ascontiguousarray(push.T)}
        # Steps follow the gradients' own scale; in the table that of its strongest buckets, so rare ones move little.
        for name, x in (("table", table), ("layer", layer), ("shift", shift)):
            grad, (step, past) = grads[name], state[name]
            past *= 0.9
            past += 0.1 * grad * grad
            scale = np.sqrt(past / (1 - 0.9 ** (turn + 1)))
            if name == "table":
                used = scale.max(1) if n_live else np.ones(1)
                scale = np.maximum(scale, np.quantile(used, 0.999))
            step *= 0.8
            step -= 0.2 * rate * (1.0 if name == "table" else 0.1) * grad / (scale + 1e-12)
            x += step
    slope = np.zeros(buckets, np.float32)
    slope[live] = table @ (layer[:, 1] - layer[:, 0])
    return slope, float(shift[1] - shift[0])


class Model:
    """score = 1 / (1 + exp(-(mean of slope over the subwords + intercept)))."""

    def __init__(self, slope: np.ndarray, intercept: float, prior: float = 0.0):
        self.slope, self.intercept, self.prior, self.known = slope, intercept, prior, {}

    def word_sums(self, some: list[bytes]) -> np.ndarray:
        """The sum of slope over the subwords of every word, and their number. Words are kept for later texts; when
        these are too many, only those of now stay."""
        new = [w for w in some if w not in self.known]
        for same, places in subwords(new, len(self.slope)):
            sums = self.slope[places].sum(axis=1).tolist()
            self.known.update(zip((new[i] for i in same), zip(sums, repeat(places.shape[1]))))
        out = np.fromiter(chain.from_iterable(map(self.known.__getitem__, some)), np.float64).reshape(-1, 2)
        if len(self.known) > CACHE_WORDS:
            self.known = {w: self.known[w] for w in some}
        for w in new:
            if len(w) > LONG_WORD:
                del self.known[w]
        return out

    def scores(self, texts: list[str | None]) -> list[float]:
        """Scores of some texts; what depends on words alone is done once for all of them."""
        if self.intercept == -np.inf:
            return [0.0] * len(texts)
        split = [words(t) for t in texts]
        place = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(split)))}
        got = self.word_sums(list(place))[np.fromiter(map(place.__getitem__, chain.from_iterable(split)), np.int64)]
        out, at = [], 0
        for n in map(len, split):
            if not n:
                out.append(self.prior)
                continue
            running = np.concatenate([[[0, 0]], np.cumsum(got[at:at + n], axis=0)])
            begin, at = starts(n), at + n
            sums = running[np.minimum(begin + WINDOW, n)] - running[begin]
            x = self.intercept + (sums[:, 0] / sums[:, 1]).max()
            out.append(float(1 / (1 + np.exp(-np.clip(x, -700, 700)))))
        return out

    def score(self, text: str | None) -> float:
        return self.scores([text])[0]


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", folds: int = 5,
          held_out: int = 0, buckets: int = BUCKETS, positives: int = POSITIVES, negatives: int = NEGATIVES) -> Model:
    known = (labels.select(F.col(key).alias("known_key"), (F.col(label) == 1).cast("int").alias("label"))
             .filter((fold("known_key", folds) != held_out) & F.col("label").isNotNull())
             .groupBy("known_key").agg(F.max("label").alias("label")))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return Model(np.zeros(buckets, np.float32), -np.inf)
    running = F.sum(F.octet_length("text")).over(W.orderBy("h", "text").rowsBetween(W.unboundedPreceding, 0))     # of bounded rows
    piece, last = ROW_CHARS // PIECES, F.length("text") - ROW_CHARS // PIECES
    pieces = F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), lambda i: F.substr(
        F.col("text"), (F.floor(last.cast("long") * i / (PIECES - 1)) + 1).cast("int"), F.lit(piece)))
    bounded = F.when(F.length("text") > ROW_CHARS, F.array_join(pieces, " ")).otherwise(F.col("text"))

    def sample(v: int, n: int) -> DataFrame:
        chosen = F.broadcast(known.filter(F.col("label") == v).orderBy(F.xxhash64("known_key"), "known_key").limit(n))      # n rows at most
        return (docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter("text is not null")
                .join(chosen, F.col("key") == F.col("known_key")).select("label", bounded.alias("text"), F.xxhash64("key", "text").alias("h"))
                .orderBy("h").limit(2 * n).withColumn("so_far", running)
                .filter(F.col("so_far") <= SAMPLE_BYTES * n // (positives + negatives)).select("label", "text"))
    rows = sample(1, positives).unionByName(sample(0, negatives)).toArrow()
    label_of = rows.column("label").to_numpy().astype(int)
    slope, intercept = (fit((t.as_py() for t in rows.column("text")), label_of, buckets) if len(set(label_of)) == 2
                        else (np.zeros(buckets, np.float32), 0.0))
    del rows
    release()
    return Model(slope, intercept + np.log(counts[1] / counts[0]), counts[1] / (counts[0] + counts[1]))      # trained as if both were as frequent


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds score and predicted to every row."""
    parts = model.slope, model.intercept, model.prior
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*parts)
        for batch in (part for whole in batches for part in slices(whole, 1)):
            scores = own.scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())],
                                             names=["key", "text", "score"])
        own.known.clear()
        release()
    return (docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, text string, score double")
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
            .withColumnRenamed("key", key).withColumnRenamed("text", text))


def select_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Rows that score below 0.5, with all their columns."""
    parts, at = (model.slope, model.intercept, model.prior), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*parts)
        for batch in (part for whole in batches for part in slices(whole, at)):
            yield batch.filter(pc.less(pa.array(own.scores(batch.column(at).to_pylist()), pa.float64()), 0.5))
        own.known.clear()
        release()
    return docs.mapInArrow(run, docs.schema)
