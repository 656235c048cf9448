"""Hard-negative mining with a matrix product in a residue number system.

Vectors become whole numbers, and scores are exact inner products. A score is never summed in one wide
number: the matrices are reduced modulo several primes below 1,024, into residues around zero, and for each prime
float32 matrices are multiplied. `DEPTH` columns are multiplied at a time, so that every partial sum is a whole
number below 2 ** 24, which float32 holds exactly in any order of summation. The Chinese remainder theorem
(mixed radix) puts the signed score together from its residues; as many primes are taken as the largest possible
score needs.

Anchors meet all rows in cells of one block of anchors and one strip of rows. A cell's anchors come first, then
its rows pass in batches, so a task holds `ANCHORS` anchors and one batch. The first pass multiplies rows of the
anchors' own labels and keeps the best rows as positives; the second takes rows of other labels within each
positive's window of scores. Strips' lists are merged by rank.

Equal rows are interchangeable, so of one row at most as many copies take part as a list is long, and equal
anchors are mined once; results are repeated for them, so a hot row changes no cell's size.

Defined cases: rows with a null label, a null vector or any null or non-finite component take no part, nor do rows
whose components are so large that a score times 100 would not fit a long (see `limit`); vectors of
other lengths count as filled up with zeros, an empty one scores 0 with all; a null key is no anchor and comes last
among ties; equal keys are rows of their own; other columns are not read; an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import checkpointed, column, partitions

#: Columns that float32 sums exactly: DEPTH * 511 ** 2 < 2 ** 24.
DEPTH = 64
#: Anchors of a block, rows of a strip at least, scores held at once.
ANCHORS, STRIP, SCORES = 4_096, 512, 1 << 20
_NO_KEY = np.iinfo(np.int64).max


def primes(span: int) -> list[int]:
    """Primes below 1,024 in falling order, until their product exceeds the span."""
    found, product = [], 1
    for p in range(1023, 2, -2):
        if product > span:
            break
        if all(p % q for q in range(3, 32, 2)):
            found.append(p)
            product *= p
    return found


def limit(width: int, times: int = 100) -> int:
    """Largest component of vectors of this width: times * width * limit ** 2 fits a long."""
    return int(((1 << 62) // times // max(width, 1)) ** 0.5)


def residues(matrix: np.ndarray, moduli: list[int]) -> list[np.ndarray]:
    """The matrix modulo each prime, around zero, as float32."""
    out = []
    for p in moduli:
        r = matrix % p
        out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return out


def product(a: list[np.ndarray], b: list[np.ndarray], moduli: list[int]) -> np.ndarray:
    """Exact a @ b.T of whole numbers from residues, as int64."""
    digits: list[np.ndarray] = []
    for i, p in enumerate(moduli):
        total = np.zeros((a[i].shape[0], b[i].shape[0]), np.int64)
        for low in range(0, a[i].shape[1], DEPTH):
            total += (a[i][:, low:low + DEPTH] @ b[i][:, low:low + DEPTH].T).astype(np.int32)
        for d, q in zip(digits, moduli):        # mixed radix: what the digits so far leave, divided by their primes
            total = (total - d) % p * pow(q, -1, p)
        digits.append(total % p)
    out, radix = np.zeros_like(digits[0]), 1
    for d, p in zip(digits, moduli):
        out += d * radix
        radix *= p
    out[out > radix // 2] -= radix
    return out


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows of `width` columns, filled up with zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(vectors)), lengths)
    at = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, at] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def best(owner: np.ndarray, score: np.ndarray, key: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k entries of each owner, by falling score, then key."""
    order = np.lexsort((key, -score, owner))
    ranked = owner[order]
    first = np.searchsorted(ranked, ranked)
    return order[np.arange(len(order)) - first < k]


class Cell:
    """The anchors of one cell, and the best rows that its batches have shown so far."""

    def __init__(self, anchors: pa.RecordBatch | pa.Table, width: int, moduli: list[int], k: int):
        self.anchors, self.width, self.moduli, self.k = anchors, width, moduli, k
        self.labels = column_of(anchors, "label").to_numpy(zero_copy_only=False)
        self.parts = residues(matrix(column_of(anchors, "q"), width), moduli)
        self.windows = None
        if "windows" in anchors.schema.names:
            low = [[w["low"] for w in row] for row in column_of(anchors, "windows").to_pylist()]
            high = [[w["high"] for w in row] for row in column_of(anchors, "windows").to_pylist()]
            most = max(map(len, low), default=0)
            fill = lambda rows, x: np.array([r + [x] * (most - len(r)) for r in rows], np.int64).reshape(len(rows), most)
            self.windows = fill(low, 1), fill(high, 0)
        self.found: list[tuple[np.ndarray, ...]] = []

    def add(self, rows: pa.RecordBatch) -> None:
        size = max(1, SCORES // max(len(self.labels), self.width, 1))
        for low in range(0, rows.num_rows, size):
            self.chunk(rows.slice(low, size))
        if sum(len(x[0]) for x in self.found) > SCORES:
            self.prune()

    def chunk(self, rows: pa.RecordBatch) -> None:
        keys = rows.column("vec").fill_null(_NO_KEY).to_numpy(zero_copy_only=False)
        null, labels = rows.column("vec").is_null().to_numpy(zero_copy_only=False), rows.column("label").to_numpy(zero_copy_only=False)
        marks, parts = rows.column("mark").to_numpy(zero_copy_only=False), residues(matrix(rows.column("q"), self.width), self.moduli)

        def keep(owner, score, at):
            # a key that is the largest number comes before null keys, so nulls rank by a key of their own
            order = best(owner, score, np.unique(np.stack([null[at], keys[at]]), axis=1, return_inverse=True)[1].ravel(), self.k) if null.any() \
                else best(owner, score, keys[at], self.k)
            self.found.append((owner[order], score[order], keys[at][order], null[at][order], marks[at][order]))
        if self.windows is None:
            for label in np.intersect1d(self.labels, labels):
                mine, theirs = np.flatnonzero(self.labels == label), np.flatnonzero(labels == label)
                scores = product([p[mine] for p in self.parts], [p[theirs] for p in parts], self.moduli)
                top = min(self.k, len(theirs))
                worst = np.partition(scores, len(theirs) - top, axis=1)[:, len(theirs) - top]
                a, b = np.nonzero(scores >= worst[:, None])
                keep(mine[a], scores[a, b], theirs[b])
            return
        low, high = self.windows
        if not low.shape[1]:
            return
        scores = product(self.parts, parts, self.moduli)
        a, b = np.nonzero((scores >= low.min(1)[:, None]) & (scores <= high.max(1)[:, None]) & (self.labels[:, None] != labels))
        scores = scores[a, b]
        for w in range(low.shape[1]):
            inside = np.flatnonzero((scores >= low[a, w]) & (scores <= high[a, w]))
            keep(a[inside] * low.shape[1] + w, scores[inside], b[inside])

    def prune(self) -> None:
        if self.found:
            owner, score, key, null, mark = (np.concatenate(x) for x in zip(*self.found))
            order = best(owner, score, np.unique(np.stack([null, key]), axis=1, return_inverse=True)[1].ravel() if null.any() else key, self.k)
            self.found = [(owner[order], score[order], key[order], null[order], mark[order])]

    def result(self) -> pa.RecordBatch:
        self.prune()
        owner, score, key, null, mark = self.found[0] if self.found else [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool), np.zeros(0, np.int64)]
        windows = 1 if self.windows is None else max(self.windows[0].shape[1], 1)
        mine = pa.array(owner // windows)
        return pa.RecordBatch.from_arrays(
            [column_of(self.anchors, "vec").take(mine), column_of(self.anchors, "mark").take(mine), pa.array((owner % windows).astype(np.int32)),
             pa.array(key, mask=null), pa.array(mark), pa.array(score)], names=["anchor", "anchor_mark", "w", "vec", "mark", "score"])


def column_of(rows: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    return column(rows, name) if isinstance(rows, pa.Table) else rows.column(name)


def _meet(anchors: DataFrame, rows: DataFrame, width: int, moduli: list[int], blocks: int, strips: int, k: int) -> DataFrame:
    """(anchor, anchor_mark, w, vec, mark, score): the first k rows of every anchor (and window) in every strip."""
    windows = "windows" in anchors.columns
    extra = anchors.schema["windows"].dataType if windows else "array<struct<low:long,high:long>>"
    left = anchors.select("vec", "mark", "label", "q", (F.col("windows") if windows else F.lit(None)).cast(extra).alias("windows"), "blk",
                          F.explode(F.sequence(F.lit(0), F.lit(strips - 1))).alias("strip"), F.lit(0).alias("side"))
    right = rows.select("vec", "mark", "label", "q", F.lit(None).cast(extra).alias("windows"),
                        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("blk"), "strip", F.lit(1).alias("side"))
    dealt = left.unionByName(right).repartition(partitions(rows.sparkSession), "blk", "strip").sortWithinPartitions("blk", "strip", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cell, waiting = None, None, []
        for batch in batches:
            ids = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("blk", "strip", "side")])
            cuts = np.flatnonzero((np.diff(ids, axis=1) != 0).any(0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a == b:
                    continue
                part, place, side = batch.slice(a, b - a), (ids[0, a], ids[1, a]), ids[2, a]
                if place != now:
                    if cell is not None:
                        yield cell.result()
                    now, cell, waiting = place, None, []
                if side == 0:
                    waiting.append(part)
                    continue
                if cell is None and waiting:
                    these = pa.Table.from_batches(waiting)
                    cell = Cell(these if windows else these.drop_columns(["windows"]), width, moduli, k)
                if cell is not None:
                    cell.add(part)
        if cell is not None:
            yield cell.result()
    return dealt.mapInArrow(run, "anchor long, anchor_mark long, w int, vec long, mark long, score long")


def whole(vector: Column, scale: float) -> Column:
    """floor(scale * x) of every component; null if the vector or a component is null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(F.coalesce(finite, F.lit(False)), F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def _floor_percent(x: str) -> Column:
    return F.expr(f"({x} - pmod({x}, 100L)) div 100")


def mine(rows: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: float = 256.0,
         positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and positive.

    A negative's score is between low and high percent of the positive's. `is_anchor` is over `rows`; a row
    with a null key is none."""
    copies = max(positives + 1, negatives)
    fine = (rows.select(F.col(key).cast("long").alias("vec"), F.col(label).cast("long").alias("label"), whole(F.col(vector), scale).alias("q"),
                        F.coalesce(is_anchor & F.col(key).isNotNull(), F.lit(False)).alias("asks"))
            .filter("label is not null and q is not null"))
    width = fine.agg(F.max(F.size("q"))).first()[0]             # the widest vector: one limit for the whole table
    if width is None:
        return _nothing(rows)
    top = limit(width, max(low, high, 100))
    fine = fine.filter(F.forall("q", lambda x: x.between(-top, top))).withColumn("q", F.col("q").cast("array<int>"))
    one = checkpointed(fine.groupBy("vec", "label", "q", "asks").agg(F.count(F.lit(1)).alias("n"))
                       .withColumn("mark", F.xxhash64("label", "q", "asks")))
    size = one.agg(F.sum(F.least("n", F.lit(copies))).alias("rows"), F.count_if("asks").alias("anchors"),
                   F.max(F.greatest(F.array_max("q"), -F.array_min("q"))).alias("most")).first()
    if not size["anchors"]:
        return _nothing(rows)
    blocks = -(-size["anchors"] // max(1, ANCHORS * DEPTH // max(width, DEPTH)))
    strips = max(1, min(2 * partitions(rows.sparkSession), size["rows"] // STRIP))
    moduli = primes(2 * max(width, 1) * int(size["most"] or 0) ** 2 + 1)
    place = F.xxhash64("vec", "mark", F.lit("place"))
    every = one.select("vec", "mark", "label", "q", F.pmod(place, F.lit(strips)).cast("int").alias("strip"),
                       F.explode(F.array_repeat(F.lit(0), F.least("n", F.lit(copies)).cast("int"))))
    asking = one.filter("asks").select("vec", "mark", "label", "q", F.pmod(place, F.lit(blocks)).cast("int").alias("blk"), "n")
    owner = ["anchor", "anchor_mark"]
    order = [F.desc("score"), F.asc_nulls_last("vec"), "mark"]

    # An anchor may be among its own best rows: one row more is taken, and one copy of itself goes.
    of_anchor = W.partitionBy(*owner)
    itself = F.col("vec").eqNullSafe(F.col("anchor")) & (F.col("mark") == F.col("anchor_mark"))
    near = (_meet(asking, every, width, moduli, blocks, strips, positives + 1)
            .withColumn("r", F.row_number().over(of_anchor.orderBy(*order))).filter(F.col("r") <= positives + 1)
            .withColumn("gone", F.min(F.when(itself, F.col("r"))).over(of_anchor)).filter("gone is null or r <> gone")
            .withColumn("w", F.row_number().over(of_anchor.orderBy("r"))).filter(F.col("w") <= positives))
    # low * p <= 100 * s <= high * p as whole bounds of s
    near = near.select(*owner, "w", F.col("vec").alias("positive_id"), F.col("score").alias("positive_score"),
                       (-_floor_percent(f"(-{low}L * score)")).alias("low"), _floor_percent(f"({high}L * score)").alias("high"))
    listed = near.groupBy(*owner).agg(F.array_sort(F.collect_list(F.struct("w", "low", "high", "positive_id", "positive_score"))).alias("p"))
    asked = checkpointed(asking.join(listed, (F.col("vec") == F.col("anchor")) & (F.col("mark") == F.col("anchor_mark"))).drop(*owner))

    windows = F.transform("p", lambda x: F.struct(x.low.alias("low"), x.high.alias("high")))
    far = (_meet(asked.withColumn("windows", windows), every, width, moduli, blocks, strips, negatives)
           .withColumn("rank", F.row_number().over(W.partitionBy(*owner, "w").orderBy(*order))).filter(F.col("rank") <= negatives))
    said = asked.select(F.col("vec").alias("anchor"), F.col("mark").alias("anchor_mark"), "p", "n")
    out = far.join(said, owner).withColumn("positive", F.col("p")[F.col("w")])
    return out.select(F.col("anchor").alias("anchor_id"), "positive.positive_id", "rank", F.col("vec").alias("negative_id"),
                      "positive.positive_score", F.col("score").alias("negative_score"),
                      F.explode(F.array_repeat(F.lit(0), F.col("n").cast("int"))).alias("copy")).drop("copy")


def _nothing(rows: DataFrame) -> DataFrame:
    return rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
