"""N-gram Jaccard join: which texts share at least 80 of 100 of their word shingles?

Equal sets become one class first, by digest. A class keeps a sketch (its `SKETCH` smallest shingle
hashes) and a parity bitmap whose width follows its size. Classes of one sketch entry form a tile,
ordered by size, in which only sizes within the threshold meet; keys shared by more than `HOT` classes
are split further into size bands, a class visiting the next larger band. In a tile the bits that differ
bound the sets' difference from below, so the overlap from above; pairs that the bound lets through
connect candidate groups. Groups then get their classes' whole sorted arrays and are resolved by exact
intersection, large groups in chunks that all meet each other.

Two sets of similarity J share no sketch entry with probability (1 - J) ** SKETCH, below 2e-14 for 0.8,
which is less than the chance that 64-bit hashes of two shingles agree; apart from both nothing is lost.

Defined cases: without words, or with a null text, the set is empty and linked with nothing; texts of
fewer words than a shingle are one shingle; rows with a null key count as members but never name a
group (a group of null keys only has a null component_id); repeated rows are copies.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, partitions, slices
from .components import components

WORDS, SKETCH = 5, 20
#: Classes of one sketch entry above which a tile is split into size bands.
HOT = 5_000
#: Classes of a candidate group that are compared in one task.
CHUNK = 5_000
#: Fixed values of the shingle hash: odd multipliers by word, from a seeded generator.
_MIX = np.random.default_rng(7).integers(1 << 40, 1 << 63, 16).astype(np.uint64) | np.uint64(1)


def _finish(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[str | None], size: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of every text."""
    from xxhash import xxh3_64_intdigest
    split = [t.encode("utf-8", "surrogatepass").lower().split() if t else [] for t in texts]
    flat = np.fromiter(map(xxh3_64_intdigest, chain.from_iterable(split)), np.uint64)
    out, at = [], 0
    for t in split:
        own = flat[at:at + len(t)]
        at += len(t)
        n = min(size, len(own))
        if not n:
            out.append(own)
            continue
        total = np.full(len(own) - n + 1, np.uint64(n))
        for k in range(n):
            total += own[k:len(own) - n + 1 + k] * _MIX[k]
        out.append(np.unique(_finish(total)))
    return out


def bitmap(hashes: np.ndarray) -> bytes:
    """Parity of the hashes by place; as many places as elements, rounded up to a power of two, 64 at least."""
    width = 1 << max(6, (len(hashes) - 1).bit_length())
    places = (hashes >> np.uint64(8)).astype(np.int64) & (width - 1)
    return np.packbits((np.bincount(places, minlength=width) & 1).astype(np.uint8), bitorder="little").tobytes()


def _fold(bits: np.ndarray, width: int) -> np.ndarray:
    """A parity bitmap (64-bit words) at half the width or less."""
    while len(bits) > width:
        bits = bits[:len(bits) // 2] ^ bits[len(bits) // 2:]
    return bits


def _enough(overlap, a, b, per_cent: int):
    return 100 * overlap >= per_cent * (a + b - overlap)


def sets(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(key, code, n, node, keys, bits): hash of the text, size, digest, sketch and bitmap of every row; without words node is null."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest
        for batch in (part for whole in batches for part in slices(whole, 1)):
            made = shingles(batch.column(1).to_pylist(), size)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), pa.array([len(h) for h in made], pa.int64()),
                pa.array([xxh3_128_digest(h.tobytes()) if len(h) else None for h in made], pa.binary()),
                pa.array([h[:SKETCH].view(np.int64) for h in made], pa.list_(pa.int64())),
                pa.array([bitmap(h) if len(h) else b"" for h in made], pa.binary())], names=["key", "code", "n", "node", "keys", "bits"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("code")).mapInArrow(
        run, f"key {kind}, code long, n long, node binary, keys array<long>, bits binary")


def candidates(classes: DataFrame, per_cent: int) -> DataFrame:
    """Edges (a, b) that connect, tile by tile, all classes whose bitmaps allow the similarity."""
    keyed = classes.select("node", "n", F.explode("keys").alias("entry"))
    shared = keyed.groupBy("entry").count().filter("count > 1")
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / per_cent))).cast("int")
    placed = keyed.join(shared, "entry").select("entry", "node", F.explode(
        F.when(F.col("count") > HOT, F.array(band, band + 1)).otherwise(F.array(F.lit(-1)))).alias("band"))
    rows = (placed.join(classes.select("node", "n", "bits"), "node")
            .repartition(partitions(classes.sparkSession), "entry", "band").sortWithinPartitions("entry", "band", "n", "node")
            .select("entry", "band", "n", "node", "bits"))

    def connect(sizes: np.ndarray, nodes: list[bytes], bits: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        words = [np.frombuffer(b, np.uint64) for b in bits]
        widths = np.array([len(w) for w in words])
        tables: dict[int, tuple[int, np.ndarray]] = {}
        root = np.arange(len(nodes))
        low = np.searchsorted(sizes * 100, sizes * per_cent)                # first size that can reach the threshold
        for i in range(1, len(nodes)):
            a, width = low[i], widths[low[i]]
            if a == i:
                continue
            if width not in tables:                                         # a row meets its own width and half of it
                begin, end = np.searchsorted(widths, [width, 2 * width + 1])
                tables[width] = begin, np.stack([_fold(w, width) for w in words[begin:end]])
            begin, table = tables[width]
            differ = np.bitwise_count(table[a - begin:i - begin] ^ table[i - begin]).sum(1, dtype=np.int64)
            most = np.minimum((sizes[a:i] + sizes[i] - differ) // 2, sizes[a:i])
            near = a + np.flatnonzero(_enough(most, sizes[a:i], sizes[i], per_cent))
            if not len(near):
                continue
            for r in np.unique(root[near]):
                root[root == r] = root[i]
        # One star per group, at its smallest node: the same one in most tiles that the group's classes share.
        groups: dict[int, list[bytes]] = {}
        for r, node in zip(root.tolist(), nodes):
            groups.setdefault(r, []).append(node)
        for group in groups.values():
            centre = min(group)
            yield from ((centre, node) for node in group if node != centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def emit(part: pa.Table) -> Iterator[pa.RecordBatch]:
            entry, band = part.column("entry").to_numpy(), part.column("band").to_numpy()
            sizes, nodes, bits = part.column("n").to_numpy(), part.column("node").to_pylist(), part.column("bits").to_pylist()
            cuts = np.flatnonzero((np.diff(entry) != 0) | (np.diff(band) != 0)) + 1
            edges: dict[tuple[bytes, bytes], None] = {}
            for a, b in zip(np.append(0, cuts), np.append(cuts, len(entry))):
                if b - a > 1:
                    edges.update(dict.fromkeys(connect(sizes[a:b], nodes[a:b], bits[a:b])))
            if edges:
                left, right = zip(*edges)
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            whole = pa.Table.from_batches([*held, batch])
            entry, band = whole.column("entry").to_numpy(), whole.column("band").to_numpy()
            cuts = np.flatnonzero((np.diff(entry) != 0) | (np.diff(band) != 0)) + 1
            cut = int(cuts[-1]) if len(cuts) else 0                          # the last tile may go on in the next batch
            if cut:
                yield from emit(whole.slice(0, cut))
            held = whole.slice(cut).combine_chunks().to_batches()
        if held:
            yield from emit(pa.Table.from_batches(held))

    return rows.mapInArrow(run, "a binary, b binary")


def resolve(members: DataFrame, per_cent: int) -> DataFrame:
    """(a, b, whole) of (bin, grp, chunks, part, node, hashes) rows: stars of true links from the smallest node of each
    component of a group's part; whole: the part is all of its group, so a is the component's label.

    Rows of one bin are compared group by group."""
    def run(table: pa.Table) -> pa.Table:
        groups: dict = {}
        for grp, chunks, part, node, data in zip(*(table.column(c).to_pylist() for c in ("grp", "chunks", "part", "node", "hashes"))):
            groups.setdefault((grp, part, chunks), {})[node] = data                # several tasks may have sent a node
        left, right, whole = [], [], []
        for (_, _, chunks), members in groups.items():
            rows = sorted((len(data) // 8, node, data) for node, data in members.items())
            sizes = np.array([n for n, _, _ in rows])
            arrays = [np.frombuffer(d, np.uint64) for _, _, d in rows]
            root = np.arange(len(rows))
            low = np.searchsorted(sizes * 100, sizes * per_cent)
            for i in range(1, len(rows)):
                open_ = np.flatnonzero(root[low[i]:i] != root[i]) + low[i]
                while len(open_):
                    j = open_[-1]                                            # nearest in size first
                    both = len(np.intersect1d(arrays[i], arrays[j], assume_unique=True))
                    if _enough(both, len(arrays[i]), len(arrays[j]), per_cent):
                        root[root == root[j]] = root[i]
                        open_ = open_[root[open_] != root[i]]
                    else:
                        open_ = open_[:-1]
            stars: dict[int, list[bytes]] = {}
            for r, (_, node, _) in zip(root.tolist(), rows):
                stars.setdefault(r, []).append(node)
            for nodes in stars.values():
                left += [min(nodes)] * len(nodes)
                right += nodes
            whole += [chunks == 1] * len(rows)
        return pa.table({"a": pa.array(left, pa.binary()), "b": pa.array(right, pa.binary()), "whole": pa.array(whole, pa.bool_())})

    return members.groupBy("bin").applyInArrow(run, "a binary, b binary, whole boolean")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WORDS, per_cent: int = 80) -> DataFrame:
    """(key, n_shingles, component_id): one row per row, with the smallest key that its links reach."""
    rows = checkpointed(sets(docs, key, text, size))
    kind = rows.schema["key"].dataType.simpleString()
    classes = (rows.filter("node is not null").groupBy("node")
               .agg(F.min(F.struct("key", "code")).alias("owner"), F.min("n").alias("n"), F.first("keys").alias("keys"), F.first("bits").alias("bits")))
    guess = components(candidates(classes, per_cent)).select("node", F.col("label").alias("grp"))

    # Whole arrays of the classes in groups, from the text of one row of each. Key and text find it, as keys may repeat or be
    # null; rows equal in both give one array per task.
    owners = guess.join(classes.select("node", F.col("owner.key").alias("owner"), F.col("owner.code").alias("code")), "node")
    sizes = guess.groupBy("grp").agg(F.count("*").alias("m"))
    placed = owners.join(sizes, "grp").withColumn("chunks", F.ceil(F.col("m") / CHUNK).cast("int"))

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest
        done: set[bytes] = set()
        for batch in (part for whole in batches for part in slices(whole, 1)):
            fresh = []
            for i, node in enumerate(batch.column(0).to_pylist()):
                if node not in done:
                    done.add(node)
                    fresh.append(i)
            batch = batch.take(pa.array(fresh, pa.int64()))
            made = shingles(batch.column(1).to_pylist(), size)
            same = [len(h) > 0 and xxh3_128_digest(h.tobytes()) == node for h, node in zip(made, batch.column(0).to_pylist())]
            done.difference_update(node for ok, node in zip(same, batch.column(0).to_pylist()) if not ok)
            keep = pa.array(same, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(2).filter(keep), batch.column(3).filter(keep),
                                              pa.array([h.tobytes() for h, ok in zip(made, same) if ok], pa.binary())],
                                             names=["node", "grp", "chunks", "hashes"])

    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    whole = (source.join(placed, F.col("key").eqNullSafe(F.col("owner")) & (F.col("hash") == F.col("code"))).select("node", "text", "grp", "chunks")
             .mapInArrow(arrays, "node binary, grp binary, chunks int, hashes binary"))
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda o: F.least(own, o) * F.col("chunks") + F.greatest(own, o))
    bins = partitions(docs.sparkSession) * 4
    members = (whole.withColumn("part", F.explode(parts)).select(
        F.pmod(F.xxhash64("grp", "part"), F.lit(bins)).cast("int").alias("bin"), "grp", "chunks", "part", "node", "hashes"))
    links = checkpointed(resolve(members, per_cent))
    linked = links.filter("whole").groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label"))      # once per repeated key
    if links.filter("not whole").limit(1).count():                           # groups that were compared in several tasks
        linked = linked.unionByName(components(links.filter("not whole")))

    labelled = (rows.select("key", "n", "node").join(linked, "node", "left")
                .select("key", "n", F.coalesce("label", "node").alias("label")))
    names = labelled.filter("label is not null").groupBy("label").agg(F.min("key").alias("component_id"))
    out = labelled.join(names, "label", "left")
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"),
                      F.when(F.col("label").isNull(), F.col("key")).otherwise(F.col("component_id")).cast(kind).alias("component_id"))
