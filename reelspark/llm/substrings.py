"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes of a text (blanks of any kind count as a space); a chunk ends after a
word at whose last byte the hash's top bits are zero, on average every four words, and after
`LONGEST` words at the latest. So an insertion moves only the boundaries next to it. Chunks are compared
by digest: a chunk is a repeat unless it is the first of its digest, in order of the rows' hashes
(of key and text) and of place, whatever the number of partitions. Runs of repeats of at least `least` words are cut out; the first occurrence stays.

A block of rows lists each distinct digest once, so the shuffle carries one number per digest and block,
however many rows repeat it.

Defined cases: a null text stays null and an empty one empty, with 0 words; of repeated rows one keeps
its text; a text that is wholly a repeat becomes empty; keys may be null or repeat; text without a run of
repeats comes back byte for byte.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pack, partitions, unpack

#: Fixed values of the gear: one number per byte, from a seeded generator.
GEAR = np.random.default_rng(20_240_607).integers(0, 1 << 16, 256).astype(np.uint16)
#: A chunk ends at one word in four.
END_BELOW = np.uint16(1 << 14)
LONGEST = 64
#: Words of a run of repeated chunks that is cut out.
LEAST = 20
_BLANKS = bytes(32 if b in b" \t\n\r\x0b\x0c" else b for b in range(256))


def chunks(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte after the last word, words) of every chunk of a text, and the text's bytes."""
    data = np.frombuffer(text.translate(_BLANKS), np.uint8)
    blank = np.append(data == 32, True)
    ends = np.flatnonzero(~blank[:-1] & blank[1:])                       # last byte of every word
    begins = np.flatnonzero(~blank[:-1] & np.append(True, blank[:-2])[:len(data)])
    if not len(ends):
        return ends, ends, ends, data
    rolling = GEAR[data]
    for step in (1, 2, 4, 8):                                            # doubles the window: 2, 4, 8, 16 bytes
        rolling[step:] = rolling[step:] + (rolling[:-step] << np.uint16(step))
    last = np.flatnonzero(rolling[ends] < END_BELOW)
    if not len(last) or last[-1] != len(ends) - 1:
        last = np.append(last, len(ends) - 1)
    gaps = np.diff(np.append(-1, last))
    if (gaps > LONGEST).any():
        more = [np.arange(a + LONGEST, b, LONGEST) for a, b in zip(np.append(-1, last[:-1])[gaps > LONGEST], last[gaps > LONGEST])]
        last = np.unique(np.concatenate([last, *more]))
    first = np.append(-1, last[:-1]) + 1
    return begins[first], ends[last] + 1, last - first + 1, data


def _listed(table: pa.Table) -> tuple[list[int], list[tuple], np.ndarray]:
    """Rows of a block in order of key and text; chunks of each; digests of all chunks in that order."""
    from xxhash import xxh3_64_intdigest
    keys, texts, at = (table.column(c).to_pylist() for c in ("key", "text", "at"))
    order = sorted(range(len(keys)), key=lambda i: (at[i], keys[i] is not None, keys[i] if keys[i] is not None else 0, texts[i] or ""))
    cut, digests = [], []
    for i in order:
        begin, end, n, data = chunks((texts[i] or "").encode("utf-8", "surrogatepass"))
        raw = data.tobytes()
        cut.append((begin, n))
        digests += [xxh3_64_intdigest(raw[a:b]) for a, b in zip(begin.tolist(), end.tolist())]
    return order, cut, np.array(digests, np.uint64)


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(key, text, n_words, n_removed, n_spans): every row's text without the repeats, its words before, words and runs cut."""
    return (_cut(docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.lit(None).cast("int").alias("rest")), least)
            .drop("rest").withColumnRenamed("key", key).withColumnRenamed("text", text))


def rewrite(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str = "n_chars", least: int = LEAST) -> DataFrame:
    """The same rows and columns with the repeats cut from the text; a column of the text's length follows it."""
    others = [c for c in docs.columns if c != text]
    made = _cut(docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.struct(*others).alias("rest")), least)
    new = {text: F.col("text")}
    if length in others:
        new[length] = F.length("text").cast(docs.schema[length].dataType)
    return made.select(*(new.get(c, F.col("rest")[c]).alias(c) for c in docs.columns))


def _cut(rows: DataFrame, least: int) -> DataFrame:
    """Of (key, text, rest): key, rest, text without repeats, n_words, n_removed, n_spans."""
    shards = partitions(rows.sparkSession)
    # Blocks are ranges of the rows' hashes, so the first row of a digest is the same one for any number of blocks.
    blocks = 2 * shards
    rows = (rows.withColumn("at", F.shiftrightunsigned(F.xxhash64("key", "text"), 1))
            .withColumn("blk", F.shiftright(F.shiftright("at", 32) * F.lit(blocks), 31).cast("int")).repartition(shards, "blk"))

    def dealt(digests: np.ndarray) -> list[np.ndarray]:
        seen = np.unique(digests)
        at = (seen >> np.uint64(20)) % np.uint64(shards)
        return [seen[at == s] for s in range(shards)]

    def list_digests(table: pa.Table) -> pa.Table:
        kept = [(s, x) for s, x in enumerate(dealt(_listed(table)[2])) if len(x)]
        return pa.table({"shard": pa.array([s for s, _ in kept], pa.int32()),
                         "blk": pa.array([table.column("blk")[0].as_py()] * len(kept), pa.int32()),
                         "data": pa.array([pack(digest=x) for _, x in kept], pa.binary())})

    def first_blocks(table: pa.Table) -> pa.Table:
        """For every listed digest: does a block before this one list it too?"""
        blk = table.column("blk").to_numpy()
        asked = [unpack(x)["digest"].to_numpy() for x in table.column("data").to_pylist()]
        every = np.concatenate(asked)
        owner = np.repeat(blk, [len(x) for x in asked])
        order = np.lexsort((owner, every))
        later = np.zeros(len(every), bool)
        later[order[1:]] = every[order[1:]] == every[order[:-1]]
        parts = np.split(later, np.cumsum([len(x) for x in asked])[:-1])
        return pa.table({"blk": table.column("blk"), "shard": table.column("shard"),
                         "data": pa.array([pack(later=np.packbits(x)) for x in parts], pa.binary())})

    def cut_out(left: pa.Table, right: pa.Table) -> pa.Table:
        order, cut, digests = _listed(left)
        lists = dealt(digests)
        answers = {s.as_py(): d.as_py() for s, d in zip(right.column("shard"), right.column("data"))}
        repeated = [np.unpackbits(unpack(answers[s])["later"].to_numpy(), count=len(x)).astype(bool)
                    for s, x in enumerate(lists) if len(x)]
        known = np.concatenate([x for x in lists if len(x)]) if repeated else digests
        again = np.concatenate(repeated) if repeated else np.zeros(0, bool)
        rank = np.argsort(known)
        repeat = again[rank][np.searchsorted(known[rank], digests)] if len(digests) else np.zeros(0, bool)
        own_first = np.zeros(len(digests), bool)
        own_first[np.unique(digests, return_index=True)[1]] = True
        repeat |= ~own_first
        texts, at, out = left.column("text").to_pylist(), 0, {}
        for i, (begin, n) in zip(order, cut):
            mine = repeat[at:at + len(n)]
            at += len(n)
            flips = np.flatnonzero(np.diff(np.concatenate([[0], mine.astype(np.int8), [0]])))
            total = np.concatenate([[0], np.cumsum(n)])
            runs = [(a, b) for a, b in flips.reshape(-1, 2) if total[b] - total[a] >= least]
            raw = texts[i]
            if runs:
                data, edges = raw.encode("utf-8", "surrogatepass"), np.append(begin, len(raw.encode("utf-8", "surrogatepass")))
                keep, done = [], 0
                for a, b in runs:
                    keep.append(data[done:edges[a]])
                    done = edges[b]
                raw = b"".join([*keep, data[done:]]).decode("utf-8", "surrogatepass")
                raw = raw if raw.strip() else ""
            out[i] = raw, int(total[-1]), int(sum(total[b] - total[a] for a, b in runs)), len(runs)
        columns = list(zip(*(out[i] for i in range(len(texts)))))
        return pa.table({"key": left.column("key"), "rest": left.column("rest"), "text": pa.array(columns[0], pa.string()), "n_words": pa.array(columns[1], pa.int64()),
                         "n_removed": pa.array(columns[2], pa.int64()), "n_spans": pa.array(columns[3], pa.int64())})

    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType), T.StructField("rest", rows.schema["rest"].dataType),
                           T.StructField("text", T.StringType()),
                           *(T.StructField(c, T.LongType()) for c in ("n_words", "n_removed", "n_spans"))])
    answers = (rows.select("blk", "key", "text", "at").groupBy("blk").applyInArrow(list_digests, "shard int, blk int, data binary")
               .groupBy("shard").applyInArrow(first_blocks, "blk int, shard int, data binary"))
    return rows.groupBy("blk").cogroup(answers.groupBy("blk")).applyInArrow(cut_out, schema)
