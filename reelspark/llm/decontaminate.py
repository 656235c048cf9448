"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A test item becomes windows of consecutive words. For windows of one length the search keeps the shift
of every block of two words, and buckets of windows by their last block. At a place of a text the block
that ends there either allows a shift past impossible places, or names a bucket whose windows are
compared word by word.

Items travel to tasks in shards of about `shard_bytes` of their text. A benchmark above that bound is searched in
one pass over the texts per shard, the rows being written to the checkpoint folder between passes: the driver
and a task hold one shard at a time, however large the benchmark is.

Defined cases: a null or empty text, or one without words, has no words and no hits; an item without
words or with a null text has no windows; an item with a null id hits words but is not counted or
listed; repeated items and repeated rows are each answered as they stand; keys may be null.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed

#: Bytes as words see them: A-Z in lower case, every other ASCII character that is no letter or digit a blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def windows(item: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    if len(item) <= size:
        return [tuple(item)] if item else []
    return [tuple(item[i:i + size]) for i in range(len(item) - size + 1)]


class WuManber:
    """Search for windows of one length."""

    def __init__(self, length: int, owners: dict[tuple[bytes, ...], set]):
        self.length, self.block = length, min(2, length)
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], set[tuple[bytes, ...]]] = {}
        for window in owners:
            for end in range(self.block, length + 1):
                part = window[end - self.block:end]
                self.shift[part] = min(self.shift.get(part, length), length - end)
            self.buckets.setdefault(window[-self.block:], set()).add(window)

    def find(self, text: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """Every place where a window starts, with the window."""
        length, block, shift, buckets = self.length, self.block, self.shift.get, self.buckets
        past = length - block + 1
        end, last = length, len(text)
        while end <= last:
            part = tuple(text[end - block:end])
            step = shift(part, past)
            if step:
                end += step
                continue
            start = end - length
            window = tuple(text[start:end])
            if window in buckets[part]:
                yield start, window
            end += 1


class Shard:
    """Searches for all windows of a shard of (name, text) items, one per window length."""

    def __init__(self, items: list[tuple], size: int):
        by_length: dict[int, dict[tuple, set]] = {}
        for name, text in items:
            for w in windows(words(text), size):
                by_length.setdefault(len(w), {}).setdefault(w, set()).add(name)
        self.searches = [(WuManber(n, owners), owners) for n, owners in sorted(by_length.items())]

    def find(self, text: list[bytes]) -> Iterator[tuple[int, int, set]]:
        for search, owners in self.searches:
            for start, w in search.find(text):
                yield start, start + len(w), owners[w]


def _search(items: list[tuple], size: int):
    """Finds a shard's windows in batches of (key, text, n_words, spans, item_ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(items, size)
        for batch in batches:
            spans, ids, counts = batch.column(3).to_pylist(), batch.column(4).to_pylist(), []
            for row, text in enumerate(batch.column(1)):
                own = words(text.as_py())
                counts.append(len(own))
                found = list(shard.find(own))
                if found:
                    spans[row] = merged([*((s["start"], s["end"]) for s in spans[row]), *((a, b) for a, b, _ in found)])
                    ids[row] = sorted({*ids[row], *(n for *_, names in found for n in names if n is not None)})
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()),
                 pa.array(spans, batch.schema.field(3).type), pa.array(ids, batch.schema.field(4).type)],
                schema=batch.schema)
    return run


def _shards(items: DataFrame, item: str, item_text: str, shard_bytes: int) -> Iterator[list[tuple]]:
    """Items (name as string, text) in shards of about so many bytes of text; each shard holds whole items."""
    named = items.select(F.col(item).cast("string").alias("name"), F.col(item_text).alias("text")).filter("text is not null")
    total = named.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // shard_bytes))
    for k in range(n):
        yield [tuple(r) for r in named.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == k).collect()]


def merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], end)
        else:
            out.append({"start": start, "end": end})
    return out


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
           item_text: str = "text", size: int = 10, shard_bytes: int = 16 << 20) -> DataFrame:
    """(key, text, n_words, spans, item_ids): where words of the text lie in occurrences of item windows.

    spans: merged word ranges, from 0, end not included. item_ids: names as strings, sorted."""
    kind = docs.schema[key].dataType
    out = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.lit(0).cast("long").alias("n_words"),
                      F.array().cast("array<struct<start:int,end:int>>").alias("spans"),
                      F.array().cast("array<string>").alias("item_ids"))
    schema = T.StructType([T.StructField("key", kind), *out.schema.fields[1:]])
    for k, items_of_shard in enumerate(_shards(items, item, item_text, shard_bytes)):
        out = (checkpointed(out) if k else out).mapInArrow(_search(items_of_shard, size), schema)
    return out.withColumnRenamed("key", key).withColumnRenamed("text", text)


def select_clean(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
                 size: int = 10, shard_bytes: int = 16 << 20) -> DataFrame:
    """Rows without any hit, with all their columns."""
    at = docs.columns.index(text)

    def without(items_of_shard: list[tuple]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard = Shard(items_of_shard, size)
            for batch in batches:
                yield batch.filter(pa.array([next(shard.find(words(x.as_py())), None) is None for x in batch.column(at)], pa.bool_()))
        return run
    for k, items_of_shard in enumerate(_shards(items, item, item_text, shard_bytes)):
        docs = (checkpointed(docs) if k else docs).mapInArrow(without(items_of_shard), docs.schema)
    return docs
