"""Helpers shared by the operators: folds, blocks of rows, packed columns, checkpoints.

Several operators need one fact about every distinct item (a word, a chunk) of the whole corpus in
the place where the text is. They do it in three steps, each a grouped Arrow function:

1. rows are dealt into blocks by a hash of the whole row; a block lists its distinct items, dealt
   into shards by a hash of the item (`deal`);
2. a shard sees each item at most once per block, however often it occurs, and answers per block;
3. a block joins the answers back to its rows by the order in which it had listed the items.

So a hot item costs one entry per block, and no group is larger than a block's distinct items.
"""
from __future__ import annotations

import ctypes
import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session; the operators size blocks and shards by it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo n; null for a null key."""
    return F.crc32(F.col(key).cast("string")) % F.lit(n)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def in_blocks(rows: DataFrame, by: tuple[str, ...] = ("key", "text"), per_partition: int = 2) -> DataFrame:
    """Adds blk, a block number from a hash of key and text, and shuffles by it once.

    Evaluating it twice gives the same blocks with the same rows (in any order)."""
    n = partitions(rows.sparkSession)
    return (rows.withColumn("blk", F.pmod(F.xxhash64(*by), F.lit(n * per_partition)).cast("int"))
            .repartition(n, "blk"))


def plain_values(values: pa.Array) -> list:
    """Many words as Python values, by way of numpy: to_pylist makes an Arrow scalar of each one first."""
    return values.to_numpy(zero_copy_only=False).tolist()


def deal(items: pa.Array, shards: int) -> list[pa.Array]:
    """Distinct items (binary) by shard, each in byte order: the same list whenever the same block is dealt."""
    seen = pc.unique(items).drop_null()
    seen = seen.take(pc.sort_indices(seen))
    at = np.fromiter(map(zlib.crc32, plain_values(seen)), np.int64, len(seen)) % shards
    order = np.argsort(at, kind="stable")
    ends = np.searchsorted(at[order], np.arange(shards + 1))
    return [seen.take(pa.array(order[a:b])) for a, b in zip(ends[:-1], ends[1:])]


def pack(**columns) -> bytes:
    """Columns of any lengths as compressed Arrow bytes."""
    arrays = {k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()}
    batch = pa.record_batch([pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in arrays.values()],
                            names=list(arrays))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(data: bytes) -> dict[str, pa.Array]:
    with pa.ipc.open_stream(data) as stream:
        batch = stream.read_next_batch()
    return {name: batch.column(i).flatten() for i, name in enumerate(batch.schema.names)}


def column(table: pa.Table, name: str) -> pa.Array:
    """One column as one array."""
    whole = table.column(name).combine_chunks()
    return whole.combine_chunks() if isinstance(whole, pa.ChunkedArray) else whole


def slices(batch: pa.RecordBatch, text: int, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """A batch as runs of rows with about so many bytes of text, so that a task's words are held a few texts at a time."""
    total = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = (np.flatnonzero(np.diff(total // size)) + 1).tolist()
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(a, b - a)
    release()


def texts(values: pa.Array) -> list[str]:
    """Texts with null as empty."""
    return [x or "" for x in values.to_pylist()]


def checkpointed(rows: DataFrame) -> DataFrame:
    """Cuts the lineage in the folder that the session names; only without one (tests) in a new local folder."""
    sc = rows.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(rows.sparkSession.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="spark-"))
    return rows.checkpoint()


def release() -> None:
    """Gives what was freed back to the system: Arrow's pool and, where the C library can, its heap. Else a driver
    that trained a model, and a worker that served a stage, hold the pages of its arrays through all later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
