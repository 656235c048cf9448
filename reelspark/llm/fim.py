"""Fill-in-the-middle transformation with a piece table.

A text is never copied while it is rearranged. It becomes descriptors (buffer, start, length) over two
immutable buffers: the text's bytes and the sentinels. Two cuts split the descriptor of the whole text
in three, an arrangement permutes the pieces and puts sentinel descriptors between them, and the output
is what the descriptors point at. The inverse looks up the sentinels in an output, cuts there, drops
their descriptors and permutes back. Hashes run over the descriptors, so a digest needs no joined text.

Units are `[A-Za-z]+|[^A-Za-z]` over code points. Cuts and forms come from the sha256 of the key, so
the same key always gives the same form, and no row needs another one: there is no shuffle.

* plain: the text; when it is empty, holds a sentinel, or its third hash says so.
* psm: `<P>`prefix`<S>`suffix`<M>`middle.
* spm: `<S>`suffix`<P>`prefix`<M>`middle.

Defined cases: a null text is empty, and empty texts are plain; a null key hashes as an empty one; repeated
rows each give a row, equal keys cut alike; a prefix, middle or suffix may be empty; an output that is null or
does not fit its form is restored as null; other columns are not read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

#: The sentinels.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
#: Shares in percent: texts that are rearranged, and of these the ones with the suffix first.
RATE, SPM_RATE = 90, 20
TEXT, MARKS = 0, 1
PIECES = "pieces array<struct<buffer:int,start:long,length:long>>"

_LETTER = np.zeros(256, np.bool_)
_LETTER[np.r_[65:91, 97:123]] = True

Piece = tuple[int, int, int]


def unit_starts(data: bytes) -> np.ndarray:
    """Byte places where units start, in UTF-8."""
    raw = np.frombuffer(data, np.uint8)
    letter = _LETTER[raw]
    begins = (raw & 0xC0) != 0x80           # not inside a code point
    begins[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(begins)


def code_points(data: bytes, start: int, length: int) -> int:
    raw = np.frombuffer(data, np.uint8, length, start)
    return int(length - np.count_nonzero((raw & 0xC0) == 0x80))


def hashes(key: str) -> list[int]:
    digest = hashlib.sha256(b"1:" + key.encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def cut(pieces: list[Piece], places: list[int]) -> list[list[Piece]]:
    """Splits descriptors at places counted in bytes from the start of the sequence: one list per part."""
    parts: list[list[Piece]] = [[]]
    ends, at = [*places, None], 0
    for buffer, start, length in pieces:
        while ends[0] is not None and ends[0] <= at + length:
            head = ends.pop(0) - at
            if head:
                parts[-1].append((buffer, start, head))
            parts.append([])
            start, length, at = start + head, length - head, at + head
        if length:
            parts[-1].append((buffer, start, length))
            at += length
    return parts + [[] for _ in range(len(ends) - 1)]


def mark(sentinel: bytes) -> Piece:
    return MARKS, SENTINELS.index(sentinel), len(sentinel)


def arrange(form: str, prefix: list[Piece], middle: list[Piece], suffix: list[Piece]) -> list[Piece]:
    if form == "psm":
        return [mark(PREFIX), *prefix, mark(SUFFIX), *suffix, mark(MIDDLE), *middle]
    return [mark(SUFFIX), *suffix, mark(PREFIX), *prefix, mark(MIDDLE), *middle]


def parts_of(data: bytes, pieces: list[Piece]) -> Iterator[memoryview]:
    buffers = memoryview(data), memoryview(SENTINELS)
    for buffer, start, length in pieces:
        yield buffers[buffer][start:start + length]


def render(data: bytes, pieces: list[Piece]) -> bytes:
    return b"".join(parts_of(data, pieces))


def digest(data: bytes, pieces: list[Piece]) -> str:
    """Hash of what the descriptors point at, piece by piece."""
    out = hashlib.sha256()
    for part in parts_of(data, pieces):
        out.update(part)
    return out.hexdigest()


def plan(key: str, data: bytes) -> tuple[int, str, list[Piece], int | None, int | None]:
    """(units, form, descriptors, code points of prefix and of middle) of a text."""
    starts = unit_starts(data)
    n, (h1, h2, h3, h4) = len(starts), hashes(key)
    whole = [(TEXT, 0, len(data))] if data else []
    if not n or h3 % 100 >= RATE or any(x in data for x in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", whole, None, None
    form = "spm" if h4 % 100 < SPM_RATE else "psm"
    a, b = (int(starts[u]) if u < n else len(data) for u in sorted((h1 % (n + 1), h2 % (n + 1))))
    return n, form, arrange(form, *cut(whole, [a, b])), code_points(data, 0, a), code_points(data, a, b - a)


def unplan(form: str | None, data: bytes) -> list[Piece] | None:
    """Descriptors over an output that give the text again; None if it does not fit its form."""
    whole = [(TEXT, 0, len(data))] if data else []
    if form == "plain":
        return whole
    if form not in ("psm", "spm"):
        return None
    order = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
    at = [0]
    for sentinel in order:      # no text holds a sentinel, and two sentinels never overlap
        at.append(data.find(sentinel, at[-1]))
        if at[-1] < 0:
            return None
        at[-1] += len(sentinel)
    if at[1] != len(order[0]):
        return None
    _, first, mark_2, second, mark_3, middle = cut(whole, [at[1], at[2] - len(order[1]), at[2], at[3] - len(order[2]), at[3]])
    prefix, suffix = (first, second) if form == "psm" else (second, first)
    return [*prefix, *middle, *suffix]


def _list_of_pieces(rows: list[list[Piece]]) -> pa.Array:
    flat = np.array([p for row in rows for p in row], np.int64).reshape(-1, 3)
    kinds = pa.int32(), pa.int64(), pa.int64()
    inner = pa.StructArray.from_arrays([pa.array(flat[:, i], kind) for i, kind in enumerate(kinds)], ["buffer", "start", "length"])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), inner)


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, pieces, output, output_sha256) of every row.

    pieces are over buffer 0, the text, and buffer 1, the sentinels."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1)):
            rows = []
            for name, body in zip(batch.column(2).to_pylist(), batch.column(1)):
                data = body.as_buffer().to_pybytes() if body.is_valid else b""
                n, form, pieces, prefix, middle = plan(name or "", data)
                rows.append((n, form, prefix, middle, pieces, render(data, pieces), digest(data, pieces)))
            n, form, prefix, middle, pieces, output, sha = zip(*rows) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), _list_of_pieces(pieces), pa.array(output, pa.binary()).cast(pa.string(), safe=False),
                 pa.array(sha, pa.string())],
                names=["key", "n", "form", "prefix_chars", "middle_chars", "pieces", "output", "output_sha256"])
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(key).cast("string").alias("name"))
    return rows.mapInArrow(run, f"key {kind}, n long, form string, prefix_chars long, middle_chars long, {PIECES}, "
                                "output string, output_sha256 string").withColumnRenamed("key", key)


def restore(rows: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """Adds restored and restored_sha256, rebuilt from an output and its form alone."""
    at, how = rows.columns.index(output), rows.columns.index(form)
    clash = {"restored", "restored_sha256"} & set(rows.columns)
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, at)):
            texts, digests = [], []
            for body, kind in zip(batch.column(at), batch.column(how).to_pylist()):
                data = body.as_buffer().to_pybytes() if body.is_valid else None
                pieces = None if data is None else unplan(kind, data)
                texts.append(None if pieces is None else render(data, pieces))
                digests.append(None if pieces is None else digest(data, pieces))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary()).cast(pa.string(), safe=False), pa.array(digests, pa.string())],
                names=[*batch.schema.names, "restored", "restored_sha256"])
    added = [T.StructField("restored", T.StringType()), T.StructField("restored_sha256", T.StringType())]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *added]))
