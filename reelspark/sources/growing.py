"""A streaming source for text files that grow.

Spark's own file source takes a file once and never looks at it again.  This source keeps a byte offset
per file: a micro-batch is, for every file, the bytes between two offsets, and Spark's checkpoint holds
the offsets, so every line arrives once, after a restart too.

    spark.dataSource.register(GrowingText)
    lines = spark.readStream.format("growing_text").option("path", "/shared/logs").load()

* An offset only ever stands behind a line break: a torn last line waits until it is complete.
* New bytes of a file are cut into parts of `partBytes`; a line belongs to the part where it starts, so one
  file is read by many tasks and a part is read in pieces, never as a whole.
* A file that has become shorter was replaced, and is read from its start.  Files may come and go; of a file that is
  gone nothing more is read.
* Lines end at `\\n`; a `\\r` before it goes.  Bytes that are no UTF-8 become replacement characters.

`path` is a folder (with `recursive`, the folders below too) that the driver and all executors reach, local or
any store that pyarrow opens by URI; `suffix` chooses files by the end of their names.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

PART_BYTES = 32 << 20
_PIECE = 1 << 20
#: Rows of one Arrow batch at most.
_ROWS = 10_000


def _store(path: str):
    from pyarrow import fs
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


@dataclass
class Part(InputPartition):
    """Lines of a file that start in [begin, end); `first` if the first of them starts at begin for sure."""
    path: str
    begin: int
    end: int
    stop: int
    first: bool


class GrowingText(DataSource):
    @classmethod
    def name(cls) -> str:
        return "growing_text"

    def schema(self) -> str:
        return "path string, position bigint, value string"

    def streamReader(self, schema) -> "GrowingTextReader":
        return GrowingTextReader(self.options)


class GrowingTextReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.suffix = options.get("suffix", "")
        self.recursive = options.get("recursive", "false").lower() == "true"
        self.part_bytes = int(options.get("partBytes", PART_BYTES))
        self.known: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Of every file the place behind its last line break."""
        from pyarrow import fs
        store, root = _store(self.path)
        found = {}
        for info in store.get_file_info(fs.FileSelector(root, recursive=self.recursive, allow_not_found=True)):
            hidden = info.base_name.startswith((".", "_"))
            if info.type == fs.FileType.File and not hidden and info.base_name.endswith(self.suffix) and info.size:
                end = self._last_break(store, info.path, info.size)
                if end:
                    found[info.path] = end
        self.known = found
        return found

    def _last_break(self, store, path: str, size: int) -> int:
        """Searched backwards; what was known to end a line before need not be searched again."""
        known = self.known.get(path, 0)
        known = known if known <= size else 0
        end = size
        with store.open_input_file(path) as file:
            while end > known:
                begin = max(known, end - _PIECE)
                file.seek(begin)
                at = file.read(end - begin).rfind(b"\n")
                if at >= 0:
                    return begin + at + 1
                end = begin
        return known

    def partitions(self, start: dict, end: dict) -> list[Part]:
        parts = []
        for path, stop in sorted(end.items()):
            begin = start.get(path, 0)
            if begin > stop:        # replaced by a shorter file
                begin = 0
            for low in range(begin, stop, self.part_bytes):
                parts.append(Part(path, low, min(low + self.part_bytes, stop), stop, low == begin))
        return parts

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.path)
        rows: list[tuple[int, bytes]] = []
        for row in _lines(store, partition):
            rows.append(row)
            if len(rows) == _ROWS:
                yield _batch(partition.path, rows)
                rows = []
        if rows:
            yield _batch(partition.path, rows)


def _lines(store, part: Part) -> Iterator[tuple[int, bytes]]:
    """(place, line) of the lines that start in the part."""
    with store.open_input_file(part.path) as file:
        at = part.begin
        if not part.first:          # the line that began before belongs to the part before
            at -= 1
        file.seek(at)
        held, skip = [], not part.first
        place = at
        while at < part.stop:
            piece = file.read(min(_PIECE, part.stop - at))
            if not piece:           # the file was cut while it was read
                return
            begin = 0
            while (stop := piece.find(b"\n", begin)) >= 0:
                held.append(piece[begin:stop])
                if skip:
                    skip = False
                else:
                    yield place, b"".join(held)
                held, begin = [], stop + 1
                place = at + begin
                if place >= part.end:
                    return
            held.append(piece[begin:])
            at += len(piece)


def _batch(path: str, rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    text = [line.removesuffix(b"\r").decode("utf-8", "replace") for _, line in rows]
    return pa.RecordBatch.from_arrays(
        [pa.array([path] * len(rows), pa.string()), pa.array([place for place, _ in rows], pa.int64()), pa.array(text, pa.string())],
        names=["path", "position", "value"])
