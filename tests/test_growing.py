"""Lines appended to files arrive once."""
import collections
import os
import random
import tempfile

import pytest
from pyarrow import fs

from reelspark.sources import growing
from reelspark.sources.readers import log_tail
from reelspark.streaming import jobs as J


@pytest.fixture()
def base():
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def append(folder, name, data):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "ab") as out:
        out.write(data)


def run(spark, base, **more):
    J.drain(J.follow_text(spark, base + "/in", **more), base + "/out", base + "/cp").awaitTermination(120)
    return collections.Counter((os.path.basename(r.path), r.value) for r in spark.read.parquet(base + "/out").collect())


def test_appended_lines_arrive_once_and_after_restarts(spark, base):
    """Every run is a new query on the same checkpoint, as after a restart."""
    append(base + "/in", "a.log", b"one\ntwo\nthr")
    append(base + "/in", "b.log", b"")
    append(base + "/in", ".hidden", b"no\n")
    want = collections.Counter({("a.log", "one"): 1, ("a.log", "two"): 1})
    assert run(spark, base) == want                                            # the torn line waits
    assert run(spark, base) == want
    append(base + "/in", "a.log", b"ee\r\n\nfive")
    append(base + "/in", "b.log", "ñandú\n\xff\n".encode("latin-1"))
    want.update({("a.log", "three"): 1, ("a.log", ""): 1, ("b.log", "�and�"): 1, ("b.log", "�"): 1})
    assert run(spark, base) == want
    append(base + "/in", "a.log", b"\n")
    want[("a.log", "five")] += 1
    assert run(spark, base) == want
    with open(base + "/in/a.log", "wb") as out:                                # replaced by a shorter file
        out.write(b"new\n")
    os.remove(base + "/in/b.log")
    want[("a.log", "new")] += 1
    assert run(spark, base) == want


def test_one_file_in_many_parts(spark, base):
    rng = random.Random(1)
    lines = ["x" * rng.choice([0, 1, 3, 50, 700]) + str(i) for i in range(3000)]
    append(base + "/in", "big.log", "".join(f"{x}\n" for x in lines).encode())
    assert run(spark, base, part_bytes=1000) == collections.Counter(("big.log", x) for x in lines)
    got = spark.read.parquet(base + "/out").orderBy("position").collect()
    assert [r.value for r in got] == lines


@pytest.mark.parametrize("piece", [1, 2, 7, 1 << 20])
def test_parts_hold_every_line_once(base, monkeypatch, piece):
    monkeypatch.setattr(growing, "_PIECE", piece)
    data = b"a\n\nbcd\nefghijklmno\np\n\n\nqrs\ntorn"
    append(base, "f", data)
    whole = data[:data.rfind(b"\n") + 1]
    places, at = [], 0
    for line in whole.split(b"\n")[:-1]:
        places.append((at, line))
        at += len(line) + 1
    for size in range(1, len(data) + 2):
        reader = growing.GrowingTextReader({"path": base, "partBytes": str(size)})
        end = reader.latestOffset()
        assert list(end.values()) == [len(whole)] and reader.latestOffset() == end
        got = [row for part in reader.partitions({}, end) for row in growing._lines(fs.LocalFileSystem(), part)]
        assert got == places
        for begin, _ in places:
            tail = [row for part in reader.partitions({k: begin for k in end}, end) for row in growing._lines(fs.LocalFileSystem(), part)]
            assert tail == [p for p in places if p[0] >= begin]


def test_followed_logs_give_their_tail(spark, base):
    append(base + "/in", "job.log", b"start\n| 10%\n### x\n  \nlast \n")
    run(spark, base)
    append(base + "/in", "job.log", b"end\n")
    run(spark, base)
    tail = log_tail(spark.read.parquet(base + "/out"), ["path"], ["position"], 2, "value")
    assert [r.value for r in tail.orderBy("rank").collect()] == ["end", "last"]


def test_followed_states(spark, base):
    append(base + "/in", "s.jsonl", b'{"name": "a", "phase": "planned", "seq": 1}\nnot json\n\n{"name": "b", "phase": "gen')
    schema = "name string, seq bigint, phase string"
    for more in (b'erating", "seq": 2}\n', b""):
        J.drain(J.follow_states(spark, base + "/in", schema), base + "/out", base + "/cp").awaitTermination(120)
        append(base + "/in", "s.jsonl", more)
    got = {(r.name, r.seq, r.phase, r.problem) for r in spark.read.parquet(base + "/out").collect()}
    assert got == {("a", 1, "planned", None), (None, None, None, "not json"), ("b", 2, "generating", None)}
