"""Files of any length, and what readers leave out."""
import os
import random
import tempfile

import numpy as np
import pytest

from reelspark.sources import readers as R


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def put(folder, name, data):
    with open(os.path.join(folder, name), "wb") as out:
        out.write(data if isinstance(data, bytes) else data.encode())


@pytest.fixture()
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def test_one_log_in_many_tasks(spark, folder, small_splits):
    rng = random.Random(2)
    logs = {}
    for name in ("a", "b"):
        logs[name] = [rng.choice(["", "  ", f"0, {i};1, {i + 1}; RSS_KB={i}", "noise", f"0, {i}" + " " * rng.randint(0, 90)]) for i in range(1500)]
        put(folder, f"{name}.csv", "\r\n".join(logs[name]) + ("\r\n" if name == "a" else ""))
    put(folder, "empty.csv", "")
    lines = R.numbered_lines(spark, folder)
    assert spark.read.text(folder).rdd.getNumPartitions() > 20
    got = sorted((R_.path.split("/")[-1][0], R_.line_no, R_.line) for R_ in lines.collect())
    assert got == [(n, i, x) for n in ("a", "b") for i, x in enumerate(logs[n], 1)]
    whole = spark.createDataFrame([(n, "\r\n".join(x)) for n, x in logs.items()], "run string, raw string")
    want, seen = R.parse_telemetry(whole, ["run"]), R.read_telemetry(spark, folder).selectExpr("run", "int(sample_idx) sample_idx", "device", "mib", "rss_kb")
    assert want.count() > 1000 and want.exceptAll(seen).count() == 0 and seen.exceptAll(want).count() == 0


def test_probe_lines_in_are_rows_and_issues_out(spark, folder):
    put(folder, "p.tsv", "w\th\tf\ts\tfits\tmib\tsec\treason\n1\t2\t3\t4.0\tsi\t5\t6\t\nx\t2\t3\t4.0\tsi\t5\t6\tr\n1\t2\n1\t2\t3\t4.0\tno\t5\t6\tvram\n")
    rows, issues = R.read_probes(spark, folder).collect(), R.probe_issues(spark, folder).collect()
    assert [(r.frames, r.fits, r.reason) for r in rows] == [(3, True, None), (3, False, "vram")]
    assert sorted(r.raw for r in issues) == ["1\t2", "x\t2\t3\t4.0\tsi\t5\t6\tr"] and all(r.path.endswith("p.tsv") for r in issues)


def test_states_in_are_rows_and_issues_out(spark):
    good = '{"phase": "planned", "name": "n", "completed": 3}'
    texts = {"ok": good, "large": good[:-1] + ', "message": "' + "x" * R.STATE_BYTES + '"}', "list": "[1]", "torn": good[:-4], "none": None,
             "count": good.replace("3", '"3"'), "nameless": '{"phase": "planned"}'}
    df = spark.createDataFrame(list(texts.items()), "path string, raw string")
    assert [r.path for r in R.parse_states(df).collect()] == ["ok"]
    assert {r.path: r.issue for r in R.state_issues(df).collect()} == {
        "large": "too large", "list": "no JSON object", "torn": "no JSON object", "none": "no text", "count": "field completed", "nameless": "field name"}


def test_pictures_in_are_rows_and_issues_out(spark, folder):
    from struct import pack
    from zlib import compress, crc32
    chunk = lambda kind, data: pack(">I", len(data)) + kind + data + pack(">I", crc32(kind + data))
    pixels = np.zeros((2, 3, 3), np.uint8)
    raw = b"".join(b"\0" + row.tobytes() for row in pixels)
    put(folder, "a.png", b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", pack(">IIBBBBB", 3, 2, 8, 2, 0, 0, 0)) + chunk(b"IDAT", compress(raw)) + chunk(b"IEND", b""))
    put(folder, "b.png", b"no picture")
    rows, issues = R.read_frames(spark, folder).collect(), R.frame_issues(spark, folder).collect()
    assert [(r.width, r.height) for r in rows] == [(3, 2)] and [r.path.split("/")[-1] for r in issues] == ["b.png"]
