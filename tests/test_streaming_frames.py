import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspark.catalog import QUERIES
from reelspark.catalog.streams import samples, updates
from reelspark.operators import frames as P
from reelspark.operators import selection as L
from reelspark.streaming import jobs as J


def run(stream, mode, name, spark):
    q = (stream.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", tempfile.mkdtemp(prefix="spark-", dir="/tmp")).trigger(availableNow=True).start())
    assert q.awaitTermination(90) or q.stop()
    assert q.exception() is None
    return spark.table(name)


def landed(df, files, shuffled=None):
    """Rows as files that arrive in order of seq, or in a random order of rows."""
    path = tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/in"
    rows = df.orderBy("seq").collect()
    if shuffled is not None:
        shuffled.shuffle(rows)
    step = -(-len(rows) // files)
    for i in range(files):
        part = df.sparkSession.createDataFrame(rows[i * step:(i + 1) * step], df.schema)
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def timed(spark, sf):
    """Samples with a time, two of them in each second."""
    return samples(spark, sf).withColumn("ts", F.timestamp_millis(1_700_000_000_000 + F.col("seq") * 500))


@pytest.mark.parametrize("seed", [None, 1])
def test_alert_stream_equals_batch(spark, sf, seed):
    """Rows in any order and any micro-batch; a last sample moves the watermark past all others."""
    s = timed(spark, sf)
    last = spark.createDataFrame([("end", 10**9, 5000.0, True, 1_900_000_000_000)], "device string, seq long, free double, own boolean, ms long")
    path = landed(s, 4, None if seed is None else random.Random(seed))
    last.withColumn("ts", F.timestamp_millis("ms")).select(*s.columns).write.mode("append").parquet(path)
    stream = spark.readStream.schema(s.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = run(J.alert_stream(stream, lateness="10 days", slot_ms=60_000), "append", f"alerts_out_{seed}", spark)
    want = J.alerts(s, ["device"], ["ts", "seq"]).select(*got.columns)
    assert want.count() > 50 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_slots_come_out_with_the_watermark(spark):
    """Alerts of slots that the watermark has passed are out before later samples arrive; open episodes go on."""
    rows = [("d", i, 1000.0 if 3 <= i <= 8 else 2000.0, False, 60_000 * i) for i in range(12)] + [("d", 99, 2000.0, False, 10**9), ("e", None, 1.0, True, 10)]
    s = spark.createDataFrame(rows, "device string, seq long, free double, own boolean, ms long")
    s = s.withColumn("ts", F.timestamp_millis("ms")).drop("ms")
    stream = spark.readStream.schema(s.schema).option("maxFilesPerTrigger", 1).parquet(landed(s.filter("seq is not null"), 5))
    got = run(J.alert_stream(stream, lateness="0 seconds"), "append", "slots_out", spark)
    assert sorted((r.seq, r.alert) for r in got.collect()) == [(3, "warn"), (9, "recovered")]


@pytest.mark.parametrize("seed", [None, 1])
def test_state_stream_equals_batch(spark, sf, seed):
    u = updates(spark, sf)
    path = landed(u, 4, None if seed is None else random.Random(seed))
    stream = spark.readStream.schema(u.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = run(J.state_stream(stream, None), "update", f"states_out_{seed}", spark)
    last = out.groupBy("name").agg(F.max_by(F.struct("seq", "phase", "message", "final", "completed", "total"), "updates").alias("s")).select(
        F.col("name").cast("bigint").alias("name"), "s.*")
    want = J.latest_states(u)
    assert last.exceptAll(want.select(*last.columns)).count() == 0 and want.count() == last.count()


def test_silent_jobs_are_interrupted_once(spark):
    base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    schema = "name string, seq long, phase string, message string, final string, completed long, total long"
    batches = [[("a", 1, "generating", "m", None, 1, 9), ("b", 1, "finished", None, "f", 9, 9)], [("c", 1, "planned", None, None, None, None)],
               [("c", 2, "planned", None, None, None, 4)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(base + "/in")
        stream = J.state_stream(spark.readStream.schema(schema).parquet(base + "/in"), silence_ms=1)
        out = stream.writeStream.foreachBatch(lambda df, _: df.write.mode("append").parquet(base + "/out")).outputMode("update")
        query = out.option("checkpointLocation", base + "/cp").trigger(once=True).start()
        assert query.awaitTermination(60) or query.stop()
    got = spark.read.parquet(base + "/out").filter("phase = 'interrupted'").collect()
    assert [(r.name, r.message, r.completed, r.total) for r in got if r.name == "a"] == [("a", "m", 1, 9)]
    assert "b" not in {r.name for r in got}


def test_windows_stream(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").select(F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    stream = spark.readStream.schema(e.schema).parquet(landed(e, 2))
    got = run(J.usage_windows(stream, ["event_type"], width="6 hours", watermark=J.LATENESS), "append", "usage_out", spark)
    want = J.usage_windows(e, ["event_type"], width="6 hours")
    assert 0 < got.count() <= want.count() and got.exceptAll(want).count() == 0


def test_session_windows_agree_with_islands(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").filter("value > 60")
    from reelspark.views import micros_since_2024
    a = J.spike_sessions(e, ["user_id"]).select("user_id", micros_since_2024("start").alias("start"), "peak", "spikes")
    s = e.select("user_id", micros_since_2024("ts").alias("t"), "value")
    for max_rows in (10 ** 9, 5):
        b = J.spike_session_report(s, ["user_id"], gap=12 * 3_600_000_000, max_rows=max_rows).select(*a.columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_landed_files(spark):
    base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    for part in range(2):
        spark.range(part * 10, part * 10 + 10).selectExpr("concat('line ', id) as value").coalesce(1).write.mode("append").text(base + "/in")
        J.drain(J.follow_landed_text(spark, base + "/in"), base + "/out", base + "/cp").awaitTermination(120)
        assert spark.read.parquet(base + "/out").count() == 10 * (part + 1)


def image(a):
    h, w, c = a.shape
    return (h, w, c, bytearray(a.astype(np.uint8).tobytes()))


@pytest.fixture(scope="module")
def pictures(spark):
    flat = np.full((20, 24, 3), 90)
    steps = np.zeros((20, 24, 3))
    steps[:, 12:] = 200
    noise = np.random.default_rng(1).integers(0, 255, (20, 24, 3))
    colour = np.full((20, 24, 3), 90)
    colour[5:9, 5:9, 0] = 250
    rows = [(n, *image(a)) for n, a in (("flat", flat), ("steps", steps), ("noise", noise), ("colour", colour))]
    return spark.createDataFrame(rows, "name string, height int, width int, nChannels int, data binary")


def test_frame_metrics(pictures):
    m = {r.name: r for r in P.frame_metrics(pictures, ["name"]).collect()}
    assert m["flat"].entropy == 0 and m["flat"].edges == 0 and m["flat"].grain < 1e-9 and m["flat"].corner_deviation == 0
    assert abs(m["flat"].luminance_mean - 90) < 1e-9 and m["flat"].saturation_max == 0
    assert m["noise"].grain > m["steps"].grain and m["noise"].entropy > m["steps"].entropy > 0
    assert m["steps"].edges > 0 and m["steps"].chroma == 0
    assert m["colour"].saturation_max == 160 and m["colour"].chroma > 0


def test_frame_hash_and_reader(spark, pictures):
    import hashlib
    r = P.frame_hash(pictures.filter("name = 'flat'")).first()
    want = hashlib.sha256(b"(20, 24, 3)\0uint8\0" + bytes(r.data)).hexdigest()
    assert r.frame_hash == want


def test_detector_must_be_named(pictures):
    with pytest.raises(ValueError):
        L.detect(pictures, None, "name string")

    def none_found(batches):
        for pdf in batches:
            yield pdf[["name"]].assign(n_faces=0)
    assert L.detect(pictures, none_found, "name string, n_faces bigint").filter("n_faces = 0").count() == 4


def test_every_query_has_rows(spark, sf):
    names = ["plan_units", "entropy_events", "render_prompt", "frame_metrics", "rank_candidates"]
    for n in names:
        assert QUERIES[n](spark, sf).limit(1).count() == 1


def test_blur_is_the_direct_sum():
    """Every pixel is the weighted sum over its neighbourhood, on pictures smaller and larger than the kernel, with planes."""
    import numpy as np

    from reelspark.operators import frames as P
    for shape in ((1, 1), (2, 7), (9, 5), (6, 4, 3)):
        g = np.random.default_rng(3).uniform(0, 255, shape)
        for sigma in (0.9, 1.3):
            k = P.kernel(sigma)
            r = len(k) // 2
            want = np.zeros(shape)
            for y in range(shape[0]):
                for x in range(shape[1]):
                    want[y, x] = sum(k[a + r] * k[b + r] * g[min(max(y + a, 0), shape[0] - 1), min(max(x + b, 0), shape[1] - 1)]
                                     for a in range(-r, r + 1) for b in range(-r, r + 1))
            assert np.allclose(P.blur(g, sigma), want, atol=1e-9)
    planes = np.random.default_rng(4).uniform(0, 255, (12, 9, 3))
    assert np.allclose(P.edge_energy(planes), [P.edge_energy(planes[:, :, i]) for i in range(3)])
