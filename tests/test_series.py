"""Levels and thresholds against plain Python."""
import math
import statistics

from pyspark.sql import functions as F

from reelspark.operators import series as R


def test_spike_threshold_is_one_pass(spark):
    values = {"a": [1e6 + x % 7 for x in range(50)] + [1e6 + 90], "b": [3.0], "c": [5.0, 5.0, 80.0]}
    rows = [(k, float(i), v) for k, vs in values.items() for i, v in enumerate(vs)] + [("d", 0.0, None), ("c", 9.0, None)]
    df = spark.createDataFrame(rows, "k string, t double, v double")
    got = {r.k: r for r in R.spike_threshold(df, ["k"]).collect()}
    assert set(got) == {"a", "b", "c"}                                    # a clip without values has no threshold
    for k, vs in values.items():
        r, deviation = got[k], statistics.pstdev(vs)
        assert (r.n, r.median, r.peak) == (len(vs), sorted(vs)[len(vs) // 2], max(vs))
        assert math.isclose(r.deviation, deviation, abs_tol=1e-6) and math.isclose(r.mean_square, sum(x * x for x in vs) / len(vs))
        assert math.isclose(r.threshold, r.median + max(4 * deviation, 10), abs_tol=1e-5)


def test_silence_levels_and_coverage(spark):
    df = spark.createDataFrame([("a", 0.0, 0.5), ("a", 4.0, 0.25), ("b", 1.0, None), ("b", 3.0, None)], "k string, t double, v double")
    got = {r.k: (r.duration, r.threshold_db) for r in R.silence_levels(df, ["k"]).collect()}
    assert got == {"a": (4.0, round(20 * math.log10(math.sqrt((0.25 + 0.0625) / 2)) - 22, 1)), "b": (3.0, -40.0)}
    clips = spark.createDataFrame([("a", 100.0), ("b", 50.0)], "k string, duration double")
    gaps = spark.createDataFrame([("a", float(i * 5), float(i * 5 + 1 + i % 3)) for i in range(15)], "k string, t0 double, t1 double")
    for most in (10 ** 9, 4):
        out = {r.k: r for r in R.coverage(gaps, clips, ["k"], first=3, max_rows=most).collect()}
        assert out["a"].n_silences == 15 and out["a"].silent == 30 and out["a"].longest == 3
        assert out["a"].first_silences == "0.00-1.00 5.00-7.00 10.00-13.00" and out["b"].first_silences == "" and out["b"].coverage == 100
