"""Queries over samples of zero and equal times, beside their SQL."""
import datetime
import math
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

from reelspark.catalog import ORACLE, QUERIES
from reelspark.operators import series as R

START = datetime.datetime(2024, 1, 1)


def rows():
    values = {1: [0.0, 5.0, 0.0, 7.0, 0.0, 0.0, 90.0], 2: [40.0, 0.0, 0.0, 60.0, 0.0, 50.0], 3: [0.0, 0.0, 0.0], 4: [3.0, 0.0]}
    for user, vs in values.items():
        for i, v in enumerate(vs):
            yield user * 100 + i, START + datetime.timedelta(hours=i + 1), user, "click", v
    for i, v in enumerate([80.0, 0.0, 70.0, 0.0, 0.0, 75.0]):       # two rows at every time
        yield 500 - i, START + datetime.timedelta(hours=1 + i // 2), 5, "click", v


@pytest.fixture(scope="module")
def folder(spark):
    out = tempfile.mkdtemp(prefix="zeros-", dir="/tmp")
    spark.createDataFrame(list(rows()), "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
                          ).repartition(3).write.mode("overwrite").parquet(f"{out}/events.parquet")
    return out


def plain(row):
    return tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in row)


@pytest.mark.parametrize("name", ["chain_links", "chain_summary", "silences", "speech_coverage"])
def test_zeros_as_in_sql(spark, folder, name):
    got = QUERIES[name](spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE[name]})").fetchall()
    assert want and sorted(map(plain, got.collect()), key=repr) == sorted(map(plain, want), key=repr)


def test_missing_zeros_make_no_jump(spark):
    shots = spark.createDataFrame([("a", 1, 0.0, 4.0, 1.0, 90.0), ("a", 2, 5.0, 0.0, 0.0, 90.0), ("b", 1, 4.0, 5.0, 1.0, 90.0),
                                   ("b", 2, 8.0, 9.0, 2.0, 90.0)],
                                  "k string, i int, edge_first double, edge_last double, entropy_first double, score double")
    got = {r.k: r for r in R.chain_links(shots, ["k"], ["i"]).collect()}
    assert (got["a"].excess_pct, got["a"].edge_jump_pct, got["a"].entropy_jump_pct) == (None, 25.0, None)
    assert (got["b"].excess_pct, got["b"].edge_jump_pct, got["b"].entropy_jump_pct) == (25.0, 60.0, 100.0)


def test_first_silences_are_rounded_as_printed(spark):
    clips = spark.createDataFrame([("a", 10.0)], "k string, duration double")
    gaps = spark.createDataFrame([("a", 0.125, 1.005)], "k string, t0 double, t1 double")
    out = R.coverage(gaps, clips, ["k"]).first()
    assert out.first_silences == "%.2f-%.2f" % (0.125, 1.005) == "0.12-1.00"
