"""Measures of links beside a rounding tie, beside their SQL."""
import datetime
import tempfile

import duckdb
import pytest

from reelspark.catalog import ORACLE, QUERIES


@pytest.mark.parametrize("name", ["chain_links", "chain_summary"])
def test_ties_are_rounded_as_in_sql(spark, name):
    shots = {1: [(40_000, 32.0), (40_041, 8.99), (40_105, 29.76)], 2: [(80_000, 32.0), (80_013, 228.91), (80_059, 45.42)],
             3: [(90_000, 32.0), (90_039, 8.13), (90_047, 15.53)]}
    folder = tempfile.mkdtemp(prefix="ties-", dir="/tmp")
    spark.createDataFrame([(i, datetime.datetime(2024, 1, 1), user, "click", v) for user, own in shots.items() for i, v in own],
                          "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
                          ).write.mode("overwrite").parquet(f"{folder}/events.parquet")
    got = QUERIES[name](spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
