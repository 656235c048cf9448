"""Split groups give the same answers as plain windows."""
import pytest

from pyspark.sql import functions as F

from reelspark.operators import series as R
from reelspark.operators import timeline as T
from reelspark.operators.ordered import OrderedGroups, medians, numbered, ordered
from reelspark.views import series



@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows; values tie, some are null, one key is null."""
    big = spark.range(4000).select(F.lit("hot").alias("k"), (F.col("id") * 7919 % 4000).alias("t"), (F.col("id") % 50).cast("double").alias("v"))
    rest = spark.range(300).select((F.col("id") % 17).cast("string").alias("k"), F.col("id").alias("t"),
                                   F.when(F.col("id") % 9 != 0, F.col("id") % 11).cast("double").alias("v"))
    none = spark.range(30).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("t"), F.lit(1.0).alias("v"))
    return big.unionByName(rest).unionByName(none).cache()


def add(df, max_rows):
    return ordered(df, ["k"], ["t"], max_rows, row_number="rn", running={"cum": F.coalesce("v", F.lit(0.0))},
                   total={"n": F.lit(1)}, lag={"p": "v"}, lead={"x": "v"})


@pytest.mark.parametrize("max_rows", [10, 100, 1500])
def test_split_equals_plain(skewed, max_rows):
    plain, split = add(skewed, 10 ** 9), add(skewed, max_rows)
    assert plain.columns == split.columns
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


def test_hot_group_becomes_bounded_chunks(skewed):
    groups = OrderedGroups.plan(skewed, ["k"], ["t"], 200)
    assert groups.is_split
    sizes = groups.tag(skewed).groupBy("k", "_chunk").count().agg(F.max("count")).first()[0]
    assert sizes < 1200          # about 200 a chunk; sampled split points wander
    assert not OrderedGroups.plan(skewed, ["k"], ["t"], 10 ** 6).is_split


def test_plain_plan_has_one_exchange(skewed):
    plan = add(skewed, 10 ** 9)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("max_rows", [20, 10 ** 9])
def test_medians(skewed, max_rows):
    got = {r.k: (r.n, r.median_low, r.median_high) for r in medians(skewed, ["k"], "v", max_rows).collect()}
    vals = {}
    for r in skewed.collect():
        if r.v is not None:
            vals.setdefault(r.k, []).append(r.v)
    want = {k: (len(v), sorted(v)[(len(v) + 1) // 2 - 1], sorted(v)[len(v) // 2]) for k, v in vals.items()}
    assert got == want


@pytest.mark.parametrize("op", [
    lambda s, m: R.spot_report(s, ["clip_id"], 12.0, m),
    lambda s, m: R.drift_report(s.withColumn("e", F.col("v") * 2), ["clip_id"], ["t"], "v", "e", m),
    lambda s, m: R.silences(s.withColumn("level_db", F.col("v")).withColumn("threshold_db", F.lit(20.0)), ["clip_id"], max_rows=m),
    lambda s, m: T.transition_plan(s.withColumn("duration", F.rint("v")), ["clip_id"], ["t"], "fundido", 0.5, max_rows=m),
    lambda s, m: T.fades(s, ["clip_id"], ["t"], m),
    lambda s, m: T.alternate(s, ["clip_id"], ["t"], 1.15, m),
])
def test_operators_do_not_change_when_split(spark, sf, op):
    s = series(spark, sf)
    a, b = op(s, 10 ** 9), op(s, 15)
    num = lambda df: df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
    assert num(a).exceptAll(num(b)).count() == 0 and num(b).exceptAll(num(a)).count() == 0


def test_numbering_is_stable_under_repartition(skewed):
    a = numbered(skewed, ["k"], ["t"])
    b = numbered(skewed.repartition(11), ["k"], ["t"])
    assert a.exceptAll(b).count() == 0
