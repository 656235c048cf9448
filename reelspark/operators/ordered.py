"""Ordered work inside groups that stays parallel when one group is huge.

A window partitioned by a key puts each key into one task.  That is the right plan
until one key holds a large share of the table.  `OrderedGroups` looks at the group
sizes once (a map-side combined count), and only for groups above `max_rows` finds
split points in the ordering columns.  A hot group then becomes several chunks that
are consecutive in the order; windows run per chunk, and one small summary row per
chunk carries counts, sums and edge values across the chunk borders.  Results are the
same with and without splitting.

The split points are plain values held by the plan, so a lost executor recomputes the
same chunks.  Wherever the split points fall, results stay exact; they only steer how
even the chunks are.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_ROWS = 4_000_000
MAX_SPLITS = 200_000
_SAMPLES_PER_CHUNK = 8
_FINE = 64


class OrderedGroups:
    def __init__(self, keys: list[str], order: list[str], splits: DataFrame | None):
        self.keys, self.order, self.splits = keys, order, splits

    # -- planning ---------------------------------------------------------------
    @classmethod
    def plan(cls, df: DataFrame, keys: list[str], order: list[str],
             max_rows: int | None = None) -> "OrderedGroups":
        """Measure group sizes and choose split points for the hot groups."""
        if max_rows is None:
            max_rows = int(df.sparkSession.conf.get("reelspark.ordered.maxRows", str(MAX_ROWS)))
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows)
        hot = sizes.limit(MAX_SPLITS).collect()     # at most rows / max_rows keys
        if not hot:
            return cls(keys, order, None)
        total = sum(r["_n"] for r in hot)
        if total / max_rows > MAX_SPLITS:           # keep the split table small: larger chunks
            max_rows = total // MAX_SPLITS + 1
        spark = df.sparkSession
        key_schema = T.StructType([df.schema[k] for k in keys])
        hot_keys = spark.createDataFrame([tuple(r[k] for k in keys) for r in hot], key_schema)
        fraction = min(1.0, _SAMPLES_PER_CHUNK / max_rows)
        rows = df.select(*keys, *order)
        sample = _null_safe_join(rows, F.broadcast(hot_keys), keys, "left_semi").sample(fraction, seed=17)
        points = (sample.groupBy(*keys)
                  .agg(F.array_sort(F.collect_list(F.struct(*order))).alias("_s"))
                  .select(*keys, F.expr(
                      f"filter(_s, (x, i) -> i % {_SAMPLES_PER_CHUNK} = {_SAMPLES_PER_CHUNK - 1})").alias("_splits"))
                  .filter(F.size("_splits") > 0))
        found = points.collect()
        if not found:
            return cls(keys, order, None)
        return cls(keys, order, spark.createDataFrame(found, points.schema))

    @property
    def is_split(self) -> bool:
        return self.splits is not None

    # -- chunk column ------------------------------------------------------------
    def tag(self, df: DataFrame) -> DataFrame:
        """Add `_chunk` and `_hot`; a no-op while nothing is hot."""
        if not self.is_split:
            return df
        here = F.struct(*self.order)
        df = _null_safe_join(df, F.broadcast(self.splits), self.keys, "left")
        coarse = F.expr(f"filter(_splits, (x, i) -> i % {_FINE} = {_FINE - 1})")
        block = F.size(F.filter(coarse, lambda s: s < here))
        fine = F.size(F.filter(F.slice("_splits", block * _FINE + 1, _FINE), lambda s: s < here))
        chunk = F.when(F.col("_splits").isNull(), F.lit(0)).otherwise(block * _FINE + fine)
        return (df.withColumn("_chunk", chunk.cast("int"))
                .withColumn("_hot", F.col("_splits").isNotNull()).drop("_splits"))

    def untag(self, df: DataFrame) -> DataFrame:
        return df.drop("_chunk", "_hot") if self.is_split else df

    # -- ordered columns ------------------------------------------------------------
    def add(self, df: DataFrame, row_number: str | None = None,
            running: dict[str, Column] | None = None, total: dict[str, Column] | None = None,
            lag: dict[str, str] | None = None, lead: dict[str, str] | None = None) -> DataFrame:
        """Add ordered columns to a tagged frame.

        running: inclusive sums in order; total: group sums; lag/lead: neighbour values by
        column name.  Everything shares one window, so it costs one exchange and one sort.
        """
        running, total, lag, lead = running or {}, total or {}, lag or {}, lead or {}
        if not self.is_split:
            ordered = Window.partitionBy(*self.keys).orderBy(*self.order)
            upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            return df.select(
                "*",
                *([F.row_number().over(ordered).cast("bigint").alias(row_number)] if row_number else []),
                *[F.sum(c).over(upto).alias(n) for n, c in running.items()],
                *[F.sum(c).over(whole).alias(n) for n, c in total.items()],
                *[F.lag(c).over(ordered).alias(n) for n, c in lag.items()],
                *[F.lead(c).over(ordered).alias(n) for n, c in lead.items()])
        return self._add_split(df, row_number, running, total, lag, lead)

    def _add_split(self, df, row_number, running, total, lag, lead):
        by = [*self.keys, "_chunk"]
        ordered = Window.partitionBy(*by).orderBy(*self.order)
        upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        local = df.select(
            "*", F.row_number().over(ordered).cast("bigint").alias("_og_rn"),
            F.lead(F.lit(1)).over(ordered).isNull().alias("_og_last"),
            *[F.sum(c).over(upto).alias(f"_og_r_{n}") for n, c in running.items()],
            *[F.sum(c).over(whole).alias(f"_og_t_{n}") for n, c in total.items()],
            *[F.lag(c).over(ordered).alias(f"_og_p_{n}") for n, c in lag.items()],
            *[F.lead(c).over(ordered).alias(f"_og_n_{n}") for n, c in lead.items()])

        edge = F.struct(*self.order)
        prev_vals = F.struct(F.lit(1).alias("_"), *[F.col(c).alias(n) for n, c in lag.items()])
        next_vals = F.struct(F.lit(1).alias("_"), *[F.col(c).alias(n) for n, c in lead.items()])
        chunks = (df.filter("_hot").groupBy(*by).agg(
            F.count(F.lit(1)).alias("_og_cnt"),
            *[F.sum(c).alias(f"_og_cr_{n}") for n, c in running.items()],
            *[F.sum(c).alias(f"_og_ct_{n}") for n, c in total.items()],
            F.max_by(prev_vals, edge).alias("_og_tail"), F.min_by(next_vals, edge).alias("_og_head")))
        # one row per chunk of a hot key: a few thousand rows per key at most
        across = Window.partitionBy(*self.keys).orderBy("_chunk")
        before = across.rowsBetween(Window.unboundedPreceding, -1)
        everything = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        carry = chunks.select(
            *by, F.coalesce(F.sum("_og_cnt").over(before), F.lit(0)).alias("_og_before"),
            *[F.sum(f"_og_cr_{n}").over(before).alias(f"_og_b_{n}") for n in running],
            *[F.sum(f"_og_ct_{n}").over(everything).alias(f"_og_g_{n}") for n in total],
            F.lag("_og_tail").over(across).alias("_og_tail"), F.lead("_og_head").over(across).alias("_og_head"))
        joined = _null_safe_join(local, carry, by, "left")

        def carried(local_name, carry_name):
            plain, extra = F.col(local_name), F.col(carry_name)
            return F.when(extra.isNull(), plain).when(plain.isNull(), extra).otherwise(plain + extra)

        out = [c for c in df.columns]
        cols = [F.col(c) for c in out]
        if row_number:
            cols.append((F.col("_og_rn") + F.coalesce(F.col("_og_before"), F.lit(0))).alias(row_number))
        cols += [carried(f"_og_r_{n}", f"_og_b_{n}").alias(n) for n in running]
        cols += [F.when(F.col("_hot"), F.col(f"_og_g_{n}")).otherwise(F.col(f"_og_t_{n}")).alias(n) for n in total]
        cols += [F.when(F.col("_hot") & (F.col("_og_rn") == 1), F.col(f"_og_tail.{n}"))
                 .otherwise(F.col(f"_og_p_{n}")).alias(n) for n in lag]
        cols += [F.when(F.col("_hot") & F.col("_og_last"), F.col(f"_og_head.{n}"))
                 .otherwise(F.col(f"_og_n_{n}")).alias(n) for n in lead]
        return joined.select(*cols)


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi join that also matches null keys, keeping the left key columns."""
    renamed = right.select([F.col(c).alias(f"_k_{c}" if c in keys else c) for c in right.columns])
    cond = None
    for k in keys:
        test = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        cond = test if cond is None else cond & test
    out = left.join(renamed, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_k_{k}" for k in keys])


def ordered(df: DataFrame, keys: list[str], order: list[str], max_rows: int | None = None,
            **columns) -> DataFrame:
    """Plan, tag, add and untag in one call."""
    groups = OrderedGroups.plan(df, keys, order, max_rows)
    return groups.untag(groups.add(groups.tag(df), **columns))


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str = "idx",
             max_rows: int | None = None) -> DataFrame:
    """1-based position inside each group."""
    return ordered(df, keys, order, max_rows, row_number=name)


def value_ranks(df: DataFrame, keys: list[str], value: str, max_rows: int | None = None, **total: Column) -> DataFrame:
    """Distinct values per group with counts (`c`), cumulative counts (`cum`) and totals (`n`).

    Equal values are combined before the shuffle; exact order statistics follow by filter.
    total: further group sums over values and counts, beside every value.
    """
    hist = (df.filter(F.col(value).isNotNull()).groupBy(*keys, value)
            .agg(F.count(F.lit(1)).alias("c")))
    return ordered(hist, keys, [value], max_rows,
                   running={"cum": F.col("c")}, total={"n": F.col("c"), **total})


def medians(df: DataFrame, keys: list[str], value: str, max_rows: int | None = None) -> DataFrame:
    """Exact lower and upper medians per group: `median_low`, `median_high`, with `n`."""
    ranks = value_ranks(df, keys, value, max_rows)
    low, high = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1
    return ranks.groupBy(*keys).agg(
        F.max("n").alias("n"),
        F.min(F.when(F.col("cum") >= low, F.col(value))).alias("median_low"),
        F.min(F.when(F.col("cum") >= high, F.col(value))).alias("median_high"))


def top_per_group(df: DataFrame, keys: list[str], order: list, n: int, name: str = "rank") -> DataFrame:
    """First `n` rows per group.

    The rank filter is pushed below the shuffle (partial group limits), so a hot key sends
    at most `n` rows per input task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
