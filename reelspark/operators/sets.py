"""Set operations on rows and arrays."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K


def overlap(a: Column, b: Column) -> Column:
    """Shared elements over the smaller set; 0 when either is empty."""
    small = F.least(F.size(a), F.size(b))
    return F.when(small > 0, F.size(F.array_intersect(a, b)) / small).otherwise(F.lit(0.0))


def union_shots(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Both shot families as one, each name once."""
    return a.unionByName(b).dropDuplicates(keys)


def untried(candidates: DataFrame, tried: DataFrame, keys: list[str]) -> DataFrame:
    return candidates.join(tried.select(*keys), keys, "left_anti")


def missing_headers(headers: DataFrame, script: str = "script_id", key: str = "key",
                    value: str = "value", required=K.REQUIRED_HEADERS, scripts: DataFrame | None = None) -> DataFrame:
    """Required headers that a script does not define with a value.

    The present headers are folded into one flag per required name, so a script with very
    many lines still sends one row per task.  `scripts` lists all scripts; without it a script
    that has no header line at all is not known here.
    """
    if scripts is not None:
        none = scripts.select(script, F.lit(None).cast("string").alias(key), F.lit("").alias(value))
        headers = headers.select(script, key, value).unionByName(none)
    flags = headers.groupBy(script).agg(*[
        F.max(((F.col(key) == name) & (F.trim(value) != "")).cast("int")).alias(name) for name in required])
    absent = F.filter(F.array(*[F.when(F.coalesce(F.col(n), F.lit(0)) == 0, F.lit(n)) for n in required]),
                      lambda x: x.isNotNull())
    return flags.select(script, F.explode(absent).alias("missing"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
