"""Capacity models from measured probes, memory telemetry and repeated attempts."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K


def best_so_far(attempts: DataFrame, keys: list[str], order: str, score: str, goal: float) -> DataFrame:
    """Attempts made until the first one that reaches the goal, and the best of them.

    The running best reaches the goal at the first attempt whose own score does, so the
    stop is one aggregate and no ordered window is needed.
    """
    s, o = F.col(score), F.col(order)
    stops = attempts.groupBy(*keys).agg(F.min(F.when(s >= goal, o)).alias("goal_attempt"))
    made = attempts.join(stops, keys).filter(F.col("goal_attempt").isNull() | (o <= F.col("goal_attempt")))
    # only a strictly better score replaces the best: the earliest of equals wins
    return made.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("attempts"), F.max(s).alias("best"),
        F.max_by(o, F.struct(s, -o)).alias("best_attempt"), F.max("goal_attempt").alias("goal_attempt"))


def peak_usage(telemetry: DataFrame, keys: list[str], device: str, free: str, total: float) -> DataFrame:
    """Own peak = total − smallest free − what others already used at the start (first sample)."""
    first = F.min_by(F.col(free), F.col("sample_idx"))
    return telemetry.groupBy(*keys, device).agg(
        (total - F.min(free) - (total - first)).alias("own_peak"),
        (total - F.min(free)).alias("device_peak"), F.count(F.lit(1)).alias("samples"))


def fit_capacity(probes: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Least-squares line of memory over frames, per configuration."""
    return probes.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"), F.count(F.lit(1)).alias("n"))


def frontier(probes: DataFrame, keys: list[str], x: str = "frames", fits: str = "fits") -> DataFrame:
    """Largest fitting and smallest failing value of each configuration."""
    ok = F.col(fits)
    return probes.groupBy(*keys).agg(F.max(F.when(ok, F.col(x))).alias("largest_fit"),
                                     F.min(F.when(~ok, F.col(x))).alias("smallest_fail"),
                                     F.count_if(ok).alias("n_fit"), F.count_if(~ok).alias("n_fail"))


def probe_cutoff(probes: DataFrame, keys: list[str], x: str = "frames", fits: str = "fits") -> DataFrame:
    """Rows a probe run records: up to and including the first failure."""
    fails = probes.groupBy(*keys).agg(F.min(F.when(~F.col(fits), F.col(x))).alias("_stop"))
    return probes.join(fails, keys).filter(F.col("_stop").isNull() | (F.col(x) <= F.col("_stop"))).drop("_stop")


def classify_failures(df: DataFrame, code: str, log: str) -> DataFrame:
    """Whether a failed run may be retried with less memory, and what ran out."""
    text = F.lower(F.coalesce(F.col(log), F.lit("")))
    reason = (F.when(text.rlike(K.RAM_PATTERN), "ram").when(text.rlike(K.VRAM_PATTERN), "vram").otherwise("otro"))
    return (df.withColumn("recoverable", (F.col(code) == K.OOM_EXIT_CODE) | text.rlike(K.RECOVERABLE_PATTERN))
            .withColumn("reason", F.when(F.col(code) != 0, reason)))
