"""Joins between plans, artifacts, takes, devices and states.

Every join here is an equi join.  A key that holds a large share of one side is left to
adaptive execution, which splits the skewed partition; the other side has one row per key.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import medians


def resolve_anchors(takes: DataFrame, keys: list[str], idx: str = "idx", anchor: str = "anchor_source",
                    bring: tuple[str, ...] = ()) -> DataFrame:
    """Each take with the take it is anchored to; `anchor_issue` tells a bad reference."""
    source = takes.select(*keys, F.col(idx).alias("_a"), *[F.col(c).alias(f"anchor_{c}") for c in bring],
                          F.lit(True).alias("_found"))
    out = (takes.withColumn("_a", F.col(anchor)).join(source, [*keys, "_a"], "left"))
    issue = (F.when(F.col(anchor).isNull(), F.lit(None)).when(F.col(anchor) < 1, "no_such_take")
             .when(F.col(anchor) >= F.col(idx), "points_forward").when(F.col("_found").isNull(), "no_such_take"))
    return out.withColumn("anchor_issue", issue).drop("_a", "_found")


def level_gains(levels: DataFrame, takes: DataFrame, keys: list[str], idx: str = "idx", value: str = "level",
                max_rows: int | None = None) -> DataFrame:
    """Gain that brings each take to the level of the first one.

    levels: one row per measured frame; takes: anchor_source, own_scene.  The gain is clamped
    to [0.5, 2] and is 1 where a level cannot be measured.  It is applied only to anchored takes
    without an own scene and only outside ±2 %.
    """
    mids = medians(levels, [*keys, idx], value, max_rows).select(*keys, idx, F.col("median_low").alias("level"))
    ref = mids.filter(F.col(idx) == 1).select(*keys, F.col("level").alias("reference"))
    both = takes.join(mids, [*keys, idx], "left").join(ref, keys, "left")
    usable = (F.coalesce("level", F.lit(0.0)) != 0) & (F.coalesce("reference", F.lit(0.0)) != 0)
    raw = F.greatest(F.lit(0.5), F.least(F.lit(2.0), F.col("reference") / F.col("level")))
    gain = F.when(usable, F.rint(raw * 10000) / 10000).otherwise(F.lit(1.0))
    own = F.col("own_scene") | F.col("anchor_source").isNull()
    action = (F.when(F.col(idx) == 1, "reference").when(own, "own_image")
              .when((gain < 0.98) | (gain > 1.02), "level").otherwise("keep"))
    return both.select(*keys, idx, "level", gain.alias("gain"), action.alias("action"))


def reconcile(plan: DataFrame, artifacts: DataFrame, keys: list[str]) -> DataFrame:
    """What to do with each planned or existing take.

    plan: fingerprint.  artifacts: has_artifact, recorded (null without a manifest),
    bytes_match, valid.
    """
    both = plan.select(*keys, "fingerprint").withColumn("_p", F.lit(True)).join(
        artifacts.select(*keys, "has_artifact", "recorded", "bytes_match", "valid").withColumn("_a", F.lit(True)),
        keys, "full")
    there = F.coalesce("has_artifact", F.lit(False))
    match = F.coalesce((F.col("recorded") == F.col("fingerprint")) & F.col("bytes_match"), F.lit(False))
    decision = (F.when(F.col("_p").isNull(), "not_planned")
                .when(there & match & F.col("valid"), "reuse").when(there & match, "invalid")
                .when(there & F.col("recorded").isNull() & F.col("valid"), "legacy")
                .when(there, "changed").when(F.col("recorded").isNotNull(), "orphan_fingerprint").otherwise("missing"))
    return both.select(*keys, decision.alias("decision"))


def incompatible_clips(clips: DataFrame, keys: list[str], order: str, video: list[str], audio: list[str]) -> DataFrame:
    """Clips whose stream signature differs from the first clip of their montage, and on which side.

    The first clip comes from a map-side combined aggregate and not from a window, so a montage
    of any size stays spread over tasks.
    """
    first = clips.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in (order, *video, *audio)]), order).alias("_f"))
    both = clips.join(first, keys)

    def differs(cols):
        test = F.lit(False)
        for c in cols:
            test = test | ~F.col(c).eqNullSafe(F.col(f"_f.{c}"))
        return test

    sides = F.concat_ws(" y ", F.when(differs(video), "video"), F.when(differs(audio), "audio"))
    return both.select(*keys, F.col(f"_f.{order}").alias("reference"), order, sides.alias("differs")).filter("differs <> ''")


def owned(busy: DataFrame, own: DataFrame, key: str) -> DataFrame:
    """Busy processes that are ours."""
    return busy.join(own.select(key), key, "left_semi")


def foreign(busy: DataFrame, own: DataFrame, key: str) -> DataFrame:
    return busy.join(own.select(key), key, "left_anti")


def merge_status(tasks: DataFrame, states: DataFrame, key: str) -> DataFrame:
    """Live tasks first, completed from the durable state; states without a task are kept.

    tasks: alive, rc.  states: phase, completed, total, message, updated.
    """
    both = tasks.withColumn("_t", F.lit(True)).join(states, key, "full")
    launch = F.when(F.col("alive"), "launching").otherwise("finished")
    return both.select(
        key, F.coalesce("alive", F.lit(False)).alias("alive"),
        F.when(F.col("_t"), F.coalesce("phase", launch)).otherwise(F.col("phase")).alias("phase"),
        "completed", "total", F.coalesce("message", F.lit("")).alias("message"), "rc",
        F.coalesce("updated", F.lit("")).alias("updated"))


def plan_gate(plan: DataFrame, clips: DataFrame, keys: list[str], group: list[str]) -> DataFrame:
    """Per piece: planned and present takes and whether it may be published; extra clips are ignored."""
    present = plan.select(*keys).join(clips.select(*keys).withColumn("_ok", F.lit(1)).dropDuplicates(keys), keys, "left")
    return present.groupBy(*group).agg(
        F.count(F.lit(1)).alias("planned"), F.count("_ok").alias("present"),
        (F.count(F.lit(1)) == F.count("_ok")).alias("publish"))


def missing_inputs(deliveries: DataFrame, inputs: DataFrame, keys: list[str]) -> DataFrame:
    return deliveries.join(inputs.select(*keys), keys, "left_anti")


def batch_outcome(items: DataFrame, inputs: DataFrame, key: str, batch: str, rc: str = "rc") -> DataFrame:
    """A batch fails if any item failed or lacks its input."""
    known = inputs.select(key).distinct().withColumn("_in", F.lit(True))
    both = items.join(known, key, "left")
    missing, failed = F.col("_in").isNull(), F.col(rc) != 0
    return both.groupBy(batch).agg(
        F.count(F.lit(1)).alias("items"), F.count_if(missing).alias("missing"),
        F.count_if(~missing & failed).alias("failed"), F.bool_or(missing | failed).alias("batch_failed"))
