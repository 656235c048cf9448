"""Rule-based choice of one good frame per clip from per-frame detections."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.numeric import box_extreme, candidate_score, first_match, pose
from .ordered import OrderedGroups, top_per_group


def detect(frames: DataFrame, scorer, schema: str) -> DataFrame:
    """Run a detector over frames.  `scorer` maps pandas batches to pandas batches.

    The backend is always named by the caller; there is no fallback.
    """
    if scorer is None:
        raise ValueError("a detector backend must be given")
    return frames.mapInPandas(scorer, schema)


def place(frames: DataFrame, keys: list[str], order: str, max_rows: int | None = None,
          local_change: str | None = None) -> DataFrame:
    """Add position, clip size, motion to the previous frame, and velocity.

    Motion is the shift of the box centre over the mean diagonal, defined between consecutive
    frames that hold exactly one face.  Velocity is the mean of the motions on both sides.
    """
    box = F.struct(order, "n_faces", "x", "y", "w", "h")
    groups = OrderedGroups.plan(frames, keys, [order], max_rows)
    near = groups.add(groups.tag(frames.withColumn("_box", box)), row_number="pos", total={"total": F.lit(1)},
                      lag={"_prev": "_box"})
    one, before = F.col("n_faces") == 1, F.col("_prev.n_faces") == 1
    ok = F.coalesce(one & before & (F.col(order) == F.col(f"_prev.{order}") + 1), F.lit(False))
    dx = (F.col("_prev.x") + F.col("_prev.w") / 2) - (F.col("x") + F.col("w") / 2)
    dy = (F.col("_prev.y") + F.col("_prev.h") / 2) - (F.col("y") + F.col("h") / 2)
    diagonal = (F.hypot("w", "h") + F.hypot("_prev.w", "_prev.h")) / 2
    shift = F.hypot(dx, dy) / F.greatest(F.lit(1e-6), diagonal)
    motion = shift if local_change is None else shift + K.LOCAL_CHANGE_WEIGHT * F.col(local_change)
    near = (near.withColumn("shift", F.when(ok, shift)).withColumn("motion", F.when(ok, motion))
            .withColumn("jump", F.when(ok, shift > K.JUMP_MAX)))
    near = groups.untag(groups.add(near, lead={"_motion_after": "motion"}))
    known = F.filter(F.array("motion", "_motion_after"), lambda m: m.isNotNull())
    velocity = F.when(F.size(known) == 2, (F.col("motion") + F.col("_motion_after")) / 2).otherwise(
        F.coalesce("motion", "_motion_after"))
    return near.withColumn("velocity", velocity).drop("_prev", "_box", "_motion_after")


def persistence_gate(placed: DataFrame, keys: list[str], fps: float) -> DataFrame:
    """Does one face persist through the clip?"""
    n = F.count(F.lit(1))
    single = F.count_if(F.col("n_faces") == 1)
    many = F.count_if(F.col("n_faces") > 1)
    moves, jumps = F.count("jump"), F.count_if(F.col("jump"))
    out = placed.groupBy(*keys).agg(
        n.alias("total"), (single / n).alias("single_share"), (many / n).alias("multiple_share"),
        moves.alias("transitions"), jumps.alias("jumps"))
    continuity = F.when(F.col("transitions") > 0, 1 - F.col("jumps") / F.col("transitions")).otherwise(F.lit(0.0))
    needed = max(K.MIN_ROWS, math.ceil(fps * 0.5))
    out = out.withColumn("continuity", continuity)
    return out.withColumn("approved", (F.col("total") >= needed) & (F.col("single_share") >= K.PERSISTENCE_MIN)
                          & (F.col("multiple_share") <= K.MULTIPLE_MAX)
                          & (F.col("continuity") >= K.CONTINUITY_MIN))


def landmark_pose() -> Column:
    """Pose from the columns ex0, ey0, ex1, ey1, nx, ny, mx0, my0, mx1, my1."""
    c = F.col
    return pose([(c("ex0"), c("ey0")), (c("ex1"), c("ey1")), (c("nx"), c("ny")), (c("mx0"), c("my0")), (c("mx1"), c("my1"))])


def rejection(margin: float = K.TIME_MARGIN, sharpness_min: float = K.SHARPNESS_MIN) -> Column:
    """First rule that a placed frame fails, or null for a candidate.  Needs `p` (pose)."""
    at = (F.col("pos") - 1) / F.greatest(F.lit(1), F.col("total") - 1)
    p = lambda f: F.col(f"p.{f}")
    return first_match([
        ((at < margin) | (at > 1.0 - margin), "extremo_temporal"),
        (F.col("n_faces") == 0, "sin_rostro_confiable"),
        (F.col("n_faces") > 1, "varios_rostros"),
        (box_extreme("x", "y", "w", "h", "frame_width", "frame_height"), "rostro_recortado_o_tamano_extremo"),
        (F.col("sharpness") < sharpness_min, "blur"),
        (p("eye_tilt") > K.EYE_TILT_MAX, "pose_ojos_extrema"),
        (p("mouth_tilt") > K.MOUTH_TILT_MAX, "pose_boca_extrema"),
        (p("yaw") > K.YAW_MAX, "pose_yaw_extrema"),
        (~p("nose_ratio").between(K.NOSE_MIN, K.NOSE_MAX), "pose_pitch_extrema"),
        (F.col("velocity").isNull(), "velocidad_no_disponible"),
        (F.col("velocity") > K.VELOCITY_MAX, "movimiento_extremo"),
    ])


def judged(placed: DataFrame) -> DataFrame:
    return placed.withColumn("p", landmark_pose()).withColumn("rejected_by", rejection())


def rejections(judged_frames: DataFrame, keys: list[str]) -> DataFrame:
    """How many frames each rule turned away."""
    return (judged_frames.filter("rejected_by is not null").groupBy(*keys, "rejected_by")
            .agg(F.count(F.lit(1)).alias("n")))


def rejection_map(judged_frames: DataFrame, keys: list[str]) -> DataFrame:
    """The same as one map per clip; at most one entry per rule is collected."""
    return rejections(judged_frames, keys).groupBy(*keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("rejected_by", "n")))).alias("rejections"))


def rank_candidates(judged_frames: DataFrame, keys: list[str], order: str, k: int = K.TOP_CANDIDATES) -> DataFrame:
    """Best candidates per clip; six keys make the order total."""
    scored = judged_frames.filter("rejected_by is null").withColumn(
        "score", candidate_score("mouth", "p.frontal", "sharpness", "velocity", "confidence"))
    centre = F.abs(F.col(order) / F.greatest(F.lit(1), F.col("total") - 1) - 0.5)
    return top_per_group(scored, keys, [F.desc("score"), F.asc("aperture"), F.asc("velocity"), F.desc("sharpness"),
                                        centre.asc(), F.asc(order)], k)
