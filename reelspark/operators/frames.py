"""Per-frame picture measures.

Frames arrive as rows of the image source (height, width, nChannels, BGR bytes).  One Arrow
batch job turns pixels into a few numbers per frame; everything across frames is left to
DataFrame aggregates and joins.  A frame is decoded by exactly one task and never collected.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = ("entropy double, grain double, edges double, chroma double, saturation_max double, luminance_mean double, "
           "corner_mean double, corner_deviation double, corner_peak double")


def _pixels(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    a = np.frombuffer(data, np.uint8).reshape(height, width, channels).astype(np.float64)
    return np.repeat(a[:, :, :1], 3, axis=2) if channels < 3 else a[:, :, :3]


def gray(a: np.ndarray) -> np.ndarray:
    return (114 * a[:, :, 0] + 587 * a[:, :, 1] + 299 * a[:, :, 2]) / 1000


def kernel(sigma: float) -> np.ndarray:
    """Normalised Gaussian weights over three deviations each way."""
    r = max(1, int(np.ceil(3 * sigma)))
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return k / k.sum()


def blur(g: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian blur of one plane or of planes on the last axis; edge pixels are repeated outwards.

    Each axis is a sum of shifted pictures, so the number of numpy calls does not depend on the size.
    """
    k = kernel(sigma)
    r = len(k) // 2
    for axis in (0, 1):
        n = g.shape[axis]
        padded = np.pad(g, [(r, r) if i == axis else (0, 0) for i in range(g.ndim)], mode="edge")
        part = lambda d: padded[d:d + n] if axis == 0 else padded[:, d:d + n]
        out = k[r] * part(r)
        for d in range(r):                                                  # the weights are symmetric
            out += k[d] * (part(d) + part(2 * r - d))
        g = out
    return g


def edge_energy(g: np.ndarray) -> np.ndarray:
    """Mean Sobel magnitude, clipped to the 8-bit range; one number per plane."""
    p = np.pad(g, [(1, 1), (1, 1), (0, 0)][:g.ndim], mode="edge")
    across, down = p[:, 2:] - p[:, :-2], p[2:] - p[:-2]
    dx = across[:-2] + 2 * across[1:-1] + across[2:]
    dy = down[:, :-2] + 2 * down[:, 1:-1] + down[:, 2:]
    return np.minimum(np.hypot(dx, dy), 255).mean(axis=(0, 1))


def entropy_bits(g: np.ndarray) -> float:
    c = np.bincount(np.clip(np.rint(g), 0, 255).astype(np.int64).ravel(), minlength=256).astype(float)
    p = c[c > 0] / c.sum()
    return float(-(p * np.log2(p)).sum()) + 0.0


def corners(g: np.ndarray) -> tuple[float, float, float]:
    """Mean of means, mean of deviations and peak over four corners of 16 % × 22 %."""
    h, w = max(1, int(g.shape[0] * 0.22)), max(1, int(g.shape[1] * 0.16))
    parts = np.stack((g[:h, :w], g[:h, -w:], g[-h:, :w], g[-h:, -w:]))
    return float(parts.mean()), float(parts.std(axis=(1, 2)).mean()), float(parts.max())


def frame_metrics(frames: DataFrame, keep: list[str]) -> DataFrame:
    """Picture measures of each frame beside the columns named in `keep`."""
    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for h, w, c, data in zip(pdf["height"], pdf["width"], pdf["nChannels"], pdf["data"]):
                a = _pixels(data, h, w, c)
                g = gray(a)
                soft = blur(g, 0.9)
                planes = edge_energy(blur(a, 1.3))
                spread = a.max(axis=2) - a.min(axis=2)
                rows.append((entropy_bits(soft), float(np.abs(g - soft).mean()), float(edge_energy(blur(g, 1.3))),
                             float(np.ptp(planes)), float(spread.max()), float(g.mean()), *corners(g)))
            names = [part.split()[0] for part in METRICS.split(", ")]
            yield pd.concat([pdf[keep].reset_index(drop=True), pd.DataFrame(rows, columns=names)], axis=1)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frames.select(*keep).schema.fields)
    return frames.select(*dict.fromkeys([*keep, "height", "width", "nChannels", "data"])).mapInPandas(measure, f"{fields}, {METRICS}")


def frame_hash(frames: DataFrame) -> DataFrame:
    """Stable hash over shape, element type and bytes."""
    shape = F.format_string("(%d, %d, %d)", F.col("height"), F.col("width"), F.col("nChannels"))
    zero = F.unhex(F.lit("00"))
    return frames.withColumn("frame_hash", F.sha2(F.concat(
        F.encode(shape, "utf-8"), zero, F.encode(F.lit("uint8"), "utf-8"), zero, F.col("data")), 256))


def jump_ratios(frames: DataFrame, keys: list[str], order: str, joints: DataFrame, apart: int) -> DataFrame:
    """Picture change over each joint against the change `apart` frames later.

    joints: keys and the first frame after the joint.  Each joint names its four frames, so the
    frames come by equi join and only pairs that are asked for meet.
    """
    at = F.col(order)
    pairs = joints.select(*keys, order, F.explode(F.array(
        F.struct(F.lit("joint").alias("kind"), (at - 1).alias("a"), at.alias("b")),
        F.struct(F.lit("near").alias("kind"), (at + apart).alias("a"), (at + apart + 2).alias("b")))).alias("p"))
    pairs = pairs.select(*keys, F.col(order).alias("joint"), "p.kind", "p.a", "p.b")
    side = lambda n: frames.select(*keys, F.col(order).alias(n), F.col("data").alias(f"data_{n}"))
    both = pairs.join(side("a"), [*keys, "a"]).join(side("b"), [*keys, "b"])

    def differ(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            diff = [float(np.abs(np.frombuffer(x, np.uint8).astype(np.int16) - np.frombuffer(y, np.uint8)).mean())
                    for x, y in zip(pdf["data_a"], pdf["data_b"])]
            yield pdf[[*keys, "joint", "kind"]].assign(diff=diff)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in both.select(*keys, "joint").schema.fields)
    diffs = both.select(*keys, "joint", "kind", "data_a", "data_b").mapInPandas(differ, f"{fields}, kind string, diff double")
    pick = lambda k: F.max(F.when(F.col("kind") == k, F.col("diff")))
    out = diffs.groupBy(*keys, "joint").agg(pick("joint").alias("at_joint"), pick("near").alias("nearby"))
    return out.filter((F.col("at_joint") > 0) & (F.col("nearby") > 0)).withColumn(
        "jump_ratio", F.col("at_joint") / F.col("nearby"))
