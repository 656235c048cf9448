"""Content fingerprints: canonical JSON text hashed with SHA-256."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN_OUT = 4096


def canonical_json(fields: dict[str, Column]) -> Column:
    """Compact JSON with sorted keys; nulls are kept, because a missing and a null field differ."""
    ordered = [fields[k].alias(k) for k in sorted(fields)]
    return F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"})


def canonical_fingerprint(fields: dict[str, Column]) -> Column:
    return F.sha2(canonical_json(fields), 256)


def chained_fingerprint(shot: Column, anchor: Column | None = None, provenance: Column | None = None) -> Column:
    """Fingerprint of a take together with the anchor it starts from and where that came from."""
    with_anchor = F.sha2(canonical_json({"anchor_sha256": anchor, "shot": shot}), 256) if anchor is not None else None
    alone = F.sha2(canonical_json({"shot": shot}), 256)
    out = alone if anchor is None else F.when(anchor.isNotNull(), with_anchor).otherwise(alone)
    if provenance is None:
        return out
    text = F.concat(F.lit("schema=take-with-anchor/v1\ntake="), out, F.lit("\nprovenance="), provenance, F.lit("\n"))
    return F.when(provenance.isNull(), out).otherwise(F.sha2(text, 256))


def run_fingerprint(rows: DataFrame, keys: list[str], idx: str, value: str, levels: int = 3) -> DataFrame:
    """One hash per group over its rows in order.

    Hashes are combined in blocks of a fixed size, block by block, so that no task ever holds a
    whole group: three levels cover 4096³ rows.  The blocks follow the position, not the
    partitioning, so the result does not depend on how the data lies.
    """
    level = rows.select(*keys, (F.col(idx) - 1).cast("bigint").alias("_i"), F.col(value).alias("_h"))
    for _ in range(levels):
        level = (level.groupBy(*keys, F.floor(F.col("_i") / FAN_OUT).cast("bigint").alias("_b"))
                 .agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_h"))),
                                                      lambda s: s["_h"]), "\n"), 256).alias("_h"))
                 .withColumnRenamed("_b", "_i"))
    return level.select(*keys, F.col("_h").alias("run_fingerprint"))
