"""Stand-in views: the engine's inputs expressed over a star schema of plain tables."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import constants as K
from .operators.ordered import numbered


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


TASK_BYTES = 4 << 20


def spread(df: DataFrame) -> DataFrame:
    """Deal rows round-robin into parts of `TASK_BYTES` of the files, and at least one for every core.

    Text work is bound by computing: a file's row group, which a task reads whole, may be minutes of work, and
    a small file is one task however many cores there are.  So tasks become more with the input, not longer.
    """
    files = df.groupBy("_metadata.file_path").agg(F.max("_metadata.file_size").alias("size"))
    total = files.agg(F.sum("size")).first()[0] or 0
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES)))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"))


def micros_since_2024(ts) -> Column:
    """Microseconds since 2024-01-01 of a zone-free timestamp, without any zone conversion."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    day = F.datediff(ts.cast("date"), F.lit("2024-01-01").cast("date")).cast("bigint")
    second = F.date_part(F.lit("SECOND"), ts)
    return (day * F.lit(86_400_000_000) + F.hour(ts).cast("bigint") * F.lit(3_600_000_000)
            + F.minute(ts).cast("bigint") * F.lit(60_000_000) + (second * 1_000_000).cast("bigint"))


def news(spark, folder) -> DataFrame:
    text = F.col("text")
    head = F.split_part(text, F.lit("\n"), F.lit(1))
    return documents(spark, folder).select(
        "doc_id", "lang", "source", head.alias("headline"),
        F.substring(text, F.length(head) + 2, F.length(text)).alias("body"))


def takes(spark, folder) -> DataFrame:
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", *order, "l_returnflag", "l_linestatus")
    idx = F.col("idx").cast("int")
    return numbered(lines, ["l_orderkey"], order).select(
        F.col("l_orderkey").alias("script_id"), idx.alias("idx"),
        (K.FRAMES_MIN + K.LADDER_STEP * (F.col("l_partkey") % 20)).cast("int").alias("frames"),
        F.when(F.col("l_returnflag") == "R", "informativo").when(F.col("l_returnflag") == "A", "habla")
        .otherwise("detalle").alias("take_type"),
        F.when(idx > 1, 1 + F.col("l_suppkey") % (idx - 1)).alias("anchor_source"),
        (F.col("l_linestatus") == "F").alias("own_scene"))


def series(spark, folder) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("user_id").alias("clip_id"), "event_id", "event_type",
        (micros_since_2024("ts") / F.lit(3.6e9)).alias("t"), F.col("value").alias("v"))


def frames(spark, folder) -> DataFrame:
    """Per-frame detections.  A frame and its embedding meet in one equi join."""
    events = table(spark, folder, "events").select("event_id", "user_id", "value")
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    rows = numbered(events, ["user_id"], ["event_id"], "pos")
    n = vectors.count()         # vectors are numbered from 0; the count comes from file footers
    return (rows.withColumn("vec_id", F.col("event_id") % n).join(vectors, "vec_id").select(
        F.col("user_id").alias("clip_id"), "event_id", (F.col("pos") - 1).cast("int").alias("frame_idx"),
        F.when(F.col("event_id") % 29 == 0, 0).when(F.col("event_id") % 31 == 0, 2).otherwise(1).alias("n_faces"),
        F.col("embedding").alias("emb"), F.col("value").alias("sharpness")))


def cues(spark, folder) -> DataFrame:
    return table(spark, folder, "conversations").select(
        F.col("conv_id").alias("script_id"), F.col("turn").alias("idx"), "role", "text")


# --- the same views for the SQL side ------------------------------------------------
SQL = {
    "news": """news AS (SELECT doc_id, lang, source, split_part(text, chr(10), 1) AS headline,
  substr(text, length(split_part(text, chr(10), 1)) + 2) AS body FROM documents)""",
    "takes_v": """takes_v AS (SELECT script_id, idx, frames, take_type,
  CASE WHEN idx = 1 THEN NULL ELSE 1 + k % (idx - 1) END AS anchor_source, own_scene
  FROM (SELECT l_orderkey AS script_id,
    CAST(row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS INT) AS idx,
    CAST(73 + 17 * (l_partkey % 20) AS INT) AS frames,
    CASE l_returnflag WHEN 'R' THEN 'informativo' WHEN 'A' THEN 'habla' ELSE 'detalle' END AS take_type,
    l_suppkey AS k, l_linestatus = 'F' AS own_scene FROM lineitem) x)""",
    "series_v": """series_v AS (SELECT user_id AS clip_id, event_id, event_type,
  (epoch_us(ts) - 1704067200000000) / 3.6e9 AS t, value AS v FROM events)""",
    "frames_v": """frames_v AS (SELECT e.user_id AS clip_id, e.event_id,
  CAST(row_number() OVER (PARTITION BY e.user_id ORDER BY e.event_id) - 1 AS INT) AS frame_idx,
  CASE WHEN e.event_id % 29 = 0 THEN 0 WHEN e.event_id % 31 = 0 THEN 2 ELSE 1 END AS n_faces,
  m.embedding AS emb, e.value AS sharpness
  FROM events e JOIN embeddings m ON m.vec_id = e.event_id % (SELECT count(*) FROM embeddings))""",
    "cues_v": """cues_v AS (SELECT conv_id AS script_id, turn AS idx, role, text FROM conversations)""",
}


def with_views(*names: str, extra: str = "") -> str:
    parts = [SQL[n] for n in names]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n"
