"""Connected components of an edge table, by smallest labels and pointer jumping, in joins and grouping."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(node, label): every node of an edge (a, b) with the smallest node that it reaches.

    A round takes the smallest label among a node and its neighbours and then that label's own label: one
    join and map-side minimum by node, one join by label. Rounds grow with the logarithm of the longest
    chain; star-shaped input needs two or three. The lineage is cut in the shared checkpoint folder."""
    def pair(a: str, b: str):
        return F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    # Each edge both ways and each of its nodes with itself, from one pass: edges may be costly to make again.
    pairs = checkpointed(edges.filter("a <> b").select(F.inline(F.array(pair("a", "b"), pair("b", "a"), pair("a", "a"), pair("b", "b")))).distinct())
    labels = pairs.groupBy("a").agg(F.min("b").alias("label")).withColumnRenamed("a", "node")
    labels = checkpointed(labels)
    while True:
        near = (pairs.join(labels, pairs.b == labels.node).groupBy("a")
                .agg(F.min("label").alias("low"), F.max(F.when(F.col("a") == F.col("b"), F.col("label"))).alias("own")))
        up = labels.select(F.col("node").alias("low"), F.col("label").alias("above"))
        jumped = checkpointed(near.join(up, "low").select(F.col("a").alias("node"), F.least("low", "above").alias("next"), "own"))
        labels = jumped.select("node", F.col("next").alias("label"))
        if not jumped.filter("next <> own").limit(1).count():
            return labels
