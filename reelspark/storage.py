"""Intermediate tables that several steps read."""
from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def written(rows: DataFrame) -> DataFrame:
    """The rows, written once to the folder that `spark.checkpoint.dir` names.

    All executors share that folder, so a lost executor loses none of them.  A session on one
    machine may leave it unset; on a cluster that is an error.
    """
    spark = rows.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return rows.checkpoint()
