"""Sinks: reports, manifests, script text and carousel texts."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.prompts import CAPTION_TEMPLATE, fill


def write_report(df: DataFrame, path: str) -> None:
    """Tab-separated with a header."""
    df.write.mode("errorifexists").csv(path, sep="\t", header=True)


def write_manifests(df: DataFrame, path: str, by: str | None = None) -> None:
    """One JSON object per entity, optionally laid out by a column."""
    writer = df.write.mode("errorifexists").option("ignoreNullFields", "false")
    (writer.partitionBy(by) if by else writer).json(path)


def write_scripts(lines: DataFrame, path: str, script: str = "script_id") -> None:
    """Script text: one folder per script, lines in order.

    Range partitioning on (script, line) splits a long script over consecutive files.
    """
    (lines.repartitionByRange(script, "line_no").sortWithinPartitions(script, "line_no")
     .select(script, F.col("line").alias("value")).write.mode("errorifexists").partitionBy(script).text(path))


def publish(df: DataFrame, path: str, version: str) -> str:
    """Write one version of a delivery; an existing version is never overwritten, older ones stay."""
    target = f"{path}/version={version}"
    df.write.mode("errorifexists").parquet(target)
    return target


def read_version(spark, path: str, version: str | None = None) -> DataFrame:
    """A published version; the newest by name when none is given."""
    every = spark.read.option("basePath", path).parquet(path)
    if version is None:
        version = every.agg(F.max(F.col("version").cast("string"))).first()[0]
    return every.filter(F.col("version").cast("string") == str(version))


def carousel_texts(carousels: DataFrame, keep: list[str]) -> DataFrame:
    """Caption and alternative texts.  A carousel has at most ten slides, so its texts are one row."""
    s, c = F.size("diapositivas").cast("string"), F.col
    caption = fill(CAPTION_TEMPLATE, series=c("serie"), topic=c("tema"), date=c("fecha"), count=s, source=c("fuente"), url=c("url"))
    alt = F.array_join(F.transform("diapositivas", lambda d, i: F.concat(
        F.lpad((i + 1).cast("string"), 2, "0"), F.lit(".jpg: "), d["titulo"], F.lit(". "), d["texto"],
        F.lit(" Ilustración conceptual sobre "), c("tema"), F.lit("."))), "\n\n")
    return carousels.select(*keep, caption.alias("caption"), alt.alias("alt_text"))
