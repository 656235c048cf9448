"""Readers: landed files to rows with explicit schemas.

Each reader is a thin scan over a projection that also works on rows already in a table, so
the same rules serve files, tables and streams.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..functions.numeric import SRT_STAMP, name_dims, srt_seconds
from ..operators.ordered import top_per_group
from ..operators.timeline import spread_text

LINE_BREAK = r"\r\n|[\n\r\x{0B}\x{0C}\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def _whole(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    return reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))


# --- news -------------------------------------------------------------------------------
def parse_news(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Leading `KEY: value` lines, then the body.

    The header scan stops at the first line that is not a header, a blank one included.
    Without a headline the first non-blank line of the rest becomes it.
    """
    keys = "(?i)^(TITULAR|TITULO|FUENTE|TEMA)\\s*:\\s*(.*)$"
    lines = F.split(F.regexp_replace(raw, "^\\x{FEFF}", ""), LINE_BREAK)
    rows = df.withColumn("_l", F.transform(lines, lambda s: F.struct(s.alias("line"), X.strip_ws(s).alias("t"))))
    not_head = F.filter(F.transform("_l", lambda s, i: F.when(~s["t"].rlike(keys), i)), lambda i: i.isNotNull())
    rows = rows.withColumn("_n", F.coalesce(F.try_element_at(not_head, F.lit(1)), F.size("_l")))
    heads = F.transform(F.slice("_l", 1, F.col("_n")), lambda s: F.struct(
        F.upper(F.regexp_extract(s["t"], keys, 1)).alias("k"), X.strip_ws(F.regexp_extract(s["t"], keys, 2)).alias("v")))
    rows = rows.withColumn("_h", heads)

    def last(*names):
        return F.coalesce(F.try_element_at(F.filter("_h", lambda h: h["k"].isin(list(names))), F.lit(-1))["v"], F.lit(""))

    rest = F.slice("_l", F.col("_n") + 1, F.greatest(F.size("_l") - F.col("_n"), F.lit(0)))
    rows = rows.withColumn("_rest", rest).withColumn("_head", last("TITULAR", "TITULO"))
    filled = F.filter(F.transform("_rest", lambda s, i: F.when(s["t"] != "", i)), lambda i: i.isNotNull())
    rows = rows.withColumn("_first", F.when(F.col("_head") == "", F.try_element_at(filled, F.lit(1))))
    after = F.when(F.col("_head") != "", F.col("_rest")).when(F.col("_first").isNull(), F.slice("_rest", 1, 0)).otherwise(
        F.slice("_rest", F.col("_first") + 2, F.size("_rest")))
    topic = F.coalesce(F.try_element_at(F.filter(F.transform("_l", lambda s: F.regexp_extract(
        s["t"], r"(?i)^TEMA\s*:\s*(.*)$", 1)), lambda v: v != ""), F.lit(1)), F.lit(""))
    headline = F.when(F.col("_head") != "", F.col("_head")).otherwise(
        F.coalesce(F.try_element_at("_rest", (F.col("_first") + 1).cast("int"))["t"], F.lit("")))
    return rows.select(*df.columns, headline.alias("headline"),
                       X.strip_ws(F.array_join(F.transform(after, lambda s: s["line"]), "\n")).alias("body"),
                       last("FUENTE").alias("source_url"), X.strip_ws(topic).alias("topic"))


def read_news(spark: SparkSession, path: str) -> DataFrame:
    return parse_news(_whole(spark, path, "*.txt")).withColumn("id", file_stem(F.col("path")))


def news_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """All articles of a folder; an empty catalogue is an error."""
    catalogue = read_news(spark, folder)
    if catalogue.isEmpty():
        raise ValueError(f"no articles in {folder}")
    return catalogue


# --- feeds --------------------------------------------------------------------------------
_FEED = T.StructType([T.StructField(n, T.StringType()) for n in ("title", "description", "content:encoded", "summary", "content")])


def read_feed(spark: SparkSession, path: str, row_tag: str = "item") -> DataFrame:
    """Items of landed RSS (`item`) or Atom (`entry`) files, cleaned; items without a title are left out."""
    items = (spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", False).schema(_FEED).load(path)
             .select("*", F.col("_metadata.file_path").alias("path")))
    text = lambda c: F.nullif(F.trim(F.col(f"`{c}`")), F.lit(""))
    body = F.coalesce(*[text(c) for c in ("description", "content:encoded", "summary", "content")], F.lit(""))
    channel = (spark.read.format("xml").option("rowTag", "channel").schema("title string").load(path)
               .select(F.col("_metadata.file_path").alias("path"), F.trim("title").alias("source")))
    return (items.filter(text("title").isNotNull())
            .select("path", X.strip_html("title").alias("headline"), X.strip_html(body).alias("body"))
            .join(channel, "path", "left"))


# --- scripts ---------------------------------------------------------------------------------
def read_scripts(spark: SparkSession, path: str):
    from ..plans.scripts import parse, split_lines
    files = _whole(spark, path, "*.guion").select(file_stem(F.col("path")).alias("script_id"), "raw")
    return parse(split_lines(files))


# --- lines of files of any length ----------------------------------------------------------------
def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no, line) of every line, from 1; one file may be read by many tasks.

    A line's number is its place in its own split, which is as large as Spark cuts files, plus the lines of
    the splits before it in the file.
    """
    block = ["path", "block"]
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)     # splits of a file
    starts = lines.groupBy(*block).agg(F.count(F.lit(1)).alias("_n")).select(
        *block, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*block).orderBy("_at")                                                   # lines of a split
    placed = lines.withColumn("_at", F.monotonically_increasing_id()).withColumn("_k", F.row_number().over(inside))
    return placed.join(starts, block).select("path", (F.col("_before") + F.col("_k")).alias("line_no"), F.rtrim("line", F.lit("\r")).alias("line"))


# --- telemetry and probes -----------------------------------------------------------------------
def parse_telemetry_lines(lines: DataFrame, keep: list[str], line: str = "line", line_no: str = "line_no") -> DataFrame:
    """`g, MiB;g, MiB; RSS_KB=n` lines to one row per device and sample; line order is the clock."""
    lines = lines.filter(F.trim(line) != "")
    pairs = F.transform(F.regexp_extract_all(line, F.lit(r"(?:^|;)\s*([0-9]+\s*,\s*[0-9]+)"), F.lit(1)),
                        lambda p: F.struct(F.trim(F.split_part(p, F.lit(","), F.lit(1))).cast("int").alias("device"),
                                           F.trim(F.split_part(p, F.lit(","), F.lit(2))).cast("bigint").alias("mib")))
    rss = F.regexp_extract(line, r"RSS_KB=([0-9]+)", 1).try_cast("bigint")
    return lines.select(*keep, F.col(line_no).alias("sample_idx"), rss.alias("rss_kb"), F.explode(pairs).alias("_d")).select(
        *keep, "sample_idx", "_d.device", "_d.mib", "rss_kb")


def parse_telemetry(df: DataFrame, keep: list[str], raw: str = "raw") -> DataFrame:
    """The same from rows that hold a whole log each."""
    lines = df.select(*keep, F.posexplode(F.split(raw, r"\r?\n")).alias("_p", "line"))
    return parse_telemetry_lines(lines.select(*keep, (F.col("_p") + 1).alias("line_no"), "line"), keep)


def read_telemetry(spark: SparkSession, path: str) -> DataFrame:
    return parse_telemetry_lines(numbered_lines(spark, path).withColumn("run", file_stem(F.col("path"))), ["run"])


PROBE_SCHEMAS = {
    "duration": "width int, height int, frames int, video_seconds double, fits string, mib int, seconds int, reason string",
    "resolution": "width int, height int, frames int, steps int, fits string, mib int, seconds int, reason string",
    "ceiling": "frames int, rc int, seconds int, mib int, ram_gb double, swap_gb double, output bigint",
}


def _probes(spark: SparkSession, path: str, kind: str, sep: str) -> DataFrame:
    reader = spark.read.option("columnNameOfCorruptRecord", "_corrupt").option("columnPruning", False)      # every field of every line is looked at
    rows = reader.csv(path, schema=f"{PROBE_SCHEMAS[kind]}, _corrupt string", sep=sep, header=True, mode="PERMISSIVE", enforceSchema=True)
    return rows.select("*", F.col("_metadata.file_path").alias("path"))


def read_probes(spark: SparkSession, path: str, kind: str = "duration", sep: str = "\t") -> DataFrame:
    """Probe tables by explicit schema; yes/no becomes a boolean, blanks become null.  See probe_issues for the rest."""
    rows = _probes(spark, path, kind, sep).filter("_corrupt is null").drop("_corrupt", "path")
    return rows.withColumn("fits", F.col("rc") == 0 if kind == "ceiling" else F.lower("fits").isin("si", "sí", "yes"))


def probe_issues(spark: SparkSession, path: str, kind: str = "duration", sep: str = "\t") -> DataFrame:
    """(path, issue, raw, fields): lines that read_probes leaves out, with the fields that could be read."""
    rows = _probes(spark, path, kind, sep)
    fields = F.struct(*[c for c in rows.columns if c not in ("_corrupt", "path")])
    return rows.filter("_corrupt is not null").select("path", F.lit("malformed line").alias("issue"), F.col("_corrupt").alias("raw"), fields.alias("fields"))


# --- subtitles ---------------------------------------------------------------------------------------
def parse_srt(df: DataFrame, keep: list[str], raw: str = "raw") -> DataFrame:
    """Blocks with a time line and text; only cues that end after they start."""
    blocks = df.select(*keep, F.posexplode(F.split(X.strip_ws(F.regexp_replace(raw, "^\\x{FEFF}", "")), r"\n\s*\n")).alias("_b", "_t"))
    blocks = blocks.withColumn("_l", F.filter(F.transform(F.split("_t", LINE_BREAK), lambda s: F.rtrim(s, F.lit(X.WS_CHARS))),
                                              lambda s: X.strip_ws(s) != ""))
    at = F.array_position(F.transform("_l", lambda s: s.rlike(SRT_STAMP)), True)
    blocks = blocks.withColumn("_at", at.cast("int")).filter("_at > 0").withColumn("_s", F.get("_l", F.col("_at") - 1))
    text = F.array_join(F.slice("_l", F.col("_at") + 1, F.size("_l")), " ")
    return (blocks.select(*keep, (F.col("_b") + 1).alias("block"), srt_seconds(F.col("_s"), 1).alias("t0"),
                          srt_seconds(F.col("_s"), 5).alias("t1"), text.alias("text"))
            .filter((F.col("text") != "") & (F.col("t1") > F.col("t0"))))


def srt_cues(parsed: DataFrame, keep: list[str]) -> DataFrame:
    """Long subtitle blocks spread over several captions."""
    return spread_text(parsed, [*keep, "block"], "text")


def read_srt(spark: SparkSession, path: str) -> DataFrame:
    return parse_srt(_whole(spark, path, "*.srt").select(file_stem(F.col("path")).alias("script_id"), "raw"), ["script_id"])


# --- JSON ---------------------------------------------------------------------------------------------
SLIDE = "struct<titulo:string,texto:string,cierre:string>"
CAROUSEL_SCHEMA = f"nombre string, tema string, fecha string, fuente string, url string, color string, visual string, serie string, diapositivas array<{SLIDE}>"
CATEGORY_SCHEMA = ("nombre string, descripcion string, escena string, ambiente string, musica string, ritmo array<string>, apoyos array<string>, "
                   "formato struct<ancho:int,alto:int,frames:int,pasos:int,export_ancho:int,export_alto:int>, notas string")
STATE_SCHEMA = ("schema string, phase string, name string, run_fingerprint string, plan string, message string, final string, "
                "created_at string, updated_at string, pid bigint, completed bigint, total bigint")


def read_carousels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CAROUSEL_SCHEMA).json(path, multiLine=True)


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CATEGORY_SCHEMA).json(path, multiLine=True)


def slides(carousels: DataFrame) -> DataFrame:
    n = F.size("diapositivas").alias("slides")
    return carousels.select("*", n, F.posexplode("diapositivas").alias("_p", "_s")).select(
        *[c for c in carousels.columns if c != "diapositivas"], "slides", (F.col("_p") + 1).alias("slide"),
        "_s.titulo", "_s.texto", "_s.cierre")


#: States are small; anything larger is not one.
STATE_BYTES = 1024 * 1024


def _state_issue(raw: str) -> Column:
    """Why a text is no job state, or null."""
    shape = F.schema_of_variant(F.try_parse_json(raw))
    kind = lambda f, types: F.coalesce(F.regexp_extract(shape, rf"[<, ]{f}: ([A-Z]+)", 1), F.lit("")).isin(types)
    fields = {"phase": ["STRING"], "name": ["STRING"], "updated_at": ["STRING", ""],
              **{f: ["BIGINT", ""] for f in ("completed", "total", "pid")}, **{f: ["STRING", ""] for f in ("message", "final")}}
    wrong = [F.when(~kind(f, types), F.lit(f"field {f}")) for f, types in fields.items()]
    return (F.when(F.col(raw).isNull(), "no text").when(F.octet_length(raw) > STATE_BYTES, "too large")
            .when(~F.coalesce(shape.startswith("OBJECT"), F.lit(False)), "no JSON object").otherwise(F.coalesce(*wrong)))


def parse_states(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Job states from JSON text.  A text that is none, or has a wrongly typed field, is left to state_issues."""
    return (df.withColumn("_s", F.from_json(raw, STATE_SCHEMA)).filter(_state_issue(raw).isNull())
            .select(*[c for c in df.columns if c != raw], "_s.*"))


def state_issues(df: DataFrame, raw: str = "raw") -> DataFrame:
    """The other columns and the issue of every row that parse_states leaves out."""
    return df.withColumn("issue", _state_issue(raw)).filter("issue is not null").select(*[c for c in df.columns if c != raw], "issue")


def read_job_states(spark: SparkSession, path: str) -> DataFrame:
    return parse_states(_whole(spark, path, "*.json"))


# --- media ----------------------------------------------------------------------------------------------
def media_catalog(spark: SparkSession, folders: dict[str, str], glob: str = "*.mp4") -> DataFrame:
    """Media files with size, time, label by folder, size read from the name; content is never read."""
    out = None
    for label, folder in folders.items():
        files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
                 .select("path", "length", "modificationTime", F.lit(label).alias("label")))
        out = files if out is None else out.unionByName(files)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    dims = name_dims(name)
    return out.select(name.alias("name"), "label", (F.rint(F.col("length") / 2 ** 20 * 10) / 10).alias("mb"),
                      F.col("modificationTime").alias("modified"), dims["width"].alias("width"), dims["height"].alias("height"),
                      F.coalesce(dims["height"] > dims["width"], F.lit(False)).alias("vertical")).orderBy(F.desc("modified"), "name")


def _images(spark: SparkSession, path: str) -> DataFrame:
    """With a path column; a file that is no picture has no size."""
    return spark.read.format("image").option("dropInvalid", False).load(path).select("image.*")


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """Decoded frame images: origin, height, width, channels and BGR bytes.  See frame_issues for the rest."""
    return _images(spark, path).filter("height > 0 and width > 0")


def frame_issues(spark: SparkSession, path: str) -> DataFrame:
    """(path, issue) of files that are no picture."""
    return _images(spark, path).filter("not coalesce(height > 0 and width > 0, false)").select(
        F.col("origin").alias("path"), F.lit("no picture").alias("issue"))


# --- logs ------------------------------------------------------------------------------------------------
def log_tail(lines: DataFrame, keys: list[str], order: list[str], n: int = 10, line: str = "line") -> DataFrame:
    """Last lines of each log that say something."""
    text = F.col(line)
    useful = (X.strip_ws(text) != "") & ~F.ltrim(text, F.lit(X.WS_CHARS)).startswith("|") & ~F.contains(text, F.lit("###"))
    kept = lines.filter(useful).withColumn(line, F.rtrim(text, F.lit(X.WS_CHARS)))
    return top_per_group(kept, keys, [F.desc(c) for c in order], n)


def freshness(df: DataFrame, modified: str, now: Column, limit: int = 300) -> DataFrame:
    age = F.unix_timestamp(now) - F.unix_timestamp(modified)
    return df.withColumn("age_seconds", age).withColumn("fresh", age < limit)
