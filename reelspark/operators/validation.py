"""Checks that give one row per violation instead of an error inside a task."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.numeric import delivery_audio_ok


def violations(df: DataFrame, keep: list[str], rules: list[tuple[str, Column]]) -> DataFrame:
    """One row per broken rule.  A rule is a label and the condition that breaks it; null breaks nothing."""
    broken = F.filter(F.array(*[F.when(cond, F.lit(label)) for label, cond in rules]), lambda x: x.isNotNull())
    return df.select(*keep, F.explode(broken).alias("issue"))


def news_rules(headline: Column, body: Column, name: Column, url: Column) -> list[tuple[str, Column]]:
    return [
        ("headline_missing", F.coalesce(F.trim(headline), F.lit("")) == ""),
        ("headline_too_long", F.length(headline) > K.HEADLINE_MAX),
        ("body_too_long", F.length(body) > K.BODY_MAX),
        ("nul_byte", F.contains(headline, F.lit("\0")) | F.contains(body, F.lit("\0"))),
        ("bad_name", ~F.coalesce(name, F.lit("")).rlike(K.NAME_PATTERN)),
        ("not_https", ~F.coalesce(url, F.lit("")).startswith("https://")),
    ]


def carousel_rules(slides: Column, name: Column, url: Column) -> list[tuple[str, Column]]:
    """Slides: array of struct(titulo, texto, cierre)."""
    n = F.coalesce(F.size(slides), F.lit(0))
    bad_len = lambda f, top: F.exists(slides, lambda s: ~F.coalesce(F.length(F.trim(s[f])), F.lit(0)).between(1, top))
    return [
        ("slide_count", ~n.between(K.SLIDES_MIN, K.SLIDES_MAX)),
        ("slide_title", bad_len("titulo", K.SLIDE_TITLE_MAX)),
        ("slide_text", bad_len("texto", K.SLIDE_TEXT_MAX)),
        ("slide_closing", F.exists(slides, lambda s: F.coalesce(F.length(s["cierre"]), F.lit(0)) > K.SLIDE_CLOSING_MAX)),
        ("bad_name", ~F.coalesce(name, F.lit("")).rlike(K.CAROUSEL_NAME_PATTERN)),
        ("not_https", ~F.coalesce(url, F.lit("")).startswith("https://")),
    ]


def check_clips(clips: DataFrame, expected: DataFrame, keys: list[str], min_bytes: int) -> DataFrame:
    """Clip against what its plan expects: size, frame, audio, frame count, rate, duration.

    clips: bytes, width, height, has_audio, frames, fps, duration.  expected: the same names
    with the suffix _exp for width, height, frames and fps.
    """
    c = F.col
    both = expected.join(clips.withColumn("_found", F.lit(True)), keys, "left")
    tolerance = F.greatest(F.lit(0.05), 1 / c("fps_exp"))
    def broken(rule: Column) -> Column:
        """A measure that is missing confirms nothing, so it breaks its rule."""
        return c("_found").isNotNull() & F.coalesce(rule, F.lit(True))

    return violations(both, keys, [
        ("missing_clip", c("_found").isNull()), ("too_small", broken(c("bytes") < min_bytes)),
        ("width", broken(c("width") != c("width_exp"))), ("height", broken(c("height") != c("height_exp"))),
        ("no_audio", broken(~c("has_audio"))), ("frame_count", broken(c("frames") != c("frames_exp"))),
        ("frame_rate", broken(F.abs(c("fps") - c("fps_exp")) > 0.01)), ("no_duration", broken(c("duration") <= 0)),
        ("duration", broken(F.abs(c("duration") - c("frames_exp") / c("fps_exp")) > tolerance))])


def montage_tolerance(fps: Column, n: Column) -> Column:
    return F.greatest(3.0 / fps, 0.03 * n, F.lit(0.08))


def montage_length_ok(measured: Column, expected: Column, fps: Column, n: Column) -> Column:
    return F.abs(measured - expected) <= montage_tolerance(fps, n)


def accept_deliveries(deliveries: DataFrame, batch: str, minimum: int, width: int = 1080, height: int = 1920,
                      min_bytes: int = 10000) -> DataFrame:
    """Issues of a batch of deliveries: too few, repeated names or stories, and rows out of limits.

    deliveries: name, story, bytes, duration, width, height, has_audio, lufs.
    """
    c = F.col
    rows = violations(deliveries, [batch, "name"], [
        ("no_audio", F.coalesce(~c("has_audio"), F.lit(True))), ("no_duration", F.coalesce(c("duration") <= 0, F.lit(True))),
        ("too_small", F.coalesce(c("bytes") < min_bytes, F.lit(True))),
        ("size", F.coalesce(c("width") != width, F.lit(True)) | F.coalesce(c("height") != height, F.lit(True))),
        ("loudness_unknown", c("lufs").isNull()), ("loudness", ~delivery_audio_ok("lufs"))])
    few = (deliveries.groupBy(batch).agg(F.count(F.lit(1)).alias("n")).filter(c("n") < minimum)
           .select(batch, F.lit("").alias("name"), F.lit("too_few").alias("issue")))

    def repeated(what, label):
        return (deliveries.groupBy(batch, what).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                .select(batch, c(what).alias("name"), F.lit(label).alias("issue")))

    return rows.unionByName(few).unionByName(repeated("name", "duplicate_name")).unionByName(
        repeated("story", "duplicate_story"))


def parse_pairs(df: DataFrame, keep: list[str], pairs: str) -> tuple[DataFrame, DataFrame]:
    """`key=value` lists (an array column) to rows, and the issues of bad, repeated or empty ones."""
    rows = df.select(*keep, F.posexplode(pairs).alias("pos", "pair"))
    at = F.instr(F.col("pair"), "=")
    rows = rows.withColumn("label", F.when(at > 0, F.substring(F.col("pair"), F.lit(1), at - 1)).otherwise(F.col("pair"))) \
               .withColumn("value", F.when(at > 0, F.substring(F.col("pair"), at + 1, F.length("pair"))))
    good = F.col("value").isNotNull() & F.col("label").rlike(K.LABEL_PATTERN)
    first = rows.filter(good).groupBy(*keep, "label").agg(F.min("pos").alias("_first"))
    judged = rows.join(first, [*keep, "label"], "left")
    issue = (F.when(~good, "malformed").when(F.col("pos") > F.col("_first"), "duplicate").when(F.col("value") == "", "empty"))
    judged = judged.withColumn("issue", issue)
    return (judged.filter("issue is null").select(*keep, "label", "value"),
            judged.filter("issue is not null").select(*keep, "pair", "issue"))


def strict_json(df: DataFrame, json: str, schema: str, integers: list[str]) -> DataFrame:
    """Parse JSON strictly: non-finite constants and non-integers in integer fields are refused.

    Adds the parsed struct `parsed` (null when refused) and `json_issue`.  Fields named in
    `integers` have to be integers written as a number or a digit string.
    """
    raw = F.col(json)
    # bare words outside quotes: blank out the strings first
    bare = F.regexp_replace(raw, r'"(?:[^"\\]|\\.)*"', '""')
    parsed = F.from_json(raw, schema, {"mode": "PERMISSIVE"})
    bad_int = F.lit(False)
    for name in integers:
        text = F.get_json_object(raw, f"$.{name}")
        bad_int = bad_int | F.coalesce(~text.rlike("^-?[0-9]+$"), F.lit(False))
    broken = F.try_parse_json(raw).isNull()
    issue = (F.when(bare.rlike(r"NaN|Infinity"), "not_finite").when(broken, "not_json").when(bad_int, "not_integer"))
    out = df.withColumn("json_issue", issue)
    return out.withColumn("parsed", F.when(F.col("json_issue").isNull(), parsed))
