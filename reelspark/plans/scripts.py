"""Scripts: lines to headers, ordered takes and issues, and takes back to lines.

A script line is independent of every other line but for three things: the position of a
take, the headers it falls back to, and duplicates.  Parsing is therefore a projection over
lines; only those three need a shuffle, and none of them gathers a whole script in a task.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as X
from ..functions.fingerprints import canonical_fingerprint, run_fingerprint
from ..functions.numeric import is_voice, ladder_valid
from ..operators.ordered import OrderedGroups

BOM = "﻿"


def split_lines(scripts: DataFrame, script: str = "script_id", raw: str = "raw") -> DataFrame:
    """Whole texts to numbered lines; a byte order mark is accepted."""
    text = F.regexp_replace(raw, "^\\x{FEFF}", "")
    lines = scripts.select(script, F.posexplode(F.split(text, r"\r\n|[\n\r\x{0B}\x{0C}\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]")).alias("_p", "line"))
    return lines.select(script, (F.col("_p") + 1).alias("line_no"), "line")


def classify(lines: DataFrame, script: str = "script_id") -> DataFrame:
    """Kind and fields of every line that is neither blank nor a comment.

    The fields of a take are split where they are needed; one that names frames may stand anywhere behind the content.
    """
    rows = X.once(lines.select(script, "line_no", "line"), _t=X.strip_ws("line")).drop("line")
    t = F.col("_t")
    rows = rows.filter((t != "") & ~t.startswith("#"))
    header, take = t.startswith("@"), t.startswith("TOMA|") | t.startswith("HABLA|")
    rows = X.once(
        rows, kind=F.when(header, "header").when(take, "take").otherwise("other"), f=F.when(take, F.split(t, r"\|")),
        key=F.when(header, F.nullif(F.regexp_extract(t, K.HEADER_PATTERN, 1), F.lit(""))),
        value=F.when(header, F.trim(F.regexp_extract(t, K.HEADER_PATTERN, 2))), _nul=F.contains(t, F.lit("\0")),
        _frames=F.contains(t, F.lit("frames="))).drop("_t")
    take = F.col("kind") == "take"
    rows = X.once(rows, _tail=F.when(take, F.transform(F.slice("f", 3, 100), X.strip_ws)))
    is_named = lambda x: x.rlike(K.FRAMES_FIELD_PATTERN)
    rows = X.once(rows, named=F.when(F.col("_frames"), F.filter("_tail", is_named)),
                  positional=F.when(F.col("_frames"), F.filter("_tail", lambda x: ~is_named(x))).otherwise(F.col("_tail")))
    n = F.size("f")

    def own(i):
        return F.coalesce(F.get("positional", F.lit(i)), F.lit(""))
    rows = X.once(
        rows, record=F.get("f", F.lit(0)), content=X.strip_ws(F.get("f", F.lit(1))), raw_mode=own(0), own_type=own(1), own_scene=own(2),
        own_ambience=own(3), own_frames=F.regexp_extract(F.get("named", F.lit(0)), K.FRAMES_FIELD_PATTERN, 1).try_cast("bigint"),
        _n=n, _n_named=F.coalesce(F.size("named"), F.lit(0)), _n_positional=F.size("positional"))
    issue = (F.when(F.col("_nul"), "nul_byte")
             .when((F.col("kind") == "header") & F.col("key").isNull(), "bad_header")
             .when(F.col("kind") == "other", "unexpected_line")
             .when(take & ((F.col("_n") < 2) | (F.col("_n") > 7)), "field_count")
             .when(take & (F.col("_n_named") > 1), "repeated_frames")
             .when(take & (F.col("_n_positional") > 4), "too_many_positional")
             .when(take & (F.col("content") == ""), "empty_content"))
    return X.once(rows, issue=issue).select(script, "line_no", "kind", "key", "value", "record", "content", "raw_mode", "own_type",
                                            "own_scene", "own_ambience", "own_frames", "issue")


def headers(lines: DataFrame, script: str = "script_id") -> DataFrame:
    """(script, key, line_no, value): the first line of each header; only header lines are looked at."""
    rows = X.once(lines.select(script, "line_no", "line"), _t=X.strip_ws("line")).drop("line")
    rows = rows.filter(F.col("_t").startswith("@") & ~F.contains("_t", F.lit("\0")))
    rows = X.once(rows, key=F.regexp_extract("_t", K.HEADER_PATTERN, 1), value=F.trim(F.regexp_extract("_t", K.HEADER_PATTERN, 2)))
    first = rows.filter("key != ''").groupBy(script, "key").agg(F.min(F.struct("line_no", "value")).alias("_first"))
    return first.select(script, "key", "_first.line_no", "_first.value")


def _with_heads(placed: DataFrame, lines: DataFrame, script: str, split: bool) -> DataFrame:
    """Adds `_h`, the first line and value of each header of the script, to classified lines.

    The lines of a script are beside each other already; where a script is cut into chunks, its headers are joined.
    """
    names = list(K.HEADER_KEYS)
    if split:
        first = headers(lines, script).groupBy(script).agg(F.struct(*[
            F.max(F.when(F.col("key") == k, F.struct("line_no", "value"))).alias(k) for k in names]).alias("_h"))
        return placed.join(first, script, "left")
    whole = Window.partitionBy(script).orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    good = F.col("issue").isNull()
    return placed.select("*", *[F.min(F.when(good & (F.col("key") == k), F.struct("line_no", "value"))).over(whole).alias(f"_h{i}")
                                for i, k in enumerate(names)]).select(
        *placed.columns, F.struct(*[F.col(f"_h{i}").alias(k) for i, k in enumerate(names)]).alias("_h"))


def parse(lines: DataFrame, script: str = "script_id", max_rows: int | None = None
          ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lines to (headers, takes, issues).

    Lines are classified once and stand beside their script's number of takes and first headers by windows over
    one exchange; issues of a script are those of its first line.
    """
    groups = OrderedGroups.plan(lines, [script], ["line_no"], max_rows)     # no script has more rows than lines, and lines are cheap to count
    is_take = F.when((F.col("kind") == "take") & F.col("issue").isNull(), 1).otherwise(0)
    placed = groups.untag(groups.add(groups.tag(classify(lines, script)), row_number="_at", running={"idx": is_take},
                                     total={"n_takes": is_take}))
    every = normalize_modes(resolve_types(_with_heads(placed, lines, script, groups.is_split), script))
    takes = every.filter("kind = 'take' and issue is null").drop("kind", "issue", "key", "value", "_h", "_at", "n_takes")

    # a struct without a match is null, and so is its line
    first_line = F.coalesce(*[F.when(F.col("key") == k, F.col("_h")[k]["line_no"]) for k in K.HEADER_KEYS])
    header_issue = (F.when(F.col("line_no") > first_line, "duplicate_header")
                    .when((F.col("key") == "TIPO") & ~F.col("value").isin(list(K.TAKE_TYPES)), "unknown_default_type"))
    take_issues = F.array(
        F.when(~F.col("take_type").isin(list(K.TAKE_TYPES)), F.lit("unknown_type")), F.col("mode_issue"),
        F.when((F.col("own_frames") != 0) & ~ladder_valid("own_frames"), F.lit("frames_off_ladder")))
    line_issues = F.when((F.col("kind") == "take") & F.col("issue").isNull(), take_issues).otherwise(F.array(F.coalesce("issue", header_issue)))
    no_line = F.lit(None).cast("int")
    of_script = [F.when(F.coalesce(F.trim(F.col("_h")[k]["value"]), F.lit("")) == "", F.lit(f"missing_{k.lower()}"))
                 for k in K.REQUIRED_HEADERS] + [F.when(F.col("n_takes") == 0, F.lit("no_takes"))]
    found = X.once(every, _own=line_issues, _all=F.when(F.col("_at") == 1, F.array(*of_script)))
    issues = found.select(script, F.explode(F.concat(
        F.transform("_own", lambda x: F.struct(F.col("line_no").alias("line_no"), x.alias("issue"))),
        F.coalesce(F.transform("_all", lambda x: F.struct(no_line.alias("line_no"), x.alias("issue"))), F.expr("cast(array() as array<struct<line_no:int,issue:string>>)")))).alias("i"))
    return headers(lines, script), takes, issues.select(script, "i.line_no", "i.issue").filter("issue is not null")


def header_row(headers: DataFrame, script: str = "script_id") -> DataFrame:
    """One row per script with its four header values."""
    pick = lambda k: F.max(F.when(F.col("key") == k, F.col("value")))
    return headers.groupBy(script).agg(pick("TIPO").alias("default_type"), pick("ESCENA").alias("scene"),
                                       pick("AMBIENTE").alias("ambience"), pick("MUSICA").alias("music"))


def resolve_types(takes: DataFrame, script: str = "script_id") -> DataFrame:
    """Own type, else speech for HABLA records, else the script's default; scene and ambience fall back."""
    head = lambda k: F.col("_h")[k]["value"]
    take_type = (F.when(F.col("own_type") != "", F.col("own_type")).when(F.col("record") == "HABLA", "habla")
                 .otherwise(F.coalesce(head("TIPO"), F.lit("habla"))))
    return takes.select(
        *takes.columns, take_type.alias("take_type"),
        F.when(F.col("own_scene") != "", F.col("own_scene")).otherwise(head("ESCENA")).alias("scene"),
        F.when(F.col("own_ambience") != "", F.col("own_ambience")).otherwise(head("AMBIENTE")).alias("ambience"), head("MUSICA").alias("music"))


def normalize_modes(takes: DataFrame, raw: str = "raw_mode", idx: str = "idx") -> DataFrame:
    """Canonical mode, the take it is anchored to, and a warning or an issue where one applies."""
    extra = takes.columns
    mode0 = F.col("_mode")
    legacy, chain, numeric, ref = (F.col(c) for c in ("_legacy", "_chain", "_numeric", "_ref"))
    takes = X.once(takes, _mode=X.strip_ws(raw))
    anchor = mode0.startswith("ancla:")
    takes = X.once(takes, _legacy=anchor & mode0.rlike(K.LEGACY_ANCHOR_PATTERN), _chain=mode0 == "encadena",
                   _numeric=anchor & mode0.rlike(K.NUMERIC_ANCHOR_PATTERN))
    takes = X.once(takes, _ref=F.when(numeric, F.regexp_extract(mode0, K.NUMERIC_ANCHOR_PATTERN, 1).try_cast("bigint")))
    i = F.col(idx)
    to_first = legacy | chain | mode0.isin("", "ancla")
    source = F.when(i == 1, F.lit(None)).when(to_first, F.lit(1).cast("bigint")).when((ref >= 1) & (ref < i), ref)
    start = ((i == 1) & to_first) | (mode0 == "inicio")
    issue = (F.when(start | to_first, F.lit(None)).when(numeric, F.when(ref.isNull(), "anchor_out_of_range")
             .when(ref < 1, "no_such_take").when(ref >= i, "points_forward")).otherwise("unknown_mode"))
    warning = F.when(legacy, "legacy_mode").when(chain, "chain_mode")
    takes = X.once(takes, anchor_source=source, mode_warning=warning, mode_issue=issue, _start=start)
    mode = F.when(F.col("_start"), "inicio").when(F.col("anchor_source").isNotNull(), F.concat(F.lit("ancla:"), F.col("anchor_source").cast("string")))
    return takes.select(*extra, mode.alias("mode"), "anchor_source", "mode_warning", "mode_issue")


def catalog(lines: DataFrame, script: str = "script_id") -> DataFrame:
    """Number of takes and default type of every script."""
    kind = F.regexp_extract("line", r"^@TIPO\s+(\S+)", 1)
    return lines.groupBy(script).agg(
        F.count_if(F.col("line").rlike(r"^(TOMA|HABLA)\|")).alias("takes"),
        F.coalesce(F.min_by(F.when(kind != "", kind), F.when(kind != "", F.col("line_no"))), F.lit("habla")).alias("take_type"))


def effective_takes(takes: DataFrame, frames: int, width: int, height: int, steps: int, fps: int, seed: int, model_id: str,
                    name: Column, script: str = "script_id") -> DataFrame:
    """Takes with everything that decides their result, and the fingerprint of exactly that.

    Own frames are used when set and not zero, and take part only through their effect.
    """
    own = F.when(F.coalesce("own_frames", F.lit(0)) != 0, F.col("own_frames")).otherwise(F.lit(frames)).cast("int")
    out = (takes.withColumn("frames", own).withColumn("seed", F.lit(seed) + F.col("idx"))
           .withColumn("seconds", F.rint(F.col("frames") / fps * 1e6) / 1e6))
    c = F.col
    fields = {"idx": c("idx"), "record": c("record"), "content": c("content"), "mode": c("mode"), "take_type": c("take_type"),
              "scene": c("scene"), "ambience": c("ambience"), "music": c("music"), "anchor_source": c("anchor_source"),
              "name": name, "frames": c("frames"), "width": F.lit(width), "height": F.lit(height), "steps": F.lit(steps),
              "fps": F.lit(fps), "seed": c("seed"), "model_id": F.lit(model_id)}
    return out.withColumn("fingerprint", canonical_fingerprint(fields))


def plan_totals(takes: DataFrame, script: str = "script_id") -> DataFrame:
    """Predicted seconds, words, and voice and support takes per script."""
    voice = is_voice("take_type")
    return takes.groupBy(script).agg(
        F.count(F.lit(1)).alias("takes"), F.count_if(voice).alias("voice"), F.count_if(~voice).alias("support"),
        F.sum(X.word_count("content")).alias("words"), (F.rint(F.sum("seconds") * 1e6) / 1e6).alias("seconds"))


def voice_gate(takes: DataFrame, keys: list[str], take_type: str = "take_type") -> DataFrame:
    """Coverage is measured on the whole piece, so only where at least half of the takes speak."""
    out = takes.groupBy(*keys).agg(F.count(F.lit(1)).alias("takes"), F.count_if(is_voice(take_type)).alias("voice"))
    return out.withColumn("gate", F.when(F.col("voice") == 0, "no_voice").when(F.col("voice") * 2 < F.col("takes"), "mostly_silent")
                          .otherwise("measure"))


def plan_fingerprints(takes: DataFrame, script: str = "script_id") -> DataFrame:
    return run_fingerprint(takes, [script], "idx", "fingerprint")


def render_lines(takes: DataFrame, headers: DataFrame, script: str = "script_id", max_rows: int | None = None) -> DataFrame:
    """Script lines: the four headers, a blank line, then one line per take.

    takes: idx, content, take_type, frames (null for none).  The first take and every take
    without a voice starts clean; the others are anchored.  Lines stay rows, so a script of any
    length can be written.
    """
    h = header_row(headers, script)
    head = h.select(script, F.posexplode(F.array(
        F.concat(F.lit("@TIPO "), "default_type"), F.concat(F.lit("@ESCENA "), "scene"),
        F.concat(F.lit("@AMBIENTE "), "ambience"), F.concat(F.lit("@MUSICA "), "music"), F.lit(""))).alias("_p", "line"))
    head = head.select(script, (F.col("_p") + 1).cast("bigint").alias("line_no"), "line").filter("line is not null")
    mode = F.when((F.col("idx") == 1) | ~is_voice("take_type"), "inicio").otherwise("ancla")
    body = takes.select(script, (F.col("idx") + 5).cast("bigint").alias("line_no"), F.concat_ws(
        "|", F.lit("TOMA"), "content", mode, "take_type",
        F.when(F.coalesce("frames", F.lit(0)) != 0, F.concat(F.lit("frames="), F.col("frames").cast("string")))).alias("line"))
    return head.unionByName(body)
