"""Timeline arithmetic: shares of time, cues, transitions, segments, rhythm and numbering."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as X
from ..functions.numeric import is_voice
from .ordered import OrderedGroups, ordered


def allocate(items: DataFrame, keys: list[str], order: list[str], weight: str, total: str,
             max_rows: int | None = None) -> DataFrame:
    """Share `total` among the items of a group by weight: `t0`, `t1` as running sums, end capped."""
    w = F.col(weight)
    placed = ordered(items, keys, order, max_rows, running={"_cum": w}, total={"_all": w})
    d = F.col(total)
    return placed.select(
        *items.columns, (d * (F.col("_cum") - w) / F.col("_all")).alias("t0"),
        F.least(d, d * F.col("_cum") / F.col("_all")).alias("t1"))


def take_spans(takes: DataFrame, keys: list[str], order: list[str], frames: str = "frames",
               duration: str = "duration", max_rows: int | None = None) -> DataFrame:
    """Span of each take, by its frames; if any take of the script lacks frames, all weigh one."""
    f = F.coalesce(F.col(frames), F.lit(0)).cast("bigint")
    placed = ordered(takes, keys, order, max_rows, row_number="_pos",
                     running={"_cum": f}, total={"_all": f, "_n": F.lit(1), "_bare": (f == 0).cast("int")})
    even = F.col("_bare") > 0
    w = F.when(even, F.lit(1)).otherwise(f)
    cum = F.when(even, F.col("_pos")).otherwise(F.col("_cum"))
    whole = F.when(even, F.col("_n")).otherwise(F.col("_all"))
    d = F.col(duration)
    return placed.select(*takes.columns, (d * (cum - w) / whole).alias("t0"),
                         F.least(d, d * cum / whole).alias("t1"))


def spread_text(df: DataFrame, keep: list[str], text: str, t0: str = "t0", t1: str = "t1",
                width: int = K.CAPTION_WIDTH, lines: int = K.CAPTION_LINES) -> DataFrame:
    """Cut a text into captions inside its span; time is shared by words, nothing is lost."""
    groups = X.group_lines(X.wrap_lines(F.regexp_replace(text, r"[.]+$", ""), width), lines)
    base = X.once(df.select(*keep, F.col(t0).alias("_s"), F.col(t1).alias("_e"), F.col(text)), _g=groups)
    counts = F.transform("_g", lambda g: F.greatest(F.lit(1), X.word_count(g)))
    rows = X.once(base.filter(F.size("_g") > 0), _w=counts).select(
        *keep, "_s", "_e", "_w", F.posexplode("_g").alias("_i", "text"))

    def words_before(n):
        return F.aggregate(F.slice("_w", 1, n), F.lit(0), lambda a, x: a + x)

    span, total = F.col("_e") - F.col("_s"), words_before(F.size("_w"))
    return rows.select(
        *keep, (F.col("_i") + 1).alias("part"), (F.col("_s") + span * words_before(F.col("_i")) / total).alias("t0"),
        F.least(F.col("_e"), F.col("_s") + span * words_before(F.col("_i") + 1) / total).alias("t1"), "text")


def cues_from_takes(takes: DataFrame, keys: list[str], order: str, text: str = "text", frames: str = "frames",
                    take_type: str = "take_type", duration: str = "duration",
                    max_rows: int | None = None) -> DataFrame:
    """Captions of every spoken take inside that take's span; silent takes use time and show nothing."""
    spans = take_spans(takes, keys, [order], frames, duration, max_rows)
    return spread_text(spans.filter(is_voice(take_type)), [*keys, order], text)


def assign_cues(cues: DataFrame, takes: DataFrame, keys: list[str], take_id: str,
                max_rows: int | None = None) -> DataFrame:
    """Which take does each cue start in?

    Spans of one script do not overlap, so the take is the last one that starts at or before
    the cue.  Counting starts in time order gives its ordinal; the match is then an equi join,
    and no cue meets more than one take.
    """
    starts = takes.select(*keys, F.col("t0").alias("_t"), F.lit(0).alias("_kind"), F.col("t1").alias("_end"),
                          F.col(take_id).alias("_take"))
    both = starts.select(*keys, "_t", "_kind", "_end", "_take", F.lit(None).alias("_cue")).unionByName(
        cues.select(*keys, F.col("t0").alias("_t"), F.lit(1).alias("_kind"), F.lit(None).cast("double").alias("_end"),
                    F.lit(None).alias("_take"), F.struct(*[c for c in cues.columns if c not in keys]).alias("_cue")))
    seen = ordered(both, keys, ["_t", "_kind", "_take"], max_rows, running={"_n": 1 - F.col("_kind")})
    spans = seen.filter("_kind = 0").select(*keys, "_n", F.col("_take").alias(take_id), F.col("_end").alias("_take_end"))
    found = seen.filter("_kind = 1").select(*keys, "_n", "_t", "_cue").join(spans, [*keys, "_n"], "inner")
    return found.filter(F.col("_t") < F.col("_take_end")).select(*keys, take_id, "_cue.*")


# --- transitions ------------------------------------------------------------------------
def transition_plan(segments: DataFrame, keys: list[str], order: list[str], mode: str, d: float,
                    duration: str = "duration", max_rows: int | None = None) -> DataFrame:
    """Start offset of each segment, its fades and the length of the piece.

    corte: back to back; fundido: neighbours overlap by `d`; negro: half of `d` fades out and in.
    """
    dur = F.col(duration)
    placed = ordered(segments, keys, order, max_rows, row_number="seg", running={"_cum": dur},
                     total={"_sum": dur, "n_segments": F.lit(1)})
    i, n = F.col("seg") - 1, F.col("n_segments")
    lap = d if mode == "fundido" else 0.0
    half = F.lit(d / 2 if mode == "negro" else 0.0)
    return placed.select(
        *segments.columns, "seg", (F.col("_cum") - dur - i * lap).alias("offset"),
        F.when(i > 0, half).otherwise(F.lit(0.0)).alias("fade_in"),
        F.when(i < n - 1, half).otherwise(F.lit(0.0)).alias("fade_out"),
        (F.col("_sum") - (n - 1) * lap).alias("piece_length"))


def transition_issues(segments: DataFrame, keys: list[str], order: list[str], mode: str, d: float, fps: float,
                      duration: str = "duration", max_rows: int | None = None) -> DataFrame:
    """Segments whose transitions do not fit, with what is available and what is needed."""
    placed = ordered(segments, keys, order, max_rows, row_number="seg", total={"_n": F.lit(1)},
                     lag={"_before": duration})
    dur, n, i = F.col(duration), F.col("_n"), F.col("seg") - 1
    minimum = 1.0 / fps if mode == "fundido" else 2.0 / fps
    multi = n >= 2
    too_short = multi & F.lit(d + 1e-9 < minimum) & (i == 0)
    if mode == "fundido":
        available, needed = F.least("_before", duration), F.lit(d)
        unfit = multi & (i > 0) & (needed >= available)
    else:
        sides = (i > 0).cast("int") + (i < n - 1).cast("int")
        available, needed = dur, sides * (d / 2)
        unfit = multi & (available + 1e-9 < needed)
    issue = F.when(too_short, "below_minimum").when(unfit, "does_not_fit")
    return placed.select(
        *keys, "seg", issue.alias("issue"),
        F.when(too_short, F.lit(d)).otherwise(available).alias("available"),
        F.when(too_short, F.lit(minimum)).otherwise(needed).cast("double").alias("needed")).filter("issue is not null")


def segments(clips: DataFrame, boundaries: DataFrame, keys: list[str], order: str,
             max_rows: int | None = None) -> DataFrame:
    """Number the segments; a boundary at a clip opens a new one (never at the first clip)."""
    marks = boundaries.select(*keys, order).distinct().withColumn("_mark", F.lit(1))
    flagged = clips.join(marks, [*keys, order], "left")
    groups = OrderedGroups.plan(flagged, keys, [order], max_rows)
    placed = groups.add(groups.tag(flagged), row_number="_pos")
    opens = F.when((F.col("_pos") == 1) | F.col("_mark").isNotNull(), 1).otherwise(0)
    return groups.untag(groups.add(placed, running={"segment": opens})).drop("_mark", "_pos")


def boundary_issues(clips: DataFrame, boundaries: DataFrame, keys: list[str], order: str, label: str = "label") -> DataFrame:
    """Duplicate boundaries, malformed labels, labels of no clip, and one at the first clip."""
    marks = boundaries.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("times"))
    first = clips.groupBy(*keys).agg(F.min_by(label, order).alias("_first"))
    known = clips.select(*keys, label).distinct().withColumn("_known", F.lit(True))
    rules = F.array(
        F.when(F.col("times") > 1, "duplicate"),
        F.when(~F.col(label).rlike("^[0-9]{2}$"), "malformed"),
        F.when(F.col("_known").isNull(), "unknown_clip"),
        F.when(F.col(label) == F.col("_first"), "before_first"))
    return (marks.join(known, [*keys, label], "left").join(first, keys, "left")
            .select(*keys, label, F.explode(rules).alias("issue")).filter("issue is not null"))


def alternate(clips: DataFrame, keys: list[str], order: list[str], factor: float,
              max_rows: int | None = None) -> DataFrame:
    """Every second clip gets the tighter framing; a factor of one or less changes nothing."""
    placed = ordered(clips, keys, order, max_rows, row_number="_pos")
    scale = F.when((F.col("_pos") % 2 == 0) & F.lit(factor > 1.0), F.lit(factor)).otherwise(F.lit(1.0))
    return placed.withColumn("scale", scale).drop("_pos")


def fades(clips: DataFrame, keys: list[str], order: list[str], max_rows: int | None = None) -> DataFrame:
    """0.25 s at the two ends of a piece, 0.04 s inside."""
    placed = ordered(clips, keys, order, max_rows, row_number="_pos", total={"_n": F.lit(1)})
    return placed.select(
        *clips.columns, F.when(F.col("_pos") == 1, 0.25).otherwise(0.04).alias("fade_in"),
        F.when(F.col("_pos") == F.col("_n"), 0.25).otherwise(0.04).alias("fade_out"))


def number(df: DataFrame, keys: list[str], order: list[str], base_seed: int = 0,
           max_rows: int | None = None) -> DataFrame:
    """Seed, two-digit name and page label of each row in its group."""
    placed = ordered(df, keys, order, max_rows, row_number="number", total={"_n": F.lit(1)})
    two = lambda c: F.when(c < 100, F.lpad(c.cast("string"), 2, "0")).otherwise(c.cast("string"))
    return placed.select(*df.columns, "number", (base_seed + F.col("number")).alias("seed"),
                         two(F.col("number")).alias("name"),
                         F.concat(two(F.col("number")), F.lit("/"), two(F.col("_n"))).alias("page"))


def sample_times(clips: DataFrame, n: int, duration: str = "duration") -> DataFrame:
    """Evenly spread instants: the middles of n equal parts."""
    return clips.withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn(
        "t", F.col(duration) * (F.col("sample") + 0.5) / n)


def fraction_times(clips: DataFrame, duration: str = "duration", fractions=K.SAMPLE_FRACTIONS) -> DataFrame:
    """Instants at fixed fractions of the clip."""
    return clips.select("*", F.posexplode(F.array(*[F.lit(f) for f in fractions])).alias("sample", "_f")).withColumn(
        "t", F.col(duration) * F.col("_f")).drop("_f")


def anchor_position(duration, k, n) -> Column:
    """Where in its source take the anchor of take k of n lies: never at an end that carries artefacts."""
    return F.bround(F.col(duration) * (F.col(k) - 1) / (F.col(n) + 1), 2)


# --- rhythm ----------------------------------------------------------------------------------
def interleave(blocks: DataFrame, keys: list[str], idx: str, text: str, frames: str,
               rhythm: Column, supports: Column) -> DataFrame:
    """Place measured text blocks in the voice slots of a cyclic rhythm; other slots take support shots.

    `idx` is the 1-based position of the block.  The slots between the previous block and this
    one depend on the position alone, so every block emits its own slots: no ordering work and
    at most one rhythm length of rows per block.  An empty or missing rhythm is one voice slot;
    one without voice yields nothing (`silent_rhythms` lists those).
    """
    base = blocks.select(*keys, F.col(idx).alias("_i"), F.col(text).alias("_text"), F.col(frames).alias("_frames"),
                         F.when(F.size(rhythm) > 0, rhythm).otherwise(F.array(F.lit("habla"))).alias("_r"),
                         F.coalesce(supports, F.array().cast("array<string>")).alias("_s"))
    voice = F.filter(F.sequence(F.lit(0), F.size("_r") - 1), lambda p: is_voice(F.element_at("_r", p + 1)))
    base = base.withColumn("_v", voice).filter(F.size("_v") > 0)
    m, v = F.size("_r").cast("bigint"), F.size("_v").cast("bigint")

    def slot(i):     # slot of the block with 0-based position i
        return F.floor(i / v) * m + F.element_at("_v", (i % v + 1).cast("int"))

    i = (F.col("_i") - 1).cast("bigint")
    after = F.when(i == 0, F.lit(-1).cast("bigint")).otherwise(slot(i - 1))
    rows = base.withColumn("_here", slot(i)).withColumn("_slot", F.explode(F.sequence(after + 1, F.col("_here"))))
    spoken = F.col("_slot") == F.col("_here")
    rows = rows.filter(spoken | (F.size("_s") > 0))
    support_no = F.col("_slot") - i          # slots before this one that are not blocks
    shots = F.greatest(F.size("_s"), F.lit(1))
    return rows.select(
        *keys, F.when(F.size("_s") > 0, F.col("_slot") + 1).otherwise(F.col("_i")).cast("bigint").alias("take"),
        F.when(spoken, F.col("_text")).otherwise(
            F.try_element_at("_s", (support_no % shots + 1).cast("int"))).alias("content"),
        F.element_at("_r", (F.col("_slot") % m + 1).cast("int")).alias("take_type"),
        F.when(spoken, F.col("_frames")).otherwise(F.lit(K.FRAMES_SUPPORT)).cast("int").alias("frames"))


def silent_rhythms(categories: DataFrame, rhythm: str = "ritmo") -> DataFrame:
    return categories.filter(~F.exists(rhythm, is_voice))
