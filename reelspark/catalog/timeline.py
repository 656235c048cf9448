"""Queries over takes, cues, segments and rhythm."""
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import numeric as N
from ..functions import text as X
from ..operators import folds
from ..operators import timeline as T
from ..views import documents, cues, takes, table, with_views
from . import sqltext as S
from .registry import query
from .text import _PACK_SQL


def R6(*names):
    return [F.round(n, 6).alias(n) for n in names]


@query("allocate_by_words", f"""WITH w AS (SELECT conv_id, turn, greatest(1, len({S.words('text')})) AS n, 30.0::DOUBLE + conv_id % 60 AS total FROM conversations),
  c AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::DOUBLE AS cum, sum(n) OVER (PARTITION BY conv_id)::DOUBLE AS al FROM w)
  SELECT conv_id, turn, round(total * (cum - n) / al, 6) AS t0, round(least(total, total * cum / al), 6) AS t1 FROM c""")
def allocate_by_words(spark, d):
    rows = table(spark, d, "conversations").select(
        "conv_id", "turn", F.greatest(F.lit(1), X.word_count("text")).alias("n"),
        (F.lit(30.0) + F.col("conv_id") % 60).alias("total"))
    return T.allocate(rows, ["conv_id"], ["turn"], "n", "total").select("conv_id", "turn", *R6("t0", "t1"))


_CUE_TAKES = """tk AS (SELECT script_id, idx, text, CASE WHEN role = 'user' THEN 'detalle' ELSE 'habla' END AS take_type,
    CASE WHEN script_id % 7 = 0 AND idx = 0 THEN NULL ELSE 73 + 17 * (idx % 5) END AS frames, 40.0::DOUBLE + script_id % 30 AS duration FROM cues_v),
  w AS (SELECT *, CASE WHEN count(*) FILTER (coalesce(frames, 0) = 0) OVER (PARTITION BY script_id) > 0 THEN 1 ELSE frames END AS w FROM tk),
  sp AS (SELECT *, duration * (sum(w) OVER (PARTITION BY script_id ORDER BY idx ROWS UNBOUNDED PRECEDING) - w)::DOUBLE / sum(w) OVER (PARTITION BY script_id) AS t0,
    least(duration, duration * (sum(w) OVER (PARTITION BY script_id ORDER BY idx ROWS UNBOUNDED PRECEDING))::DOUBLE / sum(w) OVER (PARTITION BY script_id)) AS t1 FROM w)"""


def _cue_takes(spark, d):
    c = cues(spark, d)
    return c.select(
        "script_id", "idx", "text", F.when(F.col("role") == "user", "detalle").otherwise("habla").alias("take_type"),
        F.when(~((F.col("script_id") % 7 == 0) & (F.col("idx") == 0)), 73 + 17 * (F.col("idx") % 5)).alias("frames"),
        (F.lit(40.0) + F.col("script_id") % 30).alias("duration"))


@query("take_spans", with_views("cues_v", extra=_CUE_TAKES) + "SELECT script_id, idx, round(t0, 6) AS t0, round(t1, 6) AS t1 FROM sp")
def take_spans(spark, d):
    return T.take_spans(_cue_takes(spark, d), ["script_id"], ["idx"]).select("script_id", "idx", *R6("t0", "t1"))


def _wrap_sql(source, key):
    """Greedy wrapping as a recursion over word positions."""
    return f"""ws AS (SELECT {key}, {S.words("regexp_replace(text, '[.]+$', '')")} AS ws FROM {source}),
  lw AS (SELECT {key}, ws, 1 AS p, 1 AS line, length(ws[1]) AS len FROM ws WHERE len(ws) > 0
    UNION ALL SELECT {key}, ws, p + 1, CASE WHEN len + 1 + length(ws[p + 1]) <= 15 THEN line ELSE line + 1 END,
      CASE WHEN len + 1 + length(ws[p + 1]) <= 15 THEN len + 1 + length(ws[p + 1]) ELSE length(ws[p + 1]) END
    FROM lw WHERE p < len(ws)),
  ln AS (SELECT {key}, line, string_agg(ws[p], ' ' ORDER BY p) AS text, count(*) AS n FROM lw GROUP BY {key}, line),
  gr AS (SELECT {key}, (line - 1) // 2 AS g, string_agg(text, chr(10) ORDER BY line) AS text, sum(n)::DOUBLE AS n FROM ln GROUP BY {key}, (line - 1) // 2)"""


@query("wrap_lines", "WITH RECURSIVE " + _wrap_sql("conversations", "conv_id, turn") +
       " SELECT conv_id, turn, CAST(line AS INT) AS line, text FROM ln")
def wrap_lines(spark, d):
    lines = X.wrap_lines(F.regexp_replace("text", "[.]+$", ""))
    return table(spark, d, "conversations").select("conv_id", "turn", F.posexplode(lines).alias("p", "text")).select(
        "conv_id", "turn", (F.col("p") + 1).alias("line"), "text")


_CUES = "WITH RECURSIVE " + with_views("cues_v", extra=_CUE_TAKES)[5:] + ", sv AS (SELECT * FROM sp WHERE take_type = 'habla'), " + _wrap_sql(
    "sv", "script_id, idx") + """, al AS (SELECT gr.*, sum(n) OVER (PARTITION BY script_id, idx ORDER BY g ROWS UNBOUNDED PRECEDING) AS cum,
    sum(n) OVER (PARTITION BY script_id, idx) AS tot FROM gr),
  cu AS (SELECT al.script_id, al.idx, CAST(g + 1 AS INT) AS part, t0 + (t1 - t0) * (cum - n) / tot AS t0, least(t1, t0 + (t1 - t0) * cum / tot) AS t1, al.text
    FROM al JOIN sv USING (script_id, idx))"""


@query("cues_from_takes", _CUES + " SELECT script_id, idx, part, round(t0, 6) AS t0, round(t1, 6) AS t1, text FROM cu")
def cues_from_takes(spark, d):
    return T.cues_from_takes(_cue_takes(spark, d), ["script_id"], "idx").select(
        "script_id", "idx", "part", *R6("t0", "t1"), "text")


@query("assign_cues", """WITH c AS (SELECT user_id, event_id, epoch_us(ts) / 3.6e9 - 473352 AS t0 FROM events),
  k AS (SELECT user_id, min(epoch_us(ts) / 3.6e9 - 473352) AS a, max(epoch_us(ts) / 3.6e9 - 473352) + 1 AS b FROM events GROUP BY user_id),
  s AS (SELECT user_id, i AS span, a + (b - a) * i / 10.0::DOUBLE AS t0, a + (b - a) * (i + 0.8::DOUBLE) / 10.0::DOUBLE AS t1 FROM k, range(10) r(i))
  SELECT c.user_id, c.event_id, CAST(s.span AS INT) AS span FROM c JOIN s ON s.user_id = c.user_id AND c.t0 >= s.t0 AND c.t0 < s.t1""")
def assign_cues(spark, d):
    from ..views import series
    hours = series(spark, d).select(F.col("clip_id").alias("user_id"), "event_id", F.col("t").alias("t0"))
    ends = hours.groupBy("user_id").agg(F.min("t0").alias("a"), (F.max("t0") + 1).alias("b"))
    width = F.col("b") - F.col("a")
    spans = ends.withColumn("span", F.explode(F.sequence(F.lit(0), F.lit(9)))).select(
        "user_id", "span", (F.col("a") + width * F.col("span") / 10.0).alias("t0"),
        (F.col("a") + width * (F.col("span") + 0.8) / 10.0).alias("t1"))
    return T.assign_cues(hours, spans, ["user_id"], "span").select("user_id", "event_id", "span")


_SEG = with_views("takes_v", extra="sg AS (SELECT script_id, idx, frames / 24.0::DOUBLE AS duration FROM takes_v)")


def _segments(spark, d):
    return takes(spark, d).select("script_id", "idx", (F.col("frames") / 24).alias("duration"))


@query("transition_crossfade", _SEG + """SELECT script_id, idx, row_number() OVER w AS seg, round(sum(duration) OVER w - duration - (row_number() OVER w - 1) * 0.5, 6) AS "offset",
  0.0::DOUBLE AS fade_in, 0.0::DOUBLE AS fade_out, round(sum(duration) OVER (PARTITION BY script_id) - (count(*) OVER (PARTITION BY script_id) - 1) * 0.5, 6) AS piece_length
  FROM sg WINDOW w AS (PARTITION BY script_id ORDER BY idx ROWS UNBOUNDED PRECEDING)""")
def transition_crossfade(spark, d):
    return T.transition_plan(_segments(spark, d), ["script_id"], ["idx"], "fundido", 0.5).select(
        "script_id", "idx", "seg", *R6("offset", "piece_length"), "fade_in", "fade_out")


@query("transition_black", _SEG + """SELECT script_id, idx, row_number() OVER w AS seg, round(sum(duration) OVER w - duration, 6) AS "offset",
  CASE WHEN row_number() OVER w > 1 THEN 0.4 ELSE 0.0 END::DOUBLE AS fade_in, CASE WHEN row_number() OVER w < count(*) OVER (PARTITION BY script_id) THEN 0.4 ELSE 0.0 END::DOUBLE AS fade_out,
  round(sum(duration) OVER (PARTITION BY script_id), 6) AS piece_length FROM sg WINDOW w AS (PARTITION BY script_id ORDER BY idx ROWS UNBOUNDED PRECEDING)""")
def transition_black(spark, d):
    return T.transition_plan(_segments(spark, d), ["script_id"], ["idx"], "negro", 0.8).select(
        "script_id", "idx", "seg", *R6("offset", "piece_length"), "fade_in", "fade_out")


@query("transition_issues_crossfade", _SEG + """, o AS (SELECT *, lag(duration) OVER w AS b, row_number() OVER w AS seg, count(*) OVER (PARTITION BY script_id) AS n FROM sg
    WINDOW w AS (PARTITION BY script_id ORDER BY idx))
  SELECT script_id, seg, 'does_not_fit' AS issue, round(least(b, duration), 6) AS available, 5.0::DOUBLE AS needed FROM o WHERE n >= 2 AND seg > 1 AND 5.0 >= least(b, duration)""")
def transition_issues_crossfade(spark, d):
    return T.transition_issues(_segments(spark, d), ["script_id"], ["idx"], "fundido", 5.0, 24).withColumn(
        "available", F.round("available", 6))


@query("transition_issues_black", _SEG + """, o AS (SELECT *, row_number() OVER w AS seg, count(*) OVER (PARTITION BY script_id) AS n FROM sg
    WINDOW w AS (PARTITION BY script_id ORDER BY idx)),
  q AS (SELECT *, ((seg > 1)::INT + (seg < n)::INT) * 4.5::DOUBLE AS needed FROM o)
  SELECT script_id, seg, 'does_not_fit' AS issue, round(duration, 6) AS available, needed FROM q WHERE n >= 2 AND duration + 1e-9 < needed""")
def transition_issues_black(spark, d):
    return T.transition_issues(_segments(spark, d), ["script_id"], ["idx"], "negro", 9.0, 24).withColumn(
        "available", F.round("available", 6))


@query("segments", with_views("takes_v") + """SELECT script_id, idx, CAST(sum(CASE WHEN idx = 1 OR own_scene THEN 1 ELSE 0 END)
  OVER (PARTITION BY script_id ORDER BY idx ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM takes_v""")
def segments(spark, d):
    t = takes(spark, d)
    return T.segments(t.select("script_id", "idx"), t.filter("own_scene").select("script_id", "idx"), ["script_id"], "idx")


@query("boundary_issues", with_views("takes_v", extra="""c AS (SELECT script_id, idx, own_scene, take_type, lpad(CAST(idx AS VARCHAR), 2, '0') AS label FROM takes_v),
  b AS (SELECT script_id, label FROM c WHERE own_scene UNION ALL SELECT script_id, label FROM c WHERE take_type = 'habla' UNION ALL SELECT script_id, 'x' || label FROM c WHERE idx = 4
    UNION ALL SELECT script_id, '98' FROM c WHERE idx = 5),
  m AS (SELECT script_id, label, count(*) AS times FROM b GROUP BY ALL)""") + """SELECT script_id, label, 'duplicate' AS issue FROM m WHERE times > 1
  UNION ALL SELECT script_id, label, 'malformed' FROM m WHERE NOT regexp_full_match(label, '[0-9]{2}')
  UNION ALL SELECT script_id, label, 'unknown_clip' FROM m WHERE (script_id, label) NOT IN (SELECT (script_id, label) FROM c)
  UNION ALL SELECT script_id, label, 'before_first' FROM m WHERE label = '01'""")
def boundary_issues(spark, d):
    c = takes(spark, d).select("script_id", "idx", "own_scene", "take_type", F.lpad(F.col("idx").cast("string"), 2, "0").alias("label"))
    s = lambda where, label: c.filter(where).select("script_id", label.alias("label"))
    b = (s("own_scene", F.col("label")).unionByName(s("take_type = 'habla'", F.col("label")))
         .unionByName(s("idx = 4", F.concat(F.lit("x"), "label"))).unionByName(s("idx = 5", F.lit("98"))))
    return T.boundary_issues(c, b, ["script_id"], "idx")


@query("alternate_framing", with_views("takes_v") + """SELECT script_id, idx, CASE WHEN idx % 2 = 0 THEN 1.15 ELSE 1.0 END::DOUBLE AS scale FROM takes_v""")
def alternate_framing(spark, d):
    return T.alternate(takes(spark, d).select("script_id", "idx"), ["script_id"], ["idx"], 1.15)


@query("fades", with_views("takes_v") + """SELECT script_id, idx, CASE WHEN idx = 1 THEN 0.25 ELSE 0.04 END::DOUBLE AS fade_in,
  CASE WHEN idx = max(idx) OVER (PARTITION BY script_id) THEN 0.25 ELSE 0.04 END::DOUBLE AS fade_out FROM takes_v""")
def fades(spark, d):
    return T.fades(takes(spark, d).select("script_id", "idx"), ["script_id"], ["idx"])


@query("numbering", """SELECT conv_id, turn, k AS number, 100 + k AS seed, printf('%02d', k) AS name, printf('%02d/%02d', k, n) AS page
  FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)""")
def numbering(spark, d):
    return T.number(table(spark, d, "conversations").select("conv_id", "turn"), ["conv_id"], ["turn"], 100)


@query("sample_times", _SEG + """SELECT script_id, idx, CAST(i AS INT) AS sample, round(duration * (i + 0.5) / 5, 6) AS t FROM sg, range(5) r(i)""")
def sample_times(spark, d):
    return T.sample_times(_segments(spark, d), 5).select("script_id", "idx", "sample", *R6("t"))


@query("fraction_times", _SEG + """SELECT script_id, idx, CAST(i - 1 AS INT) AS sample, round(duration * [0.04, 0.20, 0.36, 0.52, 0.68, 0.84, 0.96][i]::DOUBLE, 6) AS t FROM sg, range(1, 8) r(i)""")
def fraction_times(spark, d):
    return T.fraction_times(_segments(spark, d)).select("script_id", "idx", "sample", *R6("t"))


_RHYTHM = ["informativo", "detalle", "habla", "paisaje", "accion"]
_SUPPORTS = ["hands on a desk", "street at dusk", "empty newsroom"]


@query("interleave", _PACK_SQL.replace("u AS (", "u AS (", 1) + f""", b AS (SELECT doc_id, unit_idx - 1 AS i, text, {S.nearest_rung('n_words / 2.6::DOUBLE + 0.7')} AS frames FROM u),
  n AS (SELECT doc_id, max(i) AS last FROM b GROUP BY doc_id),
  sl AS (SELECT doc_id, j, [{S.listing(_RHYTHM)}][j % 5 + 1] AS take_type FROM n, range(0, (SELECT (max(last) // 2 + 1) * 5 FROM n)) r(j) WHERE j <= last // 2 * 5 + CASE WHEN last % 2 = 0 THEN 0 ELSE 2 END),
  vs AS (SELECT *, sum(CASE WHEN take_type IN ('habla', 'informativo') THEN 1 ELSE 0 END) OVER w AS voice, sum(CASE WHEN take_type IN ('habla', 'informativo') THEN 0 ELSE 1 END) OVER w AS sup
    FROM sl WINDOW w AS (PARTITION BY doc_id ORDER BY j ROWS UNBOUNDED PRECEDING))
  SELECT vs.doc_id, j + 1 AS take, vs.take_type, CASE WHEN vs.take_type IN ('habla', 'informativo') THEN b.text ELSE [{S.listing(_SUPPORTS)}][CAST((sup - 1) % 3 AS BIGINT) + 1] END AS content,
    CAST(CASE WHEN vs.take_type IN ('habla', 'informativo') THEN b.frames ELSE 107 END AS INT) AS frames
  FROM vs LEFT JOIN b ON b.doc_id = vs.doc_id AND b.i = voice - 1""")
def interleave(spark, d):
    units = folds.packed_units(documents(spark, d), "doc_id", "text", 8.0)
    units = units.withColumn("frames", N.frames_for_words("n_words"))
    arr = lambda xs: F.array(*[F.lit(x) for x in xs])
    return T.interleave(units, ["doc_id"], "unit_idx", "text", "frames", arr(_RHYTHM), arr(_SUPPORTS))


@query("anchor_positions", _SEG + """SELECT script_id, idx, round_even(duration * (idx - 1) / (count(*) OVER (PARTITION BY script_id) + 1) * 1000, 0) / 1000 AS pos FROM sg""")
def anchor_positions(spark, d):
    from ..operators.series import round_at
    from pyspark.sql import Window
    from ..operators.ordered import ordered
    s = ordered(_segments(spark, d), ["script_id"], ["idx"], total={"n": F.lit(1)})
    return s.select("script_id", "idx", round_at(F.col("duration") * (F.col("idx") - 1) / (F.col("n") + 1), 3).alias("pos"))
