"""Queries over scripts, plans, artifacts and their joins."""
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import numeric as N
from ..functions import prompts as P
from ..functions.fingerprints import chained_fingerprint, run_fingerprint
from ..operators import joins as J
from ..operators import sets as U
from ..operators import validation as V
from ..plans import scripts as C
from ..views import series, takes, table, with_views
from . import sqltext as S
from .registry import query

# Script lines derived from the take rows: every mode, some bad lines, some missing headers.
_MODE = """CASE frames % 7 WHEN 0 THEN 'ancla' WHEN 1 THEN '' WHEN 2 THEN 'encadena' WHEN 3 THEN 'ancla:' || coalesce(anchor_source, 1)
    WHEN 4 THEN 'inicio' WHEN 5 THEN 'ancla:anclas/a1.png' ELSE 'ancla:' || idx END"""
_LINES = f"""tl AS (SELECT script_id, idx, frames, take_type, own_scene, {_MODE} AS raw_mode,
    CASE WHEN own_scene THEN '' WHEN frames = 396 THEN 'cantado' ELSE take_type END AS own_type,
    CASE WHEN frames % 2 = 0 THEN 'HABLA' ELSE 'TOMA' END AS record FROM takes_v),
  script_lines AS (
    SELECT script_id, CAST(idx + 4 AS INT) AS line_no, CASE WHEN frames = 107 THEN '# nota' WHEN frames = 124 THEN 'suelta ' || frames
      ELSE record || '|Texto ' || frames || '|' || raw_mode || '|' || own_type || CASE WHEN frames % 3 = 0 THEN '|frames=' || (frames + frames % 5) ELSE '' END END AS line FROM tl
    UNION ALL SELECT DISTINCT script_id, 1, '@TIPO ' || CASE WHEN script_id % 8 = 0 THEN 'opera' ELSE 'informativo' END FROM tl
    UNION ALL SELECT DISTINCT script_id, 2, '@ESCENA plató ' || script_id FROM tl
    UNION ALL SELECT DISTINCT script_id, 3, CASE WHEN script_id % 5 = 0 THEN '@ESCENA otra' ELSE '@AMBIENTE sala' END FROM tl
    UNION ALL SELECT DISTINCT script_id, 4, CASE WHEN script_id % 9 = 0 THEN '@SONIDO x' ELSE '@MUSICA ninguna' END FROM tl)"""


def script_lines(spark, d):
    t, f = takes(spark, d), F.col("frames")
    mode = F.expr(_MODE)
    own = F.when(F.col("own_scene"), "").when(f == 396, "cantado").otherwise(F.col("take_type"))
    record = F.when(f % 2 == 0, "HABLA").otherwise("TOMA")
    full = F.concat(record, F.lit("|Texto "), f.cast("string"), F.lit("|"), mode, F.lit("|"), own,
                    F.when(f % 3 == 0, F.concat(F.lit("|frames="), (f + f % 5).cast("string"))).otherwise(""))
    body = t.select("script_id", (F.col("idx") + 4).cast("int").alias("line_no"),
                    F.when(f == 107, "# nota").when(f == 124, F.concat(F.lit("suelta "), f.cast("string"))).otherwise(full).alias("line"))
    s = F.col("script_id")
    heads = t.select("script_id").distinct().select("script_id", F.posexplode(F.array(
        F.concat(F.lit("@TIPO "), F.when(s % 8 == 0, "opera").otherwise("informativo")),
        F.concat(F.lit("@ESCENA plató "), s.cast("string")),
        F.when(s % 5 == 0, "@ESCENA otra").otherwise("@AMBIENTE sala"),
        F.when(s % 9 == 0, "@SONIDO x").otherwise("@MUSICA ninguna"))).alias("p", "line"))
    return body.unionByName(heads.select("script_id", (F.col("p") + 1).alias("line_no"), "line"))


_PARSE = with_views("takes_v", extra=_LINES + r""",
  hd AS (SELECT script_id, line_no, regexp_extract(line, '^@(TIPO|ESCENA|AMBIENTE|MUSICA)\s+(.+?)\s*$', 1) AS key,
      trim(regexp_extract(line, '^@(TIPO|ESCENA|AMBIENTE|MUSICA)\s+(.+?)\s*$', 2)) AS value FROM script_lines WHERE line LIKE '@%'),
  h AS (SELECT script_id, key, min(line_no) AS line_no, arg_min(value, line_no) AS value FROM hd WHERE key <> '' GROUP BY ALL),
  hr AS (SELECT script_id, max(value) FILTER (key = 'TIPO') AS dt, max(value) FILTER (key = 'ESCENA') AS scene, max(value) FILTER (key = 'AMBIENTE') AS ambience FROM h GROUP BY script_id),
  tk AS (SELECT script_id, line_no, string_split(line, '|') AS f FROM script_lines WHERE line LIKE 'TOMA|%' OR line LIKE 'HABLA|%'),
  tp AS (SELECT script_id, line_no, f[1] AS record, f[2] AS content, f[3] AS raw_mode, f[4] AS own_type, TRY_CAST(regexp_extract(coalesce(f[5], ''), '^frames=([0-9]{1,9})$', 1) AS BIGINT) AS own_frames,
    row_number() OVER (PARTITION BY script_id ORDER BY line_no) AS idx FROM tk),
  tt AS (SELECT tp.*, CASE WHEN own_type <> '' THEN own_type WHEN record = 'HABLA' THEN 'habla' ELSE coalesce(dt, 'habla') END AS take_type, scene, ambience,
    regexp_full_match(raw_mode, 'ancla:anclas/[^/]+\.png') AS legacy, TRY_CAST(regexp_extract(raw_mode, '^ancla:([0-9]+)$', 1) AS BIGINT) AS ref FROM tp LEFT JOIN hr USING (script_id)),
  md AS (SELECT *, CASE WHEN raw_mode = 'inicio' OR (idx = 1 AND (legacy OR raw_mode IN ('', 'ancla', 'encadena'))) THEN 'inicio'
      WHEN legacy OR raw_mode IN ('', 'ancla', 'encadena') THEN 'ancla:1' WHEN ref >= 1 AND ref < idx THEN 'ancla:' || ref END AS mode,
    CASE WHEN legacy THEN 'legacy_mode' WHEN raw_mode = 'encadena' THEN 'chain_mode' END AS mode_warning FROM tt)""")


@query("script_takes", _PARSE + """SELECT script_id, line_no, idx, record, content, take_type, mode,
  CASE WHEN mode LIKE 'ancla:%' THEN CAST(replace(mode, 'ancla:', '') AS BIGINT) END AS anchor_source, mode_warning, own_frames, scene, ambience FROM md""")
def script_takes(spark, d):
    _, t, _ = C.parse(script_lines(spark, d))
    return t.select("script_id", "line_no", "idx", "record", "content", "take_type", "mode", "anchor_source", "mode_warning",
                    "own_frames", "scene", "ambience")


@query("script_headers", _PARSE + "SELECT script_id, key, line_no, value FROM h")
def script_headers(spark, d):
    return C.headers(script_lines(spark, d)).select("script_id", "key", "line_no", "value")


@query("script_issues", _PARSE + """SELECT script_id, CAST(line_no AS INT) AS line_no, issue FROM (
  SELECT script_id, line_no, 'bad_header' AS issue FROM hd WHERE key = ''
  UNION ALL SELECT script_id, line_no, 'unexpected_line' FROM script_lines WHERE line LIKE 'suelta%'
  UNION ALL SELECT script_id, hd.line_no, 'duplicate_header' FROM hd JOIN h USING (script_id, key) WHERE hd.line_no > h.line_no
  UNION ALL SELECT s.script_id, NULL, 'missing_' || lower(k) FROM (SELECT DISTINCT script_id FROM script_lines) s, (VALUES ('ESCENA'), ('AMBIENTE'), ('MUSICA')) r(k)
    WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.script_id = s.script_id AND h.key = r.k)
  UNION ALL SELECT script_id, NULL, 'no_takes' FROM script_lines GROUP BY script_id HAVING count(*) FILTER (line LIKE 'TOMA|%' OR line LIKE 'HABLA|%') = 0
  UNION ALL SELECT script_id, line_no, 'unknown_default_type' FROM h WHERE key = 'TIPO' AND value = 'opera'
  UNION ALL SELECT script_id, line_no, 'unknown_type' FROM md WHERE take_type IN ('cantado', 'opera')
  UNION ALL SELECT script_id, line_no, 'points_forward' FROM md WHERE mode IS NULL
  UNION ALL SELECT script_id, line_no, 'frames_off_ladder' FROM md WHERE own_frames <> 0 AND (own_frames < 5 OR (own_frames - 5) % 17 <> 0))""")
def script_issues(spark, d):
    return C.parse(script_lines(spark, d))[2].select("script_id", F.col("line_no").cast("int").alias("line_no"), "issue")


@query("script_catalog", with_views("takes_v", extra=_LINES) + r"""SELECT script_id, count(*) FILTER (line LIKE 'TOMA|%' OR line LIKE 'HABLA|%') AS takes,
  coalesce(max(CASE WHEN line LIKE '@TIPO %' THEN regexp_extract(line, '^@TIPO\s+(\S+)', 1) END), 'habla') AS take_type FROM script_lines GROUP BY script_id""")
def script_catalog(spark, d):
    return C.catalog(script_lines(spark, d))


@query("missing_headers", _PARSE + """SELECT s.script_id, k AS missing FROM (SELECT o_orderkey AS script_id FROM orders UNION SELECT script_id FROM h) s, (VALUES ('ESCENA'), ('AMBIENTE'), ('MUSICA')) r(k)
    WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.script_id = s.script_id AND h.key = r.k)""")
def missing_headers(spark, d):
    """Of every order's script, those without any line included."""
    every = table(spark, d, "orders").select(F.col("o_orderkey").alias("script_id"))
    return U.missing_headers(C.headers(script_lines(spark, d)), scripts=every)


_RENDER = "rt AS (SELECT script_id, idx, 'Toma ' || idx || ' de ' || script_id AS content, take_type, CASE WHEN own_scene THEN NULL ELSE frames END AS frames FROM takes_v)"


def _render_takes(spark, d):
    return takes(spark, d).select(
        "script_id", "idx", F.concat(F.lit("Toma "), F.col("idx").cast("string"), F.lit(" de "), F.col("script_id").cast("string")).alias("content"),
        "take_type", F.when(~F.col("own_scene"), F.col("frames")).alias("frames"))


@query("render_scripts", with_views("takes_v", extra=_RENDER) + """SELECT script_id, CAST(idx + 5 AS BIGINT) AS line_no, 'TOMA|' || content || '|'
  || CASE WHEN idx = 1 OR take_type NOT IN ('habla', 'informativo') THEN 'inicio' ELSE 'ancla' END || '|' || take_type
  || CASE WHEN frames IS NOT NULL THEN '|frames=' || frames ELSE '' END AS line FROM rt
  UNION ALL SELECT script_id, i, ['@TIPO informativo', '@ESCENA plató', '@AMBIENTE sala', '@MUSICA ninguna', ''][i] FROM (SELECT DISTINCT script_id FROM rt), range(1, 6) r(i)""")
def render_scripts(spark, d):
    t = _render_takes(spark, d)
    kv = F.create_map(*[F.lit(x) for x in ("TIPO", "informativo", "ESCENA", "plató", "AMBIENTE", "sala", "MUSICA", "ninguna")])
    headers = t.select("script_id").distinct().select("script_id", F.explode(kv).alias("key", "value"))
    return C.render_lines(t, headers)


@query("ladder_valid", with_views("takes_v") + """SELECT script_id, idx, f % 17 = 5 AND f >= 5 AS valid, CAST((f - 5) // 17 * 17 + 5 AS BIGINT) AS below, CAST(((f - 5) // 17 + 1) * 17 + 5 AS BIGINT) AS above,
  f BETWEEN 22 AND 345 AND f % 17 = 5 AS allowed_in_form FROM (SELECT *, frames + frames % 3 AS f FROM takes_v)""")
def ladder_valid(spark, d):
    f = F.col("frames") + F.col("frames") % 3
    return takes(spark, d).select(
        "script_id", "idx", N.ladder_valid(f).alias("valid"), N.ladder_floor(f).alias("below"), N.ladder_above(f).alias("above"),
        (N.ladder_valid(f) & f.between(K.UI_FRAMES_MIN, K.UI_FRAMES_MAX)).alias("allowed_in_form"))


@query("resolve_anchors", with_views("takes_v") + """SELECT t.script_id, t.idx, t.anchor_source, a.take_type AS anchor_take_type,
  CASE WHEN t.anchor_source IS NULL THEN NULL WHEN t.anchor_source >= t.idx THEN 'points_forward' WHEN a.idx IS NULL THEN 'no_such_take' END AS anchor_issue
  FROM takes_v t LEFT JOIN takes_v a ON a.script_id = t.script_id AND a.idx = t.anchor_source""")
def resolve_anchors(spark, d):
    t = takes(spark, d).withColumn("idx", F.col("idx").cast("bigint"))
    out = J.resolve_anchors(t, ["script_id"], bring=("take_type",))
    return out.select("script_id", F.col("idx").cast("int").alias("idx"), "anchor_source", "anchor_take_type", "anchor_issue")


@query("level_gains", with_views("series_v", extra="""k AS (SELECT clip_id AS script_id, CAST(floor(t / 72) AS INT) + 1 AS idx, v FROM series_v),
  m AS (SELECT script_id, idx, list_sort(list(v))[(count(*) + 1) // 2] AS level FROM k GROUP BY ALL),
  tk AS (SELECT m.*, CASE WHEN idx = 1 THEN NULL WHEN (script_id + idx) % 5 = 0 THEN NULL ELSE 1 END AS anchor_source, (script_id + idx) % 4 = 0 AS own_scene FROM m),
  g AS (SELECT tk.*, r.level AS ref, CASE WHEN coalesce(tk.level, 0) <> 0 AND coalesce(r.level, 0) <> 0
      THEN round_even(greatest(0.5, least(2.0, r.level / tk.level)) * 10000, 0) / 10000 ELSE 1.0 END AS gain FROM tk LEFT JOIN m r ON r.script_id = tk.script_id AND r.idx = 1)""") +
       """SELECT script_id, idx, level, gain, CASE WHEN idx = 1 THEN 'reference' WHEN own_scene OR anchor_source IS NULL THEN 'own_image' WHEN gain < 0.98 OR gain > 1.02 THEN 'level' ELSE 'keep' END AS action FROM g""")
def level_gains(spark, d):
    levels = series(spark, d).select(F.col("clip_id").alias("script_id"), (F.floor(F.col("t") / 72) + 1).cast("int").alias("idx"),
                                     F.col("v").alias("level"))
    s = F.col("script_id") + F.col("idx")
    tk = levels.select("script_id", "idx").distinct().select(
        "script_id", "idx", F.when((F.col("idx") != 1) & (s % 5 != 0), F.lit(1)).alias("anchor_source"), (s % 4 == 0).alias("own_scene"))
    return J.level_gains(levels, tk, ["script_id"])


_ART = """p AS (SELECT o_orderkey AS k, md5(CAST(o_orderkey AS VARCHAR)) AS fingerprint FROM orders),
  a AS (SELECT l_orderkey + 7 AS k, count(*) % 3 <> 0 AS has_artifact, CASE (l_orderkey + 7) % 5 WHEN 0 THEN NULL WHEN 1 THEN 'other' ELSE md5(CAST(l_orderkey + 7 AS VARCHAR)) END AS recorded,
    sum(l_linenumber) % 4 <> 0 AS bytes_match, min(l_partkey) % 5 <> 0 AS valid FROM lineitem GROUP BY l_orderkey)"""


@query("reconcile", "WITH " + _ART + """ SELECT coalesce(p.k, a.k) AS k, CASE WHEN p.k IS NULL THEN 'not_planned'
  WHEN coalesce(has_artifact, false) AND coalesce(recorded = fingerprint AND bytes_match, false) AND valid THEN 'reuse'
  WHEN coalesce(has_artifact, false) AND coalesce(recorded = fingerprint AND bytes_match, false) THEN 'invalid'
  WHEN coalesce(has_artifact, false) AND recorded IS NULL AND valid THEN 'legacy' WHEN coalesce(has_artifact, false) THEN 'changed'
  WHEN recorded IS NOT NULL THEN 'orphan_fingerprint' ELSE 'missing' END AS decision FROM p FULL JOIN a ON p.k = a.k""")
def reconcile(spark, d):
    plan = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.md5(F.col("o_orderkey").cast("string")).alias("fingerprint"))
    k = F.col("k")
    art = (table(spark, d, "lineitem").groupBy((F.col("l_orderkey") + 7).alias("k"))
           .agg((F.count(F.lit(1)) % 3 != 0).alias("has_artifact"), (F.sum("l_linenumber") % 4 != 0).alias("bytes_match"),
                (F.min("l_partkey") % 5 != 0).alias("valid")))
    art = art.withColumn("recorded", F.when(k % 5 == 1, "other").when(k % 5 != 0, F.md5(k.cast("string"))))
    return J.reconcile(plan, art, ["k"])


@query("incompatible_clips", with_views("takes_v", extra="""c AS (SELECT *, first_value(frames % 3) OVER w AS f1, first_value(own_scene) OVER w AS f2, first_value(idx) OVER w AS reference,
  first_value(take_type) OVER w AS f3 FROM takes_v WINDOW w AS (PARTITION BY script_id ORDER BY idx))""") + """SELECT script_id, reference, idx,
  concat_ws(' y ', CASE WHEN frames % 3 <> f1 OR own_scene <> f2 THEN 'video' END, CASE WHEN take_type <> f3 THEN 'audio' END) AS differs FROM c
  WHERE frames % 3 <> f1 OR own_scene <> f2 OR take_type <> f3""")
def incompatible_clips(spark, d):
    c = takes(spark, d).withColumn("codec", F.col("frames") % 3)
    return J.incompatible_clips(c, ["script_id"], "idx", ["codec", "own_scene"], ["take_type"])


@query("owned_processes", """SELECT event_id, user_id FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)""")
def owned_processes(spark, d):
    own = table(spark, d, "customer").filter("c_acctbal > 5000").select(F.col("c_custkey").alias("user_id"))
    return J.owned(table(spark, d, "events").select("event_id", "user_id"), own, "user_id")


@query("foreign_processes", """SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)""")
def foreign_processes(spark, d):
    own = table(spark, d, "customer").filter("c_acctbal > 5000").select(F.col("c_custkey").alias("user_id"))
    return J.foreign(table(spark, d, "events").select("event_id", "user_id"), own, "user_id")


@query("merge_status", """WITH t AS (SELECT c_custkey AS name, c_acctbal > 0 AS alive, CASE WHEN c_acctbal <= 0 THEN c_nationkey END AS rc FROM customer WHERE c_mktsegment <> 'BUILDING'),
  s AS (SELECT o_custkey AS name, arg_max(o_orderstatus, o_orderkey) AS phase, count(*) FILTER (o_orderstatus = 'F') AS completed, count(*) AS total,
    arg_max(o_orderpriority, o_orderkey) AS message, CAST(max(o_orderdate) AS VARCHAR) AS updated FROM orders GROUP BY o_custkey)
  SELECT coalesce(t.name, s.name) AS name, coalesce(alive, false) AS alive, CASE WHEN t.name IS NOT NULL THEN coalesce(phase, CASE WHEN alive THEN 'launching' ELSE 'finished' END) ELSE phase END AS phase,
    completed, total, coalesce(message, '') AS message, rc, coalesce(updated, '') AS updated FROM t FULL JOIN s ON t.name = s.name""")
def merge_status(spark, d):
    t = table(spark, d, "customer").filter("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("name"), (F.col("c_acctbal") > 0).alias("alive"),
        F.when(F.col("c_acctbal") <= 0, F.col("c_nationkey")).alias("rc"))
    s = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("name")).agg(
        F.max_by("o_orderstatus", "o_orderkey").alias("phase"), F.count_if(F.col("o_orderstatus") == "F").alias("completed"),
        F.count(F.lit(1)).alias("total"), F.max_by("o_orderpriority", "o_orderkey").alias("message"),
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("updated"))
    return J.merge_status(t, s, "name")


@query("plan_gate", """WITH c AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag <> 'R')
  SELECT o_custkey, count(*) AS planned, count(c.k) AS present, count(*) = count(c.k) AS publish FROM orders LEFT JOIN c ON c.k = o_orderkey GROUP BY o_custkey""")
def plan_gate(spark, d):
    plan = table(spark, d, "orders").select("o_custkey", F.col("o_orderkey").alias("k"))
    clips = table(spark, d, "lineitem").filter("l_returnflag <> 'R'").select(F.col("l_orderkey").alias("k"))
    have = clips.distinct()
    keyed = plan.join(have, "k", "left_semi")
    return J.plan_gate(plan, keyed, ["o_custkey", "k"], ["o_custkey"])


@query("missing_inputs", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def missing_inputs(spark, d):
    return J.missing_inputs(table(spark, d, "orders").select("o_orderkey"),
                            table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query("batch_outcome", """WITH l AS (SELECT DISTINCT l_orderkey FROM lineitem) SELECT o_custkey, count(*) AS items, count(*) FILTER (l_orderkey IS NULL) AS missing,
  count(*) FILTER (l_orderkey IS NOT NULL AND o_orderstatus = 'F') AS failed, bool_or(l_orderkey IS NULL OR o_orderstatus = 'F') AS batch_failed
  FROM orders LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY o_custkey""")
def batch_outcome(spark, d):
    items = table(spark, d, "orders").select("o_orderkey", "o_custkey", (F.col("o_orderstatus") == "F").cast("int").alias("rc"))
    return J.batch_outcome(items, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "o_custkey")


@query("script_totals", with_views("takes_v") + """SELECT script_id, count(*) AS takes, count(*) FILTER (take_type IN ('habla', 'informativo')) AS voice,
  count(*) FILTER (take_type NOT IN ('habla', 'informativo')) AS support, CAST(sum(len(string_split('Toma ' || idx || CASE WHEN own_scene THEN ' final' ELSE '' END, ' '))) AS BIGINT) AS words,
  round(sum(round_even(frames / 24.0::DOUBLE * 1e6, 0) / 1e6), 6) AS seconds FROM takes_v GROUP BY script_id""")
def script_totals(spark, d):
    t = takes(spark, d).withColumn("content", F.concat(F.lit("Toma "), F.col("idx").cast("string"), F.when(F.col("own_scene"), " final").otherwise("")))
    t = t.withColumn("seconds", F.rint(F.col("frames") / 24 * 1e6) / 1e6)
    return C.plan_totals(t).withColumn("seconds", F.round("seconds", 6))


@query("voice_gate", with_views("takes_v") + """SELECT *, CASE WHEN voice = 0 THEN 'no_voice' WHEN voice * 2 < takes THEN 'mostly_silent' ELSE 'measure' END AS gate
  FROM (SELECT script_id, count(*) AS takes, count(*) FILTER (take_type IN ('habla', 'informativo')) AS voice FROM takes_v GROUP BY script_id)""")
def voice_gate(spark, d):
    return C.voice_gate(takes(spark, d), ["script_id"])


_FP = with_views("takes_v", extra="""e AS (SELECT script_id, idx, anchor_source, sha256('{"ambience":"sala","anchor_source":' || coalesce(CAST(anchor_source AS VARCHAR), 'null')
    || ',"content":"Toma ' || idx || '","fps":24,"frames":' || frames || ',"height":736,"idx":' || idx || ',"mode":' || coalesce('"ancla:' || anchor_source || '"', '"inicio"')
    || ',"model_id":"stack-1","music":"ninguna","name":"obra","record":"TOMA","scene":"plató","seed":' || (100 + idx) || ',"steps":20,"take_type":"' || take_type || '","width":416}') AS fingerprint FROM takes_v)""")


def effective(spark, d):
    t = takes(spark, d).withColumn("own_frames", F.col("frames").cast("bigint")).withColumn(
        "mode", F.when(F.col("anchor_source").isNull(), "inicio").otherwise(F.concat(F.lit("ancla:"), F.col("anchor_source").cast("string"))))
    for name, value in (("record", "TOMA"), ("scene", "plató"), ("ambience", "sala"), ("music", "ninguna")):
        t = t.withColumn(name, F.lit(value))
    t = t.withColumn("content", F.concat(F.lit("Toma "), F.col("idx").cast("string")))
    return C.effective_takes(t, 192, 416, 736, 20, 24, 100, "stack-1", F.lit("obra"))


@query("take_fingerprints", _FP + "SELECT script_id, idx, fingerprint FROM e")
def take_fingerprints(spark, d):
    return effective(spark, d).select("script_id", "idx", "fingerprint")


@query("chained_fingerprints", _FP + """SELECT t.script_id, t.idx, CASE WHEN a.idx IS NOT NULL THEN sha256('{"anchor_sha256":"' || a.fingerprint || '","shot":"' || t.fingerprint || '"}')
  ELSE sha256('{"shot":"' || t.fingerprint || '"}') END AS chained FROM e t LEFT JOIN e a ON a.script_id = t.script_id AND a.idx = t.anchor_source""")
def chained_fingerprints(spark, d):
    e = effective(spark, d).withColumn("idx", F.col("idx").cast("bigint"))
    joined = J.resolve_anchors(e, ["script_id"], bring=("fingerprint",))
    return joined.select("script_id", F.col("idx").cast("int").alias("idx"),
                         chained_fingerprint(F.col("fingerprint"), F.col("anchor_fingerprint")).alias("chained"))


@query("run_fingerprint", _FP + """, a AS (SELECT script_id, (idx - 1) // 4096 AS b, sha256(string_agg(fingerprint, chr(10) ORDER BY idx)) AS h FROM e GROUP BY ALL),
  c AS (SELECT script_id, b // 4096 AS b, sha256(string_agg(h, chr(10) ORDER BY a.b)) AS h FROM a GROUP BY script_id, a.b // 4096)
  SELECT script_id, sha256(string_agg(h, chr(10) ORDER BY b)) AS run_fingerprint FROM c GROUP BY script_id""")
def run_fingerprint_q(spark, d):
    return C.plan_fingerprints(effective(spark, d))


_BODY_SQL = "CASE take_type " + " ".join(
    f"WHEN {S.lit(k)} THEN " + " || ".join(x for x in (
        S.lit(p) if i % 2 == 0 else {"scene": "'plató'", "content": "content"}[p]
        for i, p in enumerate(__import__("re").split(r"\{(\w+)\}", v))) if x != "''")
    for k, v in K.PROMPT_BODIES.items()) + " END"


@query("render_prompt", with_views("takes_v", extra="t AS (SELECT *, 'Toma ' || idx AS content FROM takes_v)") + f"""SELECT script_id, idx,
  'detailed_description:' || chr(10) || 'The target video is in realistic photographic style. [Shot 1] ' || {_BODY_SQL} || chr(10) || chr(10)
  || 'overall_soundscape:' || chr(10) || 'sala' || chr(10) || chr(10) || 'non_diegetic_music:' || chr(10) || 'ninguna' AS prompt FROM t""")
def render_prompt(spark, d):
    return takes(spark, d).select("script_id", "idx", P.render_prompt(
        F.col("take_type"), F.lit("plató"), F.concat(F.lit("Toma "), F.col("idx").cast("string")), F.lit("sala"), F.lit("ninguna")).alias("prompt"))


@query("check_clips", with_views("takes_v", extra="""c AS (SELECT script_id, idx, frames * 1000 AS bytes, 416 AS width, CASE WHEN own_scene THEN 736 ELSE 640 END AS height, take_type <> 'detalle' AS has_audio,
    frames + CASE WHEN take_type = 'habla' THEN 1 ELSE 0 END AS frames, 24.0::DOUBLE + idx / 200.0::DOUBLE AS fps, frames / 24.0::DOUBLE + idx / 40.0::DOUBLE AS duration FROM takes_v WHERE frames <> 396),
  b AS (SELECT t.script_id, t.idx, t.frames AS fe, c.* EXCLUDE (script_id, idx), c.idx IS NULL AS gone FROM takes_v t LEFT JOIN c USING (script_id, idx))""") +
       """SELECT script_id, idx, unnest(list_filter([CASE WHEN gone THEN 'missing_clip' END, CASE WHEN bytes < 100000 THEN 'too_small' END, CASE WHEN height <> 736 THEN 'height' END,
  CASE WHEN NOT has_audio THEN 'no_audio' END, CASE WHEN frames <> fe THEN 'frame_count' END, CASE WHEN abs(fps - 24) > 0.01 THEN 'frame_rate' END,
  CASE WHEN abs(duration - fe / 24.0::DOUBLE) > 0.05 THEN 'duration' END], lambda x: x IS NOT NULL)) AS issue FROM b""")
def check_clips(spark, d):
    t = takes(spark, d)
    f, i = F.col("frames"), F.col("idx")
    clips = t.filter(f != 396).select(
        "script_id", "idx", (f * 1000).alias("bytes"), F.lit(416).alias("width"), F.when(F.col("own_scene"), 736).otherwise(640).alias("height"),
        (F.col("take_type") != "detalle").alias("has_audio"), (f / 24 + i / F.lit(40.0)).alias("duration"),
        (f + F.when(F.col("take_type") == "habla", 1).otherwise(0)).alias("frames"), (24.0 + i / F.lit(200.0)).alias("fps"))
    expected = t.select("script_id", "idx", F.lit(416).alias("width_exp"), F.lit(736).alias("height_exp"), f.alias("frames_exp"), F.lit(24.0).alias("fps_exp"))
    return V.check_clips(clips, expected, ["script_id", "idx"], 100000)


@query("accept_deliveries", """WITH d AS (SELECT o_custkey AS batch, 'dia-' || o_shippable || '-416x736-reel' AS name, o_shippable AS story, o_totalprice, o_orderstatus, o_orderpriority
    FROM (SELECT *, o_orderpriority || '-' || o_orderstatus AS o_shippable FROM orders)),
  r AS (SELECT batch, name, story, CAST(o_totalprice AS BIGINT) AS bytes, o_totalprice - 1500 AS duration, CASE WHEN o_orderstatus = 'P' THEN 720 ELSE 1080 END AS width, o_orderstatus <> 'F' AS has_audio,
    CASE WHEN o_orderpriority LIKE '1%' THEN NULL ELSE -20 + o_totalprice / 40000 END AS lufs FROM d)
  SELECT batch, name, unnest(list_filter([CASE WHEN NOT has_audio THEN 'no_audio' END, CASE WHEN duration <= 0 THEN 'no_duration' END, CASE WHEN bytes < 10000 THEN 'too_small' END,
    CASE WHEN width <> 1080 THEN 'size' END, CASE WHEN lufs IS NULL THEN 'loudness_unknown' END, CASE WHEN abs(lufs + 14) > 2 THEN 'loudness' END], lambda x: x IS NOT NULL)) AS issue FROM r
  UNION ALL SELECT batch, '', 'too_few' FROM r GROUP BY batch HAVING count(*) < 5
  UNION ALL SELECT batch, name, 'duplicate_name' FROM r GROUP BY ALL HAVING count(*) > 1
  UNION ALL SELECT batch, story, 'duplicate_story' FROM r GROUP BY ALL HAVING count(*) > 1""")
def accept_deliveries(spark, d):
    story = F.concat("o_orderpriority", F.lit("-"), "o_orderstatus")
    p = F.col("o_totalprice")
    rows = table(spark, d, "orders").select(
        F.col("o_custkey").alias("batch"), F.concat(F.lit("dia-"), story, F.lit("-416x736-reel")).alias("name"), story.alias("story"),
        F.rint(p).cast("bigint").alias("bytes"), (p - 1500).alias("duration"), F.when(F.col("o_orderstatus") == "P", 720).otherwise(1080).alias("width"),
        F.lit(1920).alias("height"), (F.col("o_orderstatus") != "F").alias("has_audio"),
        F.when(~F.col("o_orderpriority").startswith("1"), -20 + p / 40000).alias("lufs"))
    return V.accept_deliveries(rows, "batch", 5)
