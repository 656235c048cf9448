"""Queries over per-clip time series."""
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import numeric as N
from ..operators import series as R
from ..operators.ordered import medians, numbered, top_per_group
from ..views import documents, series, table, with_views
from .registry import query

GAP_HOURS = 12.0


@query("entropy_events", """SELECT event_type, CAST(sum(c) AS BIGINT) AS n,
  round(-sum((c / n) * log2(c / n)), 6) AS entropy
  FROM (SELECT event_type, v, c, sum(c) OVER (PARTITION BY event_type)::DOUBLE AS n
    FROM (SELECT event_type, floor(value) AS v, count(*)::DOUBLE AS c FROM events GROUP BY 1, 2)) GROUP BY event_type""")
def entropy_events(spark, d):
    e = table(spark, d, "events").select("event_type", F.floor("value").alias("v"))
    return R.entropy(e, ["event_type"], "v").withColumn("entropy", F.round("entropy", 6))


@query("entropy_characters", r"""SELECT lang, CAST(sum(c) AS BIGINT) AS n, round(-sum((c / n) * log2(c / n)), 6) AS entropy
  FROM (SELECT lang, ch, c, sum(c) OVER (PARTITION BY lang)::DOUBLE AS n FROM
    (SELECT lang, ch, count(*)::DOUBLE AS c FROM (SELECT lang, unnest(regexp_extract_all(text, '\p{L}')) AS ch FROM documents)
     GROUP BY 1, 2)) GROUP BY lang""")
def entropy_characters(spark, d):
    c = documents(spark, d).select("lang", F.explode(
        F.regexp_extract_all("text", F.lit(r"\p{L}"), F.lit(0))).alias("ch"))
    return R.entropy(c, ["lang"], "ch").withColumn("entropy", F.round("entropy", 6))


@query("medians", """SELECT user_id, CAST(len(s) AS BIGINT) AS n, s[(len(s) + 1) // 2] AS median_low, s[len(s) // 2 + 1] AS median_high
  FROM (SELECT user_id, list_sort(list(value)) AS s FROM events GROUP BY user_id)""")
def medians_q(spark, d):
    return medians(table(spark, d, "events"), ["user_id"], "value")


_THRESHOLD = """th AS (SELECT clip_id, CAST(count(*) AS BIGINT) AS n, list_sort(list(v))[count(*) // 2 + 1] AS median,
  max(v) AS peak, list_sort(list(v))[count(*) // 2 + 1] + greatest(4 * stddev_pop(v), 10) AS threshold,
  stddev_pop(v) AS deviation FROM series_v GROUP BY clip_id)"""


@query("spike_threshold", with_views("series_v", extra=_THRESHOLD) +
       """SELECT clip_id, n, median, round(deviation, 6) AS deviation, peak, round(threshold, 6) AS threshold FROM th""")
def spike_threshold(spark, d):
    return (R.spike_threshold(series(spark, d), ["clip_id"]).drop("mean_square")
            .withColumn("deviation", F.round("deviation", 6)).withColumn("threshold", F.round("threshold", 6)))


_SPIKES = _THRESHOLD + f""", sp AS (SELECT clip_id, round_even(s.t * 100, 0) / 100 AS t, round_even(s.v * 10, 0) / 10 AS v
    FROM series_v s JOIN th USING (clip_id) WHERE s.v > th.threshold),
  g AS (SELECT *, sum(CASE WHEN p IS NULL OR t - p > {GAP_HOURS} THEN 1 ELSE 0 END)
      OVER (PARTITION BY clip_id ORDER BY t, v ROWS UNBOUNDED PRECEDING) AS group_no
    FROM (SELECT *, lag(t) OVER (PARTITION BY clip_id ORDER BY t, v) AS p FROM sp)),
  grp AS (SELECT clip_id, CAST(group_no AS BIGINT) AS group_no, min(t) AS start, max(v) AS spike, count(*) AS n_rows
    FROM g GROUP BY clip_id, group_no)"""


@query("spike_groups", with_views("series_v", extra=_SPIKES) + "SELECT * FROM grp")
def spike_groups(spark, d):
    s = series(spark, d)
    return R.spike_groups(s, R.spike_threshold(s, ["clip_id"]), ["clip_id"], gap=GAP_HOURS)


@query("spot_report", with_views("series_v", extra=_SPIKES) +
       """SELECT clip_id, n, median, round(threshold, 6) AS threshold, peak, CAST(coalesce(sr, 0) AS BIGINT) AS spike_rows,
  CAST(coalesce(k, 0) AS BIGINT) AS spots, CASE coalesce(k, 0) WHEN 0 THEN 'LIMPIO' WHEN 1 THEN 'MANCHA AISLADA' ELSE 'ABERRACIONES' END AS verdict
  FROM th LEFT JOIN (SELECT clip_id, count(*) AS k, sum(n_rows) AS sr FROM grp GROUP BY clip_id) USING (clip_id)""")
def spot_report(spark, d):
    return R.spot_report(series(spark, d), ["clip_id"], GAP_HOURS).drop("mean_square").withColumn("threshold", F.round("threshold", 6))


@query("first_spike_groups", with_views("series_v", extra=_SPIKES) +
       "SELECT clip_id, group_no, start, spike FROM grp WHERE group_no <= 10")
def first_spike_groups(spark, d):
    s = series(spark, d)
    g = R.spike_groups(s, R.spike_threshold(s, ["clip_id"]), ["clip_id"], gap=GAP_HOURS)
    return R.first_per_group(g, ["clip_id"], ["group_no"], 10).select("clip_id", "group_no", "start", "spike")


_LEVELS = f"""lv AS (SELECT clip_id, t, event_id, 20 * log10(v) AS level_db, CASE WHEN r > 0
      THEN round_even((20 * log10(r) - 22) * 10, 0) / 10 ELSE {K.SILENCE_WITHOUT_RMS_DB} END AS threshold_db
    FROM (SELECT *, sqrt(avg(v * v) OVER (PARTITION BY clip_id)) AS r FROM series_v)),
  fl AS (SELECT clip_id, t, event_id, level_db < threshold_db AS under, lead(t) OVER (PARTITION BY clip_id ORDER BY t, event_id) AS nt FROM lv),
  rn AS (SELECT *, sum(CASE WHEN under AND NOT coalesce(pu, false) THEN 1 ELSE 0 END)
      OVER (PARTITION BY clip_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS run
    FROM (SELECT *, lag(under) OVER (PARTITION BY clip_id ORDER BY t, event_id) AS pu FROM fl)),
  si AS (SELECT clip_id, CAST(run AS BIGINT) AS run, min(t) AS t0, max(coalesce(nt, t)) AS t1 FROM rn WHERE under
    GROUP BY clip_id, run HAVING max(coalesce(nt, t)) - min(t) >= 0.8)"""


def _silences(spark, d):
    s = series(spark, d)
    levels = R.silence_levels(s, ["clip_id"])
    return levels, R.silences(s.join(levels, "clip_id").withColumn("level_db", R.level_of(F.col("v"))), ["clip_id"], ties=("event_id",))


@query("silences", with_views("series_v", extra=_LEVELS) + "SELECT clip_id, run, round(t0, 6) AS t0, round(t1, 6) AS t1 FROM si")
def silences(spark, d):
    return _silences(spark, d)[1].withColumn("t0", F.round("t0", 6)).withColumn("t1", F.round("t1", 6))


@query("speech_coverage", with_views("series_v", extra=_LEVELS) + """, c AS (SELECT clip_id, max(t) AS duration FROM series_v GROUP BY clip_id),
  a AS (SELECT c.clip_id, duration, coalesce(sum(t1 - t0), 0.0) AS silent, coalesce(max(t1 - t0), 0.0) AS longest, count(t0) AS n_silences
    FROM c LEFT JOIN si USING (clip_id) GROUP BY ALL),
  f AS (SELECT clip_id, string_agg(printf('%.2f-%.2f', t0, t1), ' ' ORDER BY t0) AS first_silences
    FROM (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY t0) AS k FROM si) WHERE k <= 12 GROUP BY clip_id)
  SELECT clip_id, round(duration, 6) AS duration, round(silent, 6) AS silent, round(longest, 6) AS longest, n_silences,
    coalesce(first_silences, '') AS first_silences, round(100 * (duration - silent) / duration, 6) AS coverage,
    CASE WHEN 100 * (duration - silent) / duration < 40 THEN 'MUDO' WHEN longest > 12.0 THEN 'CORTADO'
      WHEN 100 * (duration - silent) / duration > 97 THEN 'ATROPELLADO' ELSE 'OK' END AS verdict
  FROM a LEFT JOIN f USING (clip_id)""")
def speech_coverage(spark, d):
    clips, found = _silences(spark, d)
    out = R.coverage(found, clips, ["clip_id"], longest_allowed=12.0)
    return out.select("clip_id", *[F.round(c, 6).alias(c) for c in ("duration", "silent", "longest", "coverage")],
                      "n_silences", "first_silences", "verdict")


_DRIFT = """p AS (SELECT clip_id, v, v * v AS edges, row_number() OVER (PARTITION BY clip_id ORDER BY t, event_id) AS i,
    count(*) OVER (PARTITION BY clip_id) AS n FROM series_v),
  q AS (SELECT *, greatest(2, n // 3) AS k FROM p WHERE n >= 6),
  m AS (SELECT clip_id, list_sort(list(v) FILTER (i <= k)) AS a, list_sort(list(v) FILTER (i > n - k)) AS b,
    list_sort(list(edges) FILTER (i <= k)) AS ea, list_sort(list(edges) FILTER (i > n - k)) AS eb FROM q GROUP BY clip_id),
  dr AS (SELECT clip_id, 100 * (b[len(b) // 2 + 1] - a[len(a) // 2 + 1]) / a[len(a) // 2 + 1] AS tone_pct,
    100 * (eb[len(eb) // 2 + 1] - ea[len(ea) // 2 + 1]) / ea[len(ea) // 2 + 1] AS edges_pct FROM m)"""


@query("drift", with_views("series_v", extra=_DRIFT) + """SELECT clip_id, round(tone_pct, 6) AS tone_pct, round(edges_pct, 6) AS edges_pct,
  CASE WHEN greatest(abs(tone_pct), abs(edges_pct)) < 5 THEN 'ESTABLE' WHEN greatest(abs(tone_pct), abs(edges_pct)) < 12 THEN 'DERIVA LEVE' ELSE 'DERIVA' END AS verdict FROM dr""")
def drift(spark, d):
    s = series(spark, d).withColumn("edges", F.col("v") * F.col("v"))
    return (R.drift_report(s, ["clip_id"], ["t", "event_id"], "v", "edges")
            .withColumn("tone_pct", F.round("tone_pct", 6)).withColumn("edges_pct", F.round("edges_pct", 6)))


_SHOTS = """sh AS (SELECT user_id AS clip_id, event_id AS shot, value AS edge_first, value * (1 + (event_id % 40) / 100.0::DOUBLE) AS edge_last,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE 5 + value / 100 END AS entropy_first,
    CASE WHEN event_id % 19 = 0 THEN NULL ELSE 70 + event_id % 31 END::DOUBLE AS score FROM events),
  lk AS (SELECT *, first_value(edge_first) OVER w AS ref, lead(edge_first) OVER w AS ne, lead(entropy_first) OVER w AS nn, lead(score) OVER w AS ns,
    lead(shot) OVER w AS to_shot FROM sh WINDOW w AS (PARTITION BY clip_id ORDER BY shot)),
  ln AS (SELECT clip_id, shot AS from_shot, to_shot, 100 * (edge_last - ref) / ref AS excess_pct, 100 * (ne - edge_last) / edge_last AS edge_jump_pct,
    100 * (nn - entropy_first) / entropy_first AS entropy_jump_pct,
    CASE WHEN coalesce(ns < 85, false) THEN 'REGENERAR' WHEN 100 * (edge_last - ref) / ref <= 5 THEN 'OK'
      WHEN 100 * (edge_last - ref) / ref <= 20 THEN 'REANCLAR' ELSE 'REGENERAR' END AS verdict FROM lk WHERE to_shot IS NOT NULL)"""


def _shots(spark, d):
    e = table(spark, d, "events")
    return e.select(
        F.col("user_id").alias("clip_id"), F.col("event_id").alias("shot"), F.col("value").alias("edge_first"),
        (F.col("value") * (1 + (F.col("event_id") % 40) / 100.0)).alias("edge_last"),
        F.when(F.col("event_id") % 17 != 0, 5 + F.col("value") / 100).alias("entropy_first"),
        F.when(F.col("event_id") % 19 != 0, 70 + F.col("event_id") % 31).cast("double").alias("score"))


@query("chain_links", "WITH " + _SHOTS + """ SELECT clip_id, from_shot, to_shot, round(excess_pct, 6) AS excess_pct, round(edge_jump_pct, 6) AS edge_jump_pct,
  round(entropy_jump_pct, 6) AS entropy_jump_pct, verdict FROM ln""")
def chain_links(spark, d):
    links = R.chain_links(_shots(spark, d), ["clip_id"], ["shot"], zero_is_missing=False)
    return links.select("clip_id", "from_shot", "to_shot", "verdict",
                        *[N.round_scaled(c, 6).alias(c) for c in ("excess_pct", "edge_jump_pct", "entropy_jump_pct")])


@query("chain_summary", "WITH " + _SHOTS + """, w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY excess_pct DESC, from_shot) AS k
    FROM ln WHERE verdict <> 'OK') WHERE k = 1),
  s AS (SELECT clip_id, avg(score) AS mean_score, min(score) AS worst_score FROM sh GROUP BY clip_id)
  SELECT s.clip_id, round(mean_score, 6) AS mean_score, worst_score, w.from_shot AS worst_from, round(w.excess_pct, 6) AS worst_excess,
    coalesce(w.verdict, 'NINGUNA') AS action FROM s LEFT JOIN w USING (clip_id)""")
def chain_summary(spark, d):
    shots = _shots(spark, d)
    out = R.chain_summary(R.chain_links(shots, ["clip_id"], ["shot"], zero_is_missing=False), shots, ["clip_id"])
    return out.withColumn("mean_score", N.round_scaled("mean_score", 6)).withColumn("worst_excess", N.round_scaled("worst_excess", 6))


@query("noise_grade", """SELECT user_id, event_type, round(db, 6) AS rms_db, round(greatest(0, least(10, (-22 - db) / 10 * 10)), 6) AS grade, db <= -30 AS clean
  FROM (SELECT user_id, event_type, 20 * log10(sqrt(avg((value / 2000) * (value / 2000)))) AS db FROM events GROUP BY 1, 2)""")
def noise_grade(spark, d):
    e = table(spark, d, "events").withColumn("v", F.col("value") / 2000)
    return (R.rms_level(e, ["user_id", "event_type"]).withColumn("rms_db", F.round("rms_db", 6))
            .withColumn("grade", F.round("grade", 6)))


@query("link_verdict", """SELECT event_id, CASE WHEN s < 85 THEN 'REGENERAR' WHEN x <= 5 THEN 'OK' WHEN x <= 20 THEN 'REANCLAR' ELSE 'REGENERAR' END AS link,
  CASE WHEN cov < 40 THEN 'MUDO' WHEN x > 3.0 THEN 'CORTADO' WHEN cov > 97 THEN 'ATROPELLADO' ELSE 'OK' END AS speech,
  CASE WHEN x < 6 AND value < 8 THEN 'NEGRO' WHEN x < 12 THEN 'CASI NEGRO' ELSE 'CON OBJETOS' END AS background
  FROM (SELECT event_id, value, value / 10 AS x, 80 + event_id % 20 AS s, 30 + event_id % 71 AS cov FROM events)""")
def link_verdict(spark, d):
    x, e = F.col("value") / 10, F.col("event_id")
    return table(spark, d, "events").select(
        "event_id", R.link_verdict(x, 80 + e % 20).alias("link"), R.coverage_verdict(30 + e % 71, x).alias("speech"),
        R.background_verdict(x, F.col("value")).alias("background"))


_SCORE = """sm AS (SELECT user_id AS clip_id, event_id, 5 + value / 400 AS entropy, 10 + value / 60 AS edges,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE 1 + value / 500 END AS chroma, value / 300 AS grain,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE -40 + value / 25 END AS floor_db, CASE WHEN event_id % 7 = 0 THEN 1 + value / 100 END AS jump_ratio
    FROM events),
  ag AS (SELECT clip_id, count(entropy) AS ne, arg_min(entropy, event_id) AS e0, arg_max(entropy, event_id) AS e1,
    arg_min(edges, event_id) AS b0, arg_max(edges, event_id) AS b1,
    arg_min(chroma, event_id) FILTER (chroma IS NOT NULL) AS c0, arg_max(chroma, event_id) FILTER (chroma IS NOT NULL) AS c1,
    arg_min(grain, event_id) AS g0, max(grain) AS gm, count(floor_db) AS nf, min(floor_db) AS f0, max(floor_db) AS f1, max(jump_ratio) AS j
    FROM sm GROUP BY clip_id HAVING count(entropy) >= 4),
  d AS (SELECT *, abs(e1 - e0) / abs(e0) AS de, abs(b1 - b0) / abs(b0) AS db, abs(c1 - c0) / abs(c0) AS dc,
    greatest(0, (gm - greatest(g0, 0.35)) / greatest(g0, 0.35)) AS dg FROM ag),
  pt AS (SELECT clip_id,
    CASE WHEN de <= 0.03 THEN 25 WHEN de >= 0.20 THEN 0 ELSE 25 * (1 - (de - 0.03) / (0.20 - 0.03)) END::DOUBLE AS gradation,
    CASE WHEN db <= 0.05 THEN 20 WHEN db >= 0.40 THEN 0 ELSE 20 * (1 - (db - 0.05) / (0.40 - 0.05)) END::DOUBLE AS structure,
    CASE WHEN gm <= 0.35 THEN 20 WHEN dg <= 0.10 THEN 20 WHEN dg >= 0.80 THEN 0 ELSE 20 * (1 - (dg - 0.10) / 0.70) END::DOUBLE AS grain,
    CASE WHEN dc <= 0.10 THEN 10 WHEN dc >= 0.50 THEN 0 ELSE 10 * (1 - (dc - 0.10) / (0.50 - 0.10)) END::DOUBLE AS chroma,
    CASE WHEN nf < 4 THEN 0 ELSE CASE WHEN f0 <= -34 THEN 10 WHEN f0 >= -18 THEN 0 ELSE 10 * (-18 - f0) / 16 END
      + CASE WHEN f1 - f0 <= 7 THEN 5 WHEN f1 - f0 >= 16 THEN 0 ELSE 5 * (1 - (f1 - f0 - 7) / 9) END END::DOUBLE AS audio,
    CASE WHEN j IS NULL THEN 10 WHEN j <= 1.3 THEN 10 WHEN j >= 4 THEN 0 ELSE 10 * (1 - (j - 1.3) / 2.7) END::DOUBLE AS transitions FROM d)"""


@query("quality_score", "WITH " + _SCORE + """ SELECT clip_id, round(gradation, 6) AS gradation, round(structure, 6) AS structure, round(grain, 6) AS grain,
  round(chroma, 6) AS chroma, round(audio, 6) AS audio, round(transitions, 6) AS transitions,
  round(gradation + structure + grain + chroma + audio + transitions, 6) AS total FROM pt""")
def quality_score(spark, d):
    e, v = F.col("event_id"), F.col("value")
    samples = table(spark, d, "events").select(
        F.col("user_id").alias("clip_id"), "event_id", (5 + v / 400).alias("entropy"), (10 + v / 60).alias("edges"),
        F.when(e % 13 != 0, 1 + v / 500).alias("chroma"), (v / 300).alias("grain"),
        F.when(e % 3 != 0, -40 + v / 25).alias("floor_db"), F.when(e % 7 == 0, 1 + v / 100).alias("jump_ratio"))
    out = R.quality_score(samples, ["clip_id"], "event_id")
    return out.select("clip_id", *[F.round(c, 6).alias(c) for c in out.columns if c != "clip_id"])


@query("two_sided_score", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN q = 0 THEN 0 WHEN d <= 0.05 THEN 20 WHEN d >= 0.40 THEN 0
  ELSE round(20 * (1 - (d - 0.05) / (0.40 - 0.05)), 6) END::DOUBLE AS points
  FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS q, abs(l_linenumber * 6 - l_quantity) / abs(l_quantity) AS d FROM lineitem)""")
def two_sided_score(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(N.two_sided_score("l_quantity", F.col("l_linenumber") * 6, 0.05, 0.40, 20.0), 6).alias("points"))


@query("compare_formats", f"""WITH series_v AS (SELECT user_id AS clip_id, event_id, event_type,
    (epoch_us(ts) - 1704067200000000) / 3.6e9 AS t, value AS v FROM events),
  th AS (SELECT event_type, clip_id, count(*) AS n, list_sort(list(v))[count(*) // 2 + 1] + greatest(4 * stddev_pop(v), 10) AS threshold
    FROM series_v GROUP BY ALL),
  sp AS (SELECT event_type, clip_id, round_even(s.t * 100, 0) / 100 AS t, round_even(s.v * 10, 0) / 10 AS v
    FROM series_v s JOIN th USING (event_type, clip_id) WHERE s.v > th.threshold),
  g AS (SELECT event_type, clip_id, sum(CASE WHEN p IS NULL OR t - p > {GAP_HOURS} THEN 1 ELSE 0 END) AS spots
    FROM (SELECT *, lag(t) OVER (PARTITION BY event_type, clip_id ORDER BY t, v) AS p FROM sp) GROUP BY ALL),
  p AS (SELECT event_type, clip_id, v, v * v AS edges, row_number() OVER (PARTITION BY event_type, clip_id ORDER BY t) AS i,
    count(*) OVER (PARTITION BY event_type, clip_id) AS n FROM series_v),
  q AS (SELECT *, greatest(2, n // 3) AS k FROM p WHERE n >= 6),
  m AS (SELECT event_type, clip_id, list_sort(list(v) FILTER (i <= k)) AS a, list_sort(list(v) FILTER (i > n - k)) AS b,
    list_sort(list(edges) FILTER (i <= k)) AS ea, list_sort(list(edges) FILTER (i > n - k)) AS eb FROM q GROUP BY ALL),
  dr AS (SELECT event_type, avg(100 * (b[len(b) // 2 + 1] - a[len(a) // 2 + 1]) / a[len(a) // 2 + 1]) AS tone_pct,
    avg(100 * (eb[len(eb) // 2 + 1] - ea[len(ea) // 2 + 1]) / ea[len(ea) // 2 + 1]) AS edges_pct FROM m GROUP BY event_type),
  no AS (SELECT event_type, 20 * log10(sqrt(avg(v * v))) AS rms_db FROM series_v GROUP BY event_type)
  SELECT th.event_type, count(*) AS clips, CAST(sum(th.n) AS BIGINT) AS n_rows, CAST(sum(coalesce(g.spots, 0)) AS BIGINT) AS spots,
    round(any_value(tone_pct), 4) AS tone_pct, round(any_value(edges_pct), 4) AS edges_pct, round(any_value(rms_db), 6) AS rms_db,
    any_value(CASE WHEN greatest(abs(tone_pct), abs(edges_pct)) < 5 THEN 'ESTABLE' WHEN greatest(abs(tone_pct), abs(edges_pct)) < 12 THEN 'DERIVA LEVE' ELSE 'DERIVA' END) AS verdict
  FROM th LEFT JOIN g USING (event_type, clip_id) LEFT JOIN dr USING (event_type) JOIN no USING (event_type) GROUP BY th.event_type""")
def compare_formats(spark, d):
    out = R.compare_formats(series(spark, d), "event_type", ["clip_id"], GAP_HOURS)
    return (out.withColumn("tone_pct", F.round("tone_pct", 4)).withColumn("edges_pct", F.round("edges_pct", 4))
            .withColumn("rms_db", F.round("rms_db", 6)))


@query("latest_per_key", """SELECT user_id, event_id, CAST(k AS INT) AS rank FROM (SELECT user_id, event_id,
  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k <= 3""")
def latest_per_key(spark, d):
    e = table(spark, d, "events")
    return top_per_group(e, ["user_id"], [F.desc("ts"), F.desc("event_id")], 3).select("user_id", "event_id", "rank")


@query("best_so_far", """WITH a AS (SELECT user_id, event_id, value, max(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS best FROM events),
  f AS (SELECT user_id, min(event_id) FILTER (best >= 150) AS stop FROM a GROUP BY user_id)
  SELECT user_id, count(*) AS attempts, max(value) AS best, arg_max(event_id, value) AS best_attempt, CAST(any_value(stop) AS BIGINT) AS goal_attempt
  FROM (SELECT a.user_id, a.event_id, a.value, f.stop FROM a JOIN f USING (user_id) WHERE f.stop IS NULL OR a.event_id <= f.stop) GROUP BY user_id""")
def best_so_far(spark, d):
    from ..operators.capacity import best_so_far as op
    return op(table(spark, d, "events"), ["user_id"], "event_id", "value", 150.0)
