"""Batch twins of the streaming jobs, and frame measures over derived pictures."""
from pyspark.sql import functions as F

from ..operators import frames as P
from ..streaming import jobs as J
from ..views import micros_since_2024, series, table, with_views
from .registry import query


@query("memory_alerts", """WITH s AS (SELECT event_type AS device, event_id AS seq, 2400 - value * 20 AS free, user_id % 2 = 0 AS own FROM events),
  l AS (SELECT *, coalesce(lag(free < 1200 AND NOT own) OVER (PARTITION BY device ORDER BY seq), false) AS opened FROM s)
  SELECT * FROM (SELECT device, seq, free, CASE WHEN free < 1200 AND own THEN 'act' WHEN free < 1200 AND NOT own AND NOT opened THEN 'warn' WHEN free >= 1200 AND opened THEN 'recovered' END AS alert FROM l) WHERE alert IS NOT NULL""")
def memory_alerts(spark, d):
    return J.alerts(samples(spark, d), ["device"], ["seq"])


def samples(spark, d):
    return table(spark, d, "events").select(F.col("event_type").alias("device"), F.col("event_id").alias("seq"),
                                            (2400 - F.col("value") * 20).alias("free"), (F.col("user_id") % 2 == 0).alias("own"))


_UPDATES = """u AS (SELECT user_id AS name, event_id AS seq, CASE event_type WHEN 'view' THEN 'planned' WHEN 'error' THEN 'failed' WHEN 'click' THEN 'waiting_resources' ELSE 'generating' END AS phase,
    CASE WHEN value < 30 THEN event_type || '!' END AS message, CASE WHEN event_type = 'purchase' THEN 'out-' || event_id END AS final,
    CASE WHEN value > 20 THEN CAST(floor(value) AS BIGINT) END AS completed, CASE WHEN event_type = 'view' THEN 500::BIGINT END AS total FROM events)"""


def updates(spark, d):
    t, v = F.col("event_type"), F.col("value")
    return table(spark, d, "events").select(
        F.col("user_id").alias("name"), F.col("event_id").alias("seq"), F.when(t == "view", "planned").when(t == "error", "failed").when(t == "click", "waiting_resources").otherwise("generating").alias("phase"),
        F.when(v < 30, F.concat(t, F.lit("!"))).alias("message"), F.when(t == "purchase", F.concat(F.lit("out-"), F.col("event_id").cast("string"))).alias("final"),
        F.when(v > 20, F.floor(v)).alias("completed"), F.when(t == "view", F.lit(500).cast("bigint")).alias("total"))


@query("job_states", "WITH " + _UPDATES + """, p AS (SELECT name, max(seq) FILTER (phase = 'planned') AS pl FROM u GROUP BY name)
  SELECT name, max(seq) AS seq, arg_max(phase, seq) AS phase, arg_max(message, seq) FILTER (message IS NOT NULL AND (pl IS NULL OR seq >= pl)) AS message,
    arg_max(final, seq) FILTER (final IS NOT NULL AND (pl IS NULL OR seq >= pl)) AS final, arg_max(completed, seq) FILTER (completed IS NOT NULL) AS completed,
    arg_max(total, seq) FILTER (total IS NOT NULL) AS total FROM u JOIN p USING (name) GROUP BY name""")
def job_states(spark, d):
    return J.latest_states(updates(spark, d))


@query("visible_phase", "WITH " + _UPDATES + """, s AS (SELECT name, arg_max(phase, seq) AS phase FROM u GROUP BY name)
  SELECT name, CASE WHEN phase IN ('planned', 'waiting_resources', 'generating', 'mounting') AND NOT coalesce(c_acctbal > 0, false) THEN 'interrupted' ELSE phase END AS phase FROM s LEFT JOIN customer ON c_custkey = name""")
def visible_phase(spark, d):
    owners = table(spark, d, "customer").select(F.col("c_custkey").alias("name"), (F.col("c_acctbal") > 0).alias("alive"))
    s = J.latest_states(updates(spark, d)).select("name", "phase").join(owners, "name", "left")
    return J.visible_phase(s, "alive").select("name", "phase")


@query("usage_windows", """SELECT event_type, (epoch_us(time_bucket(INTERVAL 6 HOUR, ts)) - 1704067200000000) // 3600000000 AS start_hour, min(value) AS low, max(value) AS high, count(*) AS samples
  FROM events GROUP BY ALL""")
def usage_windows(spark, d):
    w = J.usage_windows(table(spark, d, "events"), ["event_type"], width="6 hours")
    return w.select("event_type", F.floor(micros_since_2024("start") / 3_600_000_000).alias("start_hour"), "low", "high", "samples")


@query("spike_sessions", """WITH l AS (SELECT user_id, ts, value, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events WHERE value > 60),
  g AS (SELECT *, sum(CASE WHEN p IS NULL OR ts >= p + INTERVAL 12 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM l)
  SELECT user_id, epoch_us(min(ts)) - 1704067200000000 AS start_us, max(value) AS peak, count(*) AS spikes FROM g GROUP BY user_id, s""")
def spike_sessions(spark, d):
    s = table(spark, d, "events").filter("value > 60").select("user_id", micros_since_2024("ts").alias("t"), "value")
    return J.spike_session_report(s, ["user_id"], gap=12 * 3_600_000_000).withColumnRenamed("start", "start_us")


@query("progress_eta", """WITH e AS (SELECT user_id, event_id // 10 AS elapsed, CAST(floor(value) AS BIGINT) AS done FROM events),
  a AS (SELECT user_id, max(elapsed) - min(elapsed) AS elapsed, max(done) AS done, 600::BIGINT AS total, max(done) - min(done) AS fresh FROM e GROUP BY user_id)
  SELECT user_id, elapsed, done, total, CASE WHEN fresh > 0 THEN CAST(floor(elapsed * (total - done) / fresh) AS BIGINT) END AS eta_seconds FROM a""")
def progress_eta(spark, d):
    e = table(spark, d, "events").select("user_id", F.floor(F.col("event_id") / 10).alias("elapsed"), F.floor("value").alias("done"), F.lit(600).cast("bigint").alias("total"))
    return J.progress_eta(e, ["user_id"], "elapsed", "done", "total")


_PIX = "px AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(greatest(0, least(255, floor((x::DOUBLE + 0.5) * 255))) AS INT)) AS p FROM embeddings)"


def pictures(spark, d):
    """Each vector as an 8×8 picture."""
    level = lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor((x.cast("double") + 0.5) * 255)))
    data = F.unhex(F.array_join(F.transform("embedding", lambda x: F.lpad(F.hex(level(x).cast("bigint")), 2, "0")), ""))
    return table(spark, d, "embeddings").select("vec_id", "label", F.lit(8).alias("height"), F.lit(8).alias("width"),
                                                F.lit(1).alias("nChannels"), data.alias("data"))


def colour_pictures(spark, d):
    """The same pictures with three planes: the levels, the levels from the end, and their complement."""
    grey = pictures(spark, d).withColumn("hex", F.hex("data"))
    plane = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.concat(
        F.substring("hex", 2 * i + 1, F.lit(2)), F.substring("hex", 127 - 2 * i, F.lit(2)),
        F.lpad(F.hex(255 - F.conv(F.substring("hex", 2 * i + 1, F.lit(2)), 16, 10).cast("bigint")), 2, "0")))
    return grey.select("vec_id", "label", "height", "width", F.lit(3).alias("nChannels"), F.unhex(F.array_join(plane, "")).alias("data"))


def _around(plane: str, row: str, col: str) -> str:
    """A pixel of an 8×8 list by row and column; outside of the picture the nearest one."""
    return f"{plane}[CAST(8 * greatest(0, least(7, {row})) + greatest(0, least(7, {col})) + 1 AS INT)]"


def _blur_sql(plane: str, sigma: float) -> str:
    k = [float(x) for x in P.kernel(sigma)]
    r = len(k) // 2
    total = lambda src, row, col: "(" + " + ".join(f"{w!r}::DOUBLE * {_around(src, row(d), col(d))}" for d, w in zip(range(-r, r + 1), k)) + ")"
    down = f"list_transform(range(0, 64), lambda i: {total(plane, lambda d: f'i // 8 + {d}', lambda d: 'i % 8')})"
    return f"list_transform([{down}], lambda q: list_transform(range(0, 64), lambda i: {total('q', lambda d: 'i // 8', lambda d: f'i % 8 + {d}')}))[1]"


def _edges_sql(plane: str) -> str:
    at = lambda y, x: _around(plane, f"i // 8 + {y}", f"i % 8 + {x}")
    dx = " + ".join(f"{w} * ({at(y, 1)} - {at(y, -1)})" for y, w in ((-1, 1), (0, 2), (1, 1)))
    dy = " + ".join(f"{w} * ({at(1, x)} - {at(-1, x)})" for x, w in ((-1, 1), (0, 2), (1, 1)))
    return f"list_avg(list_transform(range(0, 64), lambda i: least(255, sqrt(pow({dx}, 2) + pow({dy}, 2)))))"


_PLANES = "list_transform(range(1, 65), lambda i: p[i]::DOUBLE)", "list_transform(range(1, 65), lambda i: p[65 - i]::DOUBLE)", \
    "list_transform(range(1, 65), lambda i: 255.0::DOUBLE - p[i])"


@query("frame_metrics", f"""WITH {_PIX}, b AS (SELECT vec_id, {_PLANES[0]} AS b, {_PLANES[1]} AS g, {_PLANES[2]} AS r FROM px),
  y AS MATERIALIZED (SELECT *, list_transform(range(1, 65), lambda i: (114 * b[i] + 587 * g[i] + 299 * r[i]) / 1000) AS y FROM b),
  s AS MATERIALIZED (SELECT *, {_blur_sql("y", 0.9)} AS soft, {_blur_sql("y", 1.3)} AS y2, {_blur_sql("b", 1.3)} AS b2, {_blur_sql("g", 1.3)} AS g2,
    {_blur_sql("r", 1.3)} AS r2 FROM y),
  e AS MATERIALIZED (SELECT *, {_edges_sql("y2")} AS ey, {_edges_sql("b2")} AS eb, {_edges_sql("g2")} AS eg, {_edges_sql("r2")} AS er FROM s),
  h AS (SELECT vec_id, -sum(n / 64.0::DOUBLE * log2(n / 64.0::DOUBLE)) AS entropy FROM (
    SELECT vec_id, v, count(*) AS n FROM (SELECT vec_id, unnest(list_transform(soft, lambda x: round_even(x, 0))) AS v FROM s) GROUP BY vec_id, v) GROUP BY vec_id)
  SELECT vec_id, round(entropy, 6) + 0.0 AS entropy, round(list_avg(list_transform(range(1, 65), lambda i: abs(y[i] - soft[i]))), 6) AS grain, round(ey, 6) AS edges,
    round(greatest(eb, eg, er) - least(eb, eg, er), 6) AS chroma,
    list_max(list_transform(range(1, 65), lambda i: greatest(b[i], g[i], r[i]) - least(b[i], g[i], r[i]))) AS saturation_max,
    round(list_avg(y), 9) AS luminance_mean, round((y[1] + y[8] + y[57] + y[64]) / 4, 6) AS corner_mean, 0.0::DOUBLE AS corner_deviation,
    round(greatest(y[1], y[8], y[57], y[64]), 6) AS corner_peak FROM e JOIN h USING (vec_id)""")
def frame_metrics(spark, d):
    m = P.frame_metrics(colour_pictures(spark, d), ["vec_id"])
    return m.select("vec_id", *[F.round(c, 9 if c == "luminance_mean" else 6).alias(c) for c in m.columns if c != "vec_id"])


@query("frame_levels", f"""WITH {_PIX} SELECT vec_id, round(list_sum(p) / 64.0::DOUBLE, 6) AS luminance_mean, round((p[1] + p[8] + p[57] + p[64]) / 4.0::DOUBLE, 6) AS corner_mean,
  greatest(p[1], p[8], p[57], p[64])::DOUBLE AS corner_peak, 0.0::DOUBLE AS saturation_max FROM px""")
def frame_levels(spark, d):
    m = P.frame_metrics(pictures(spark, d), ["vec_id"])
    return m.select("vec_id", F.round("luminance_mean", 6).alias("luminance_mean"), F.round("corner_mean", 6).alias("corner_mean"),
                    F.round("corner_peak", 6).alias("corner_peak"), "saturation_max")


@query("frame_hash", f"""WITH {_PIX} SELECT vec_id, sha256(unhex('28382C20382C2031290075696E743800' || array_to_string(list_transform(p, lambda x: printf('%02X', x)), ''))) AS frame_hash FROM px""")
def frame_hash(spark, d):
    return P.frame_hash(pictures(spark, d)).select("vec_id", "frame_hash")


@query("background", f"""WITH {_PIX}, c AS (SELECT label, vec_id, (p[1] + p[8] + p[57] + p[64]) / 4.0::DOUBLE AS mean, greatest(p[1], p[8], p[57], p[64])::DOUBLE AS peak FROM px)
  SELECT label, round(avg(mean), 6) AS mean, 0.0::DOUBLE AS deviation, max(peak) AS peak, CASE WHEN avg(mean) < 8 THEN 'NEGRO' ELSE 'CASI NEGRO' END AS verdict FROM c GROUP BY label""")
def background(spark, d):
    from ..operators.series import background_report
    m = P.frame_metrics(pictures(spark, d), ["vec_id", "label"]).select(
        "label", F.col("corner_mean").alias("mean"), F.col("corner_deviation").alias("deviation"), F.col("corner_peak").alias("peak"))
    return background_report(m, ["label"]).withColumn("mean", F.round("mean", 6)).withColumn("deviation", F.round("deviation", 6))


@query("jump_ratios", f"""WITH {_PIX}, j AS (SELECT label, vec_id AS joint FROM px WHERE label = 0),
  m AS (SELECT a, b, list_sum(list_transform(range(1, 65), lambda i: abs(p[i] - q[i]))) / 64.0::DOUBLE AS diff FROM (
    SELECT a.vec_id AS a, b.vec_id AS b, a.p, b.p AS q FROM px a JOIN px b ON b.vec_id = a.vec_id + 1
    UNION ALL SELECT a.vec_id, b.vec_id, a.p, b.p FROM px a JOIN px b ON b.vec_id = a.vec_id + 2))
  SELECT joint, round(x.diff, 6) AS at_joint, round(y.diff, 6) AS nearby, round(x.diff / y.diff, 6) AS jump_ratio FROM j JOIN m x ON x.a = joint - 1 AND x.b = joint JOIN m y ON y.a = joint + 3 AND y.b = joint + 5 WHERE x.diff > 0 AND y.diff > 0""")
def jump_ratios(spark, d):
    p = pictures(spark, d).select(F.lit("all").alias("clip"), F.col("vec_id").alias("frame"), "data", "label")
    r = P.jump_ratios(p, ["clip"], "frame", p.filter("label = 0").select("clip", "frame"), 3)
    return r.select("joint", *[F.round(c, 6).alias(c) for c in ("at_joint", "nearby", "jump_ratio")])
