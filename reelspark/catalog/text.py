"""Queries over text columns."""
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import numeric as N
from ..functions import text as X
from ..operators import folds
from ..views import documents, news, table, with_views
from . import sqltext as S
from .registry import query


def _docs(spark, d):
    return documents(spark, d)


_PAGES = """(SELECT page_id, html || ' &#' || page_id || '; &#x' || page_id || 'F &#' || (120 + page_id % 50) || ' &Ntilde;&middot;&notit; &notin; &AMP &ampx &bogus; & &#; &NotEqualTilde;' AS html FROM pages)"""


@query("strip_html", S.clean_html(_PAGES, "page_id", "html"))
def strip_html(spark, d):
    """Pages with decimal, hexadecimal, named and bare references at their ends."""
    text = F.format_string("%s &#%d; &#x%dF &#%d &Ntilde;&middot;&notit; &notin; &AMP &ampx &bogus; & &#; &NotEqualTilde;",
                           "html", "page_id", "page_id", 120 + F.col("page_id") % 50)
    return table(spark, d, "pages").select("page_id", X.strip_html(text).alias("clean"))


@query("fold_accents", f"SELECT doc_id, md5({S.fold('text')}) AS folded_md5 FROM documents")
def fold_accents(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(X.fold_accents("text")).alias("folded_md5"))


@query("word_count", f"""SELECT lang, CAST(sum(len({S.words('text')})) AS BIGINT) AS n_words,
  CAST(max(len({S.words('text')})) AS BIGINT) AS longest FROM documents GROUP BY lang""")
def word_count(spark, d):
    n = X.word_count("text").cast("bigint")
    return _docs(spark, d).groupBy("lang").agg(F.sum(n).alias("n_words"), F.max(n).alias("longest"))


@query("sentences", f"""SELECT doc_id, CAST(generate_subscripts(s, 1) AS INT) AS idx, unnest(s) AS sentence
  FROM (SELECT doc_id, {S.sentences('text')} AS s FROM documents)""")
def sentences(spark, d):
    s = _docs(spark, d).select("doc_id", F.posexplode(X.sentences("text")).alias("pos", "sentence"))
    return s.select("doc_id", (F.col("pos") + 1).alias("idx"), "sentence")


@query("sentences_basic", f"""SELECT doc_id, CAST(len(s) AS INT) AS n, md5(array_to_string(s, '|')) AS joined_md5
  FROM (SELECT doc_id, {S.sentences('text', K.ABBREVIATIONS_BASIC, '.!?', False)} AS s FROM documents)""")
def sentences_basic(spark, d):
    s = X.sentences("text", K.ABBREVIATIONS_BASIC, ".!?", False)
    return _docs(spark, d).select("doc_id", s.alias("s")).select(
        "doc_id", F.size("s").alias("n"), F.md5(F.array_join("s", "|")).alias("joined_md5"))


@query("tokens", f"""SELECT token, count(*) AS n FROM (SELECT unnest({S.tokens('text')}) AS token FROM documents)
  GROUP BY token""")
def tokens(spark, d):
    return (_docs(spark, d).select(F.explode(X.tokens("text")).alias("token"))
            .groupBy("token").agg(F.count(F.lit(1)).alias("n")))


@query("stems", f"""SELECT {S.stem('token')} AS stem, count(*) AS n
  FROM (SELECT unnest({S.tokens('text')}) AS token FROM documents) GROUP BY 1""")
def stems(spark, d):
    t = _docs(spark, d).select(F.explode(X.tokens("text")).alias("token"))
    return t.groupBy(X.stem("token").alias("stem")).agg(F.count(F.lit(1)).alias("n"))


@query("content_set", f"""SELECT doc_id, CAST(len(s) AS INT) AS n_stems, md5(array_to_string(list_sort(s), ' ')) AS stems_md5
  FROM (SELECT doc_id, {S.content_set('text')} AS s FROM documents)""")
def content_set(spark, d):
    return _docs(spark, d).select("doc_id", F.array_sort(X.content_set("text")).alias("s")).select(
        "doc_id", F.size("s").alias("n_stems"), F.md5(F.array_join("s", " ")).alias("stems_md5"))


@query("has_verb", f"""SELECT lang, CAST(sum(CASE WHEN {S.has_verb('sentence')} THEN 1 ELSE 0 END) AS BIGINT) AS with_verb,
  count(*) AS n FROM (SELECT lang, unnest({S.sentences('text')}) AS sentence FROM documents) GROUP BY lang""")
def has_verb(spark, d):
    s = _docs(spark, d).select("lang", F.explode(X.sentences("text")).alias("sentence"))
    return s.groupBy("lang").agg(F.count_if(X.has_verb("sentence")).alias("with_verb"),
                                 F.count(F.lit(1)).alias("n"))


@query("close_sentence", f"""SELECT doc_id, idx, {S.close_sentence("sentence")} AS closed FROM (
  SELECT doc_id, CAST(generate_subscripts(s, 1) AS INT) AS idx, unnest(s) AS sentence FROM (SELECT doc_id, {S.sentences('text')} AS s FROM documents))""")
def close_sentence(spark, d):
    s = _docs(spark, d).select("doc_id", F.posexplode(X.sentences("text")).alias("pos", "sentence"))
    return s.select("doc_id", (F.col("pos") + 1).alias("idx"), X.close_sentence("sentence").alias("closed"))


_SHORTEN_SQL = f"""WITH s AS (SELECT doc_id, generate_subscripts(s, 1) AS idx, unnest(s) AS sentence
    FROM (SELECT doc_id, {S.sentences('text')} AS s FROM documents)),
  w AS (SELECT doc_id, idx, sentence, {S.words('sentence')} AS ws FROM s),
  f AS (SELECT *, list_transform(ws, lambda x: {S.fold('x')}) AS fd FROM w),
  cut AS (SELECT doc_id, idx, sentence, ws, CASE WHEN len(ws) <= 23 THEN len(ws) ELSE list_max(list_filter(range(9, 24), lambda n:
      regexp_matches(array_to_string(fd[n+1:n+3], ' ') || ' ', {S.lit('^(' + '|'.join(K.TAIL_MARKERS) + ') ')})
      AND NOT list_contains([{S.listing(K.FORBIDDEN_ENDINGS)}], trim(fd[n], '.,;:()'))
      AND {S.has_verb("array_to_string(ws[1:n], ' ')")}
      AND NOT (list_contains(['y', 'e', 'o'], fd[n+1]) AND (regexp_full_match(trim(fd[n], '.,;:()'), '[0-9.,%]+')
        OR len(list_filter(ws[n-2:n], lambda x: x LIKE '%,')) > 0)))) END AS n FROM f)
SELECT doc_id, CAST(idx AS INT) AS idx, CAST(n AS INT) AS kept_words,
  CASE WHEN n IS NOT NULL THEN {S.close_sentence("array_to_string(ws[1:n], ' ')")} END AS short FROM cut"""


@query("shorten", _SHORTEN_SQL)
def shorten(spark, d):
    s = _docs(spark, d).select("doc_id", F.posexplode(X.sentences("text")).alias("pos", "sentence"))
    s = s.select("doc_id", (F.col("pos") + 1).alias("idx"), X.shorten("sentence", 23, 9, squished=True).alias("short"))
    return s.select("doc_id", "idx", X.word_count("short").alias("n"), "short").select(
        "doc_id", "idx", F.when(F.col("short").isNotNull(), F.col("n")).alias("kept_words"), "short")


@query("speech_rate", f"""SELECT doc_id, round(r, 6) AS rate,
  CASE WHEN r > 3.0 THEN 'rushed' WHEN r < 1.6 THEN 'slack' ELSE 'ok' END AS band
  FROM (SELECT doc_id, len({S.words('text')}) / (1 + n_chars % 997)::DOUBLE AS r FROM documents)""")
def speech_rate(spark, d):
    r = _docs(spark, d).select("doc_id", X.word_count("text").alias("n"), "n_chars").select(
        "doc_id", (F.col("n") / (1 + F.col("n_chars") % 997)).alias("r"))
    return r.select("doc_id", F.round("r", 6).alias("rate"), N.rate_band("r").alias("band"))


@query("nearest_rung", f"""SELECT doc_id, {S.nearest_rung('secs')} AS frames, {S.nearest_rung('secs', 532)} AS frames_long
  FROM (SELECT doc_id, len({S.words('text')}) / 2.6::DOUBLE + 0.7 AS secs FROM documents)""")
def nearest_rung(spark, d):
    s = _docs(spark, d).select("doc_id", N.spoken_seconds(X.word_count("text")).alias("secs"))
    return s.select("doc_id", N.nearest_rung("secs").alias("frames"), N.nearest_rung("secs", 532).alias("frames_long"))


@query("one_take_format", f"""WITH w AS (SELECT doc_id, len({S.words('text')}) AS n FROM documents),
  f AS (SELECT doc_id, least(532, greatest(73, (CAST(floor((round_even((n / 2.6::DOUBLE + 0.7) * 24, 0) - 5) / 17) AS BIGINT) + 1) * 17 + 5)) AS frames FROM w),
  p AS (SELECT *, (12900.0::DOUBLE - 722.0 - 400.0) / (frames * (28.75::DOUBLE / (416 * 736))) AS px FROM f),
  h AS (SELECT *, CAST(floor(sqrt(px * 16 / 9) / 16) AS BIGINT) * 16 AS hh FROM p)
  SELECT doc_id, CAST(frames AS INT) AS frames,
    CAST(CASE WHEN px >= 416 * 736 THEN 416 ELSE greatest(16, CAST(floor(hh * 9 / 16.0::DOUBLE / 16) AS BIGINT) * 16) END AS INT) AS width,
    CAST(CASE WHEN px >= 416 * 736 THEN 736 ELSE greatest(16, hh) END AS INT) AS height FROM h""")
def one_take_format(spark, d):
    return _docs(spark, d).select("doc_id", N.one_take_format(X.word_count("text")).alias("f")).select(
        "doc_id", "f.frames", "f.width", "f.height")


@query("overlap_coeff", f"""SELECT doc_id, CAST(len(list_intersect(a, b)) AS INT) AS shared,
  CAST(len(list_filter(b, lambda x: NOT list_contains(a, x))) AS INT) AS fresh,
  CAST(len(list_distinct(list_concat(a, b))) AS INT) AS together,
  CASE WHEN least(len(a), len(b)) > 0 THEN round(len(list_intersect(a, b)) / least(len(a), len(b))::DOUBLE, 6) ELSE 0.0 END AS overlap
  FROM (SELECT doc_id, {S.content_set("split_part(text, chr(10), 1)")} AS a,
    {S.content_set("substr(text, length(split_part(text, chr(10), 1)) + 2)")} AS b FROM documents)""")
def overlap_coeff(spark, d):
    from ..operators.sets import overlap
    n = news(spark, d).select("doc_id", X.content_set("headline").alias("a"), X.content_set("body").alias("b"))
    return n.select("doc_id", F.size(F.array_intersect("a", "b")).alias("shared"),
                    F.size(F.array_except("b", "a")).alias("fresh"),
                    F.size(F.array_union("a", "b")).alias("together"),
                    F.round(overlap(F.col("a"), F.col("b")), 6).alias("overlap"))


@query("timestamp_hms", """SELECT event_id, printf('%02d:%02d:%02d.%03d', ms // 3600000, (ms // 60000) % 60, (ms // 1000) % 60, ms % 1000) AS stamp
  FROM (SELECT event_id, CAST(round_even(value * 37.5 * 1000, 0) AS BIGINT) AS ms FROM events)""")
def timestamp_hms(spark, d):
    return table(spark, d, "events").select("event_id", N.timestamp_hms(F.col("value") * 37.5).alias("stamp"))


@query("story_key", r"""WITH n AS (SELECT page_id, url, regexp_replace(url, '[^a-zA-Z0-9]+', '-', 'g') || CASE page_id % 4 WHEN 0 THEN '-416x736-32s'
    WHEN 1 THEN '-reel-1080x1920' WHEN 2 THEN '-1376x768-416x736-' ELSE '' END AS name FROM pages)
  SELECT page_id, CASE WHEN contains(name, '-416x') THEN split_part(name, '-416x', 1) WHEN contains(name, '-736x') THEN split_part(name, '-736x', 1)
    WHEN contains(name, '-1080x') THEN split_part(name, '-1080x', 1) WHEN contains(name, '-1376x') THEN split_part(name, '-1376x', 1) ELSE name END AS story FROM n""")
def story_key(spark, d):
    return _reel_names(spark, d).select("page_id", N.story_key("name").alias("story"))


def _reel_names(spark, d):
    slug = F.regexp_replace("url", "[^a-zA-Z0-9]+", "-")
    tail = (F.when(F.col("page_id") % 4 == 0, "-416x736-32s").when(F.col("page_id") % 4 == 1, "-reel-1080x1920")
            .when(F.col("page_id") % 4 == 2, "-1376x768-416x736-").otherwise(""))
    return table(spark, d, "pages").select("page_id", F.concat(slug, tail).alias("name"))


@query("name_dims", r"""SELECT page_id, TRY_CAST(regexp_extract(name, '-(\d+)x(\d+)-', 1) AS INT) AS width,
    TRY_CAST(regexp_extract(name, '-(\d+)x(\d+)-', 2) AS INT) AS height
  FROM (SELECT page_id, regexp_replace(url, '[^a-zA-Z0-9]+', '-', 'g') || CASE page_id % 4 WHEN 0 THEN '-416x736-32s'
    WHEN 1 THEN '-reel-1080x1920' WHEN 2 THEN '-1376x768-416x736-' ELSE '' END AS name FROM pages)""")
def name_dims(spark, d):
    return _reel_names(spark, d).select("page_id", N.name_dims("name").alias("s")).select(
        "page_id", "s.width", "s.height")


_PACK_SQL = f"""WITH RECURSIVE s AS (SELECT doc_id, generate_subscripts(s, 1) AS idx, unnest(s) AS sentence
    FROM (SELECT doc_id, {S.sentences('text')} AS s FROM documents)),
  w AS (SELECT doc_id, idx, sentence, len({S.words('sentence')}) AS n FROM s),
  p AS (SELECT doc_id, idx, 1 AS unit_idx, n AS filled, n, sentence FROM w WHERE idx = 1
    UNION ALL
    SELECT w.doc_id, w.idx, CASE WHEN p.filled + w.n > 20 THEN p.unit_idx + 1 ELSE p.unit_idx END,
      CASE WHEN p.filled + w.n > 20 THEN w.n ELSE p.filled + w.n END, w.n, w.sentence
    FROM p JOIN w ON w.doc_id = p.doc_id AND w.idx = p.idx + 1),
  u AS (SELECT doc_id, CAST(unit_idx AS INT) AS unit_idx, string_agg(sentence, ' ' ORDER BY idx) AS text,
    CAST(sum(n) AS INT) AS n_words FROM p GROUP BY doc_id, unit_idx)
"""


@query("pack_sentences", _PACK_SQL + "SELECT * FROM u")
def pack_sentences(spark, d):
    return folds.packed_units(_docs(spark, d), "doc_id", "text", 8.0)


@query("units_priced", _PACK_SQL + f"""SELECT doc_id, CAST(count(*) AS BIGINT) AS n_units, CAST(sum(n_words) AS BIGINT) AS n_words,
  CAST(sum(frames) AS BIGINT) AS frames, round(sum(frames) / 24.0::DOUBLE, 6) AS seconds FROM
  (SELECT doc_id, n_words, {S.nearest_rung('n_words / 2.6::DOUBLE + 0.7')} AS frames FROM u) GROUP BY doc_id""")
def units_priced(spark, d):
    """Flagship: every document's packed units with their predicted durations."""
    return folds.priced_documents(_docs(spark, d), "doc_id", "text", 8.0)


def _dropped(ws, tested, keep):
    """Words from the first one that is to be kept, by a test on the same or the folded words."""
    return f"list_slice({ws}, coalesce(list_position(list_transform({tested}, lambda w: {keep}), true), len({ws}) + 1), len({ws}))"


_LINK = f"list_contains([{S.listing(K.CONNECTIVES)}], trim(w, ',;:'))"
_FOLDED = f"string_split({S.fold("array_to_string(ws, ' ')")}, ' ')"


@query("prune_prefix", f"""WITH s AS (SELECT doc_id, CAST(generate_subscripts(s, 1) AS INT) AS idx, unnest(s) AS sentence FROM (SELECT doc_id, {S.sentences('text')} AS s FROM documents)),
  w AS (SELECT doc_id, idx, CAST(1 + idx % 3 AS INT) AS n, {S.words("'x ' || CASE WHEN idx % 2 = 0 THEN 'y , ' ELSE '' END || sentence")} AS ws FROM s),
  a AS (SELECT doc_id, idx, n, len(ws) AS total, list_slice(ws, n + 1, len(ws)) AS ws FROM w),
  b AS (SELECT * REPLACE ({_dropped('ws', _FOLDED, f'NOT {_LINK}')} AS ws) FROM a),
  c AS (SELECT * REPLACE ({_dropped('ws', 'ws', "trim(w, ',;:') <> ''")} AS ws) FROM b),
  t AS (SELECT *, regexp_replace(array_to_string(ws, ' '), '^[,;: ]+', '') AS t FROM c)
  SELECT doc_id, idx, CASE WHEN n < total AND len(ws) >= 5 AND {S.has_verb('t')} THEN {S.close_sentence("upper(substr(t, 1, 1)) || substr(t, 2)")} END AS pruned FROM t""")
def prune_prefix(spark, d):
    """What is left of every sentence without its first one to three words and a connective after them."""
    s = _docs(spark, d).select("doc_id", F.posexplode(X.sentences("text")).alias("pos", "sentence"))
    s = s.select("doc_id", (F.col("pos") + 1).alias("idx"), "sentence")
    unit = F.concat(F.lit("x "), F.when(F.col("idx") % 2 == 0, "y , ").otherwise(""), "sentence")
    return s.select("doc_id", "idx", X.prune_prefix(unit, (1 + F.col("idx") % 3).cast("int")).alias("pruned"))
