"""Queries over document folds, search and grounding."""
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as X
from ..operators import folds, search
from ..operators.ordered import top_per_group
from ..views import SQL, documents, news, table, with_views
from . import sqltext as S
from .registry import query
from .text import _PACK_SQL


@query("novelty_filter", f"""WITH RECURSIVE s AS (SELECT doc_id, generate_subscripts(s, 1) AS idx, unnest(s) AS sentence
    FROM (SELECT doc_id, {S.sentences('text')} AS s FROM documents)),
  w AS MATERIALIZED (SELECT doc_id, idx, {S.content_set('sentence')} AS st FROM s),
  f AS (SELECT doc_id, 0::BIGINT AS idx, CAST([] AS VARCHAR[]) AS said, 0 AS fresh, 0.0::DOUBLE AS repeated, false AS skip FROM documents
    UNION ALL SELECT doc_id, idx, CASE WHEN skip THEN said ELSE list_distinct(list_concat(said, st)) END, fresh, repeated, skip FROM (
      SELECT *, len(st) > 0 AND (fresh < 3 OR repeated >= 0.55) AS skip FROM (
        SELECT w.doc_id, w.idx, f.said, w.st, CAST(len(list_filter(w.st, lambda x: NOT list_contains(f.said, x))) AS INT) AS fresh,
          CASE WHEN (CASE WHEN len(f.said) > 0 THEN least(len(w.st), len(f.said)) ELSE len(w.st) END) > 0
            THEN (len(w.st) - len(list_filter(w.st, lambda x: NOT list_contains(f.said, x)))) / (CASE WHEN len(f.said) > 0 THEN least(len(w.st), len(f.said)) ELSE len(w.st) END)::DOUBLE ELSE 0.0 END AS repeated
        FROM f JOIN w ON w.doc_id = f.doc_id AND w.idx = f.idx + 1)))
  SELECT doc_id, CAST(idx AS INT) AS idx, fresh, round(repeated, 6) AS repeated, skip FROM f WHERE idx > 0""")
def novelty_filter(spark, d):
    out = folds.novelty_filter(documents(spark, d), "doc_id", "text")
    return out.select("doc_id", "idx", "fresh", F.round("repeated", 6).alias("repeated"), "skip")


@query("plan_units")
def plan_units(spark, d):
    return folds.plan_units(folds.plan_news(news(spark, d)))


@query("plan_warnings")
def plan_warnings(spark, d):
    return folds.plan_warnings(folds.plan_news(news(spark, d)))


@query("plan_one_take")
def plan_one_take(spark, d):
    return folds.plan_units(folds.plan_one_take(news(spark, d)), "doc_id", "format.width", "format.height")


@query("news_issues", f"""WITH {SQL['news']}, c AS (SELECT doc_id, {S.squish(S.without_tags("headline"))} AS h, {S.squish(S.without_tags("body"))} AS b FROM news)
  SELECT doc_id, issue FROM (SELECT doc_id, unnest([CASE WHEN h = '' THEN 'no headline' END, CASE WHEN length(h) > {K.HEADLINE_MAX} THEN 'headline too long' END,
    CASE WHEN length(b) > {K.BODY_MAX} THEN 'body too long' END]) AS issue FROM c) WHERE issue IS NOT NULL""")
def news_issues(spark, d):
    """Ampersands are escaped first, so the SQL need not resolve references."""
    return folds.news_issues(news(spark, d).withColumns({c: F.replace(c, F.lit("&"), F.lit("&amp;")) for c in ("headline", "body")}))


@query("repeated_prefix", f"""WITH c AS (SELECT conv_id, turn, {S.tokens('text')} AS t FROM conversations),
  p AS (SELECT *, ' ' || array_to_string(lag(t) OVER (PARTITION BY conv_id ORDER BY turn), ' ') || ' ' || array_to_string(t[3:], ' ') || ' ' || array_to_string(t[1:8], ' ') || ' ' AS said FROM c)
  SELECT conv_id, turn, CAST(coalesce(list_max(list_filter(range(5, len(t) + 1), lambda k: contains(said, ' ' || array_to_string(t[1:k], ' ') || ' '))), 0) AS INT) AS repeated
  FROM p WHERE said IS NOT NULL""")
def repeated_prefix(spark, d):
    from ..operators.ordered import ordered
    c = table(spark, d, "conversations").select("conv_id", "turn", X.tokens("text").alias("t"))
    p = ordered(c, ["conv_id"], ["turn"], lag={"before": "t"}).filter("before is not null")
    said = F.concat(F.lit(" "), F.array_join("before", " "), F.lit(" "), F.array_join(F.slice("t", 3, 2147483647), " "), F.lit(" "),
                    F.array_join(F.slice("t", 1, 8), " "), F.lit(" "))
    p = p.withColumn("said", said)
    return p.select("conv_id", "turn", X.repeated_prefix(F.col("t"), F.col("said")).cast("int").alias("repeated"))


_TOPICS = "tp AS (SELECT item_id AS topic_id, text || ' doc ' || item_id * 7 AS topic FROM benchmark)"


@query("topic_search", f"""WITH {_TOPICS}, q AS (SELECT topic_id, {S.search_tokens('topic')} AS q, replace({S.fold('topic')}, ' ', '-') AS dashed FROM tp),
  n AS (SELECT 'doc-' || doc_id AS id, {S.search_tokens("'doc ' || doc_id || ' ' || lang || ' ' || text")} AS h FROM documents),
  s AS (SELECT topic_id, id, CAST(len(list_intersect(q, h)) + CASE WHEN contains(dashed, id) THEN 2 ELSE 0 END AS BIGINT) AS score FROM q, n)
  SELECT topic_id, id, score, CAST(k AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY score DESC, id) AS k FROM s WHERE score > 0) WHERE k <= 3""")
def topic_search(spark, d):
    topics = table(spark, d, "benchmark").select(
        F.col("item_id").alias("topic_id"), F.concat("text", F.lit(" doc "), (F.col("item_id") * 7).cast("string")).alias("topic"))
    docs = documents(spark, d).select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("id"),
        F.concat_ws(" ", F.lit("doc"), F.col("doc_id").cast("string"), "lang", "text").alias("haystack"))
    return search.topic_search(topics, docs, k=3)


@query("ungrounded_units", _PACK_SQL + f""", src AS (SELECT doc_id, lower({S.squish("headline || ' ' || body")}) AS plain FROM (SELECT doc_id, split_part(text, chr(10), 1) AS headline,
    replace(substr(text, length(split_part(text, chr(10), 1)) + 2), 'ation', 'atjon') AS body FROM documents WHERE lang <> 'es')),
  sn AS (SELECT doc_id, unit_idx, unnest({S.sentences('text')}) AS sentence FROM u),
  c AS (SELECT *, regexp_replace(trim({S.squish('lower(sentence)')}, ' '), '[.!?…]+$', '') AS core FROM sn)
  SELECT c.doc_id, unit_idx, sentence, CASE WHEN plain IS NULL THEN 'missing_source' ELSE 'not_in_source' END AS reason
  FROM c LEFT JOIN src ON src.doc_id = c.doc_id WHERE core <> '' AND (plain IS NULL OR NOT contains(plain, core))""")
def ungrounded_units(spark, d):
    units = folds.packed_units(documents(spark, d), "doc_id", "text", 8.0)
    src = news(spark, d).filter("lang <> 'es'").select("doc_id", "headline", F.replace("body", F.lit("ation"), F.lit("atjon")).alias("body"))
    return search.ungrounded(units, src, ["doc_id"], ["unit_idx"], squished=True)


@query("log_tail", r"""WITH l AS (SELECT conv_id, turn, generate_subscripts(a, 1) AS i, unnest(a) AS line FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS a FROM conversations)),
  k AS (SELECT conv_id, turn, i, rtrim(line) AS line, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, i DESC) AS r FROM l
    WHERE trim(line) <> '' AND NOT starts_with(ltrim(line), '|') AND NOT contains(line, '###'))
  SELECT conv_id, turn, CAST(i AS INT) AS pos, line, CAST(r AS INT) AS rank FROM k WHERE r <= 10""")
def log_tail(spark, d):
    from ..sources.readers import log_tail as op
    lines = table(spark, d, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("p", "line"))
    return op(lines.select("conv_id", "turn", (F.col("p") + 1).alias("pos"), "line"), ["conv_id"], ["turn", "pos"], 10)
