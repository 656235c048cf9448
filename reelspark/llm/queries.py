"""The named queries over the dealt operators, with SQL where it can express them."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, classifier, decontaminate, fim, hardneg, html, jaccard, licenses, lm, quality, substrings, tokencount, toxicity
from .common import fold

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    coded = bpe.decode(bpe.encode(docs, path), path)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@query("op5_bpe_round_trip")
def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which ids does the tokenizer give every document, and does decoding return the text?"""
    return token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


_FOLDED_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query("op1_contaminated_documents", rf"""
WITH d AS (SELECT doc_id, {_FOLDED_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_FOLDED_WORDS} AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS win
    FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
    FROM d, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n),
found AS (SELECT p.doc_id, p.s, p.n, wins.item_id
    FROM (SELECT doc_id, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS win FROM places) p JOIN wins USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""")
def op1_contaminated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents repeat ten consecutive words of a test item, and how much of them?"""
    found = decontaminate.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0), lambda n, s: n + s.end - s.start)
    return found.select("doc_id", "n_words", n_hit.cast("long").alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many unigram tokens has every document?"""
    return tokencount.count(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents pass the rules and look like trusted text?"""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    trusted = labels.filter("quality = 1").select("doc_id")
    return quality.judge(docs, trusted)


@query("op9_license_scan")
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which licences does every document name, and where?"""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    base = F.filter("detections", lambda d: d.base)
    kept = F.filter("detections", lambda d: d.base | d.kept)
    names = lambda some: F.array_join(F.array_sort(F.array_distinct(F.transform(some, lambda d: d.label))), ",")
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda d: d.start)).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda d: d.start)).cast("long").alias("last_word"),
        names(base).alias("base_labels"), names(kept).alias("labels"),
        F.coalesce(F.array_max(F.transform(kept, lambda d: d.certainty)), F.lit(0.0)).alias("score"))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How toxic is every document?"""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                                              "score", "predicted")


@query("op4_substring_dedup")
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages that stand elsewhere?"""
    return substrings.dedup(table(spark, sf_dir, "documents"))


_BLANK_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""


@query("op6_jaccard_components", rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_BLANK_WORDS} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + 4), ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
reach AS (SELECT a AS doc_id, a AS seen FROM links UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.seen),
low AS (SELECT doc_id, min(seen) AS low FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(low, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)""")
def op6_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents are near copies of each other, over any number of steps?"""
    return jaccard.join(table(spark, sf_dir, "documents"))


@query("op3_lm_scores")
def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How likely is every document under a model of the others?"""
    return lm.score(table(spark, sf_dir, "documents"))


@query("op8_main_text")
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is the main text of every page?"""
    return html.main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query("op11_hard_negatives", """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label,
        CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
    FROM p JOIN s USING (anchor_id) WHERE label <> anchor_label
        AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows of other labels come close to every anchor's positives?"""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


_UNITS = "regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]')"


@query("op12_fill_in_middle", rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, text, {_UNITS} AS u, CAST(('0x' || h[1:8]) AS BIGINT) AS h1, CAST(('0x' || h[9:16]) AS BIGINT) AS h2,
    CAST(('0x' || h[17:24]) AS BIGINT) AS h3, CAST(('0x' || h[25:32]) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
        WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, text, n, form, array_to_string(list_slice(u, 1, a), '') AS prefix, array_to_string(list_slice(u, a + 1, b), '') AS middle,
    array_to_string(list_slice(u, b + 1, n), '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM p""")
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How is every document cut and rearranged, and does the inverse return it?"""
    made = fim.restore(fim.transform(table(spark, sf_dir, "documents")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


@query("op13_quality_scores")
def op13_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How good is every document?"""
    docs = table(spark, sf_dir, "documents")
    model = classifier.train(docs, table(spark, sf_dir, "labels"))
    return classifier.score(docs, model).select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
                                                "score", "predicted")
