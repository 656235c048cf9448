"""Quality rules: plain counts of a text, and a log-likelihood ratio between trusted and raw text.

Both corpora are multinomials over hashed n-grams (two neighbouring word endings). A text's ratio is the mean over its n-grams of log(p_trusted / p_raw), so it
does not grow with its length; one fixed threshold decides every text. The raw counts cover every row, the trusted
counts every row with a trusted key; keys meet texts in an equi join. Counts are whole numbers and one array of
`buckets` weights leaves them, so the same tables always give the same verdicts. Column expressions only.

Defined cases: a null or empty text has no words and fails; without n-grams the ratio is 0; without
trusted rows every ratio is 0; keys may be null (never trusted) or repeat; other columns are not read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.functions.text import let, once

BLANKS = " \t\n\x0b\x0c\r"
BUCKETS = 1 << 15
#: A token is a word's ending of so many characters: case, inflection and punctuation runs, not the topic.
ENDING = 3
#: Mean log ratio below which a text is not like trusted text.
THRESHOLD = -0.2
SMOOTHING = 1.0


def words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[ \t-\r]+"))


def grams(word: Column, buckets: int) -> Column:
    """Buckets of all pairs of neighbouring word endings."""
    def ending(x: Column) -> Column:
        return F.substring(x, -ENDING, ENDING)
    fewer = F.greatest(F.size(word) - 1, F.lit(0))
    return F.zip_with(F.slice(word, 1, fewer), F.slice(word, 2, fewer),
                      lambda a, b: F.pmod(F.xxhash64(ending(a), ending(b)), F.lit(buckets)).cast("int"))


def repeated_words(word: Column) -> Column:
    """Words in windows of five that stand twice or more in the text."""
    def covered(w: Column) -> Column:
        """Exact, by text: windows in order, those equal to a neighbour, then the words that they cover."""
        placed = F.sort_array(F.transform(spots_of(w), lambda i: F.struct(
            F.array_join(F.slice(w, i + 1, 5), " ").alias("s"), i.alias("i"))))
        again = let(placed, lambda p: F.filter(F.transform(p, lambda x, j: F.when(
            ((j > 0) & (p[F.greatest(j - 1, F.lit(0))].s == x.s)) | ((j < F.size(p) - 1) & (p[F.least(j + 1, F.size(p) - 1)].s == x.s)),
            x.i)), lambda i: i.isNotNull()))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
        return F.aggregate(F.sort_array(again), start, lambda acc, i: F.struct(
            (acc.n + 5 + i - F.greatest(i, acc.end)).alias("n"), (i + 5).alias("end")), lambda acc: acc.n)

    def spots_of(w: Column) -> Column:
        return F.sequence(F.lit(0), F.size(w) - 5)

    def hashed(h: Column) -> Column:
        return F.transform(spots_of(h), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(5)]))

    hashes = let(F.transform(word, lambda x: F.xxhash64(x)), hashed)
    some = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))      # equal windows have equal hashes
    return F.when(F.size(word) <= 5, F.lit(0).cast("long")).when(some, covered(word)).otherwise(F.lit(0).cast("long"))


def counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    body = F.col("text")
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    rows = once(rows, words=words(body))
    return rows.select(
        F.col("key").alias(key), "words", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"))


def weights(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """One row: an array with log(p_trusted / p_raw) of every bucket."""
    chosen = trusted.select(F.col(key).alias("trusted_key")).filter("trusted_key is not null").distinct()
    packed = "array<smallint>" if buckets <= 1 << 15 else "array<int>"
    rows = once(docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")), words=words(F.col("text")))
    rows = rows.select("key", grams(F.col("words"), buckets).cast(packed).alias("grams"))
    # Only keys and packed grams are shuffled, and by one plan however many trusted keys there are.
    marked = rows.join(chosen.hint("merge"), F.col("key") == F.col("trusted_key"), "left")
    seen = (marked.select(F.col("trusted_key").isNotNull().cast("long").alias("own"), F.explode("grams").alias("bucket"))
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("own").alias("own")))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    listed = (every.join(seen.withColumn("bucket", F.col("bucket").cast("int")), "bucket", "left")
              .select("bucket", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("raw", "own")])
              .agg(F.array_sort(F.collect_list(F.struct("bucket", "raw", "own"))).alias("counts"),                  # one entry per bucket
                   F.sum("raw").alias("all_raw"), F.sum("own").alias("all_own")))

    def log_share(n: Column, total: Column) -> Column:
        return F.log((n + SMOOTHING) / (total + SMOOTHING * buckets))

    weight = F.transform("counts", lambda c: log_share(c["own"], F.col("all_own")) - log_share(c["raw"], F.col("all_raw")))
    return listed.select(F.when(F.col("all_own") > 0, weight).otherwise(F.array_repeat(F.lit(0.0), buckets)).alias("weights"))


def judge(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS,
          threshold: float = THRESHOLD) -> DataFrame:
    """(key, counts, base_failed, ratio, kept) of every row."""
    table = weights(docs, trusted, key, text, buckets)
    rows = once(counts(docs, key, text), grams=grams(F.col("words"), buckets)).withColumn("weights", table.scalar())
    total = F.aggregate("grams", F.lit(0.0), lambda acc, b: acc + F.col("weights")[b])
    rows = once(rows, ratio=F.when(F.size("grams") > 0, total / F.size("grams")).otherwise(F.lit(0.0)))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return rows.select(key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), (~failed & (F.col("ratio") >= threshold)).alias("kept"), "ratio")
