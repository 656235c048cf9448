"""Topic search over a catalogue, and literal grounding of extracted text."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..storage import written
from .ordered import top_per_group

ID_BONUS = 2


#: A word of more items than this is common: its items are looked at last, and only where they can still win.
COMMON_ITEMS = 1_000


class TopicIndex:
    """Words of the topics against the items that hold them, searched from rare words to common ones.

    `postings` holds each word that some topic uses with each of its items.  Rare words have short lists,
    so all items that share one with a topic are candidates.  Common words only count for candidates, by
    the sets of common words that topic and item hold, except where an item that shares nothing but
    common words could still be among the first `k`: with a k-th score of s, an item has to hold one of
    all but the s - 1 most common words of the topic, and only the lists of those are read.  Of the
    last word nothing but the first `k` items is needed, as items that share only one word tie.
    """

    def __init__(self, topics: DataFrame, catalogue: DataFrame, topic_id: str, topic: str, item_id: str, haystack: str, k: int,
                 common_items: int = COMMON_ITEMS):
        self.k = k
        self.topics = topics.select(F.col(topic_id).alias("topic"), F.col(topic).alias("text"))
        self.items = catalogue.select(F.col(item_id).alias("item"), F.col(haystack).alias("text"))
        wanted = self.topics.select("topic", F.explode(X.search_tokens("text")).alias("word"))
        self.postings = written(self.items.select("item", F.explode(X.search_tokens("text")).alias("word"))
                                .join(wanted.select("word").distinct(), "word", "left_semi"))
        lengths = self.postings.groupBy("word").agg(F.count(F.lit(1)).alias("items"))
        self.wanted = wanted.join(lengths, "word").withColumn("common", F.col("items") > common_items)
        common = lengths.filter(F.col("items") > common_items)
        self.common_postings = self.postings.join(common.select("word"), "word", "left_semi")
        # by topic its common words, rarest first; by item the same words as a set
        self.topic_common = self.wanted.filter("common").groupBy("topic").agg(
            F.array_sort(F.collect_list(F.struct("items", "word"))).alias("s")).select(
            "topic", F.transform("s", lambda x: x["word"]).alias("asked"))
        self.item_common = self.common_postings.groupBy("item").agg(F.collect_set("word").alias("held"))

    def named(self) -> DataFrame:
        """(topic, item): the topic's text holds the item's id, words joined by dashes."""
        # ids have at most as many lengths as the longest one has letters: one value, not a table
        lengths = self.items.filter(F.length("item") > 0).agg(F.array_sort(F.collect_set(F.length("item")))).scalar()
        dashed = F.replace(X.fold_accents("text"), F.lit(" "), F.lit("-"))
        asked = X.once(self.topics.filter(F.size(X.search_tokens("text")) > 0), dashed=dashed).withColumn("lengths", lengths)

        def stretches(n):
            starts = F.sequence(F.lit(1), F.greatest(F.length("dashed") - (n - 1), F.lit(1)))
            return F.when(F.length("dashed") >= n, F.transform(starts, lambda i: F.substr(F.col("dashed"), i, n))).otherwise(
                F.expr("cast(array() as array<string>)"))
        parts = asked.select("topic", F.explode(F.array_distinct(F.flatten(F.transform("lengths", stretches)))).alias("item"))
        return parts.join(self.items.select("item"), "item").select("topic", "item")

    def scored(self, pairs: DataFrame) -> DataFrame:
        """Adds the common words that topic and item share to the score of every pair (topic, item, score)."""
        shared = F.coalesce(F.size(F.array_intersect("asked", "held")), F.lit(0))
        return (pairs.join(self.item_common, "item", "left").join(self.topic_common, "topic", "left")
                .select("topic", "item", (F.col("score") + F.greatest(shared, F.lit(0))).alias("score")))

    def candidates(self) -> DataFrame:
        """(topic, item, score) of all items that share a rare word, are named, or come first under a common word."""
        wanted = self.wanted.select("topic", "word", "common")
        rare = (self.postings.join(wanted.filter("not common"), "word")
                .groupBy("topic", "item").agg(F.count(F.lit(1)).alias("score")))
        first = top_per_group(self.common_postings, ["word"], [F.asc("item")], self.k).select("word", "item")
        firsts = first.join(wanted.filter("common"), "word").select("topic", "item", F.lit(0).cast("bigint").alias("score"))
        named = self.named().select("topic", "item", F.lit(ID_BONUS).cast("bigint").alias("score"))
        pairs = rare.unionByName(firsts).unionByName(named).groupBy("topic", "item").agg(F.sum("score").alias("score"))
        return self.scored(pairs)

    def best(self, scores: DataFrame) -> DataFrame:
        return top_per_group(scores.filter("score > 0"), ["topic"], [F.desc("score"), F.asc("item")], self.k)

    def open_words(self, best: DataFrame) -> DataFrame:
        """(topic, word): common words whose lists may still hold an item that belongs to the first `k`."""
        kth = best.groupBy("topic").agg(F.max(F.when(F.col("rank") == self.k, F.col("score"))).alias("kth"))
        size = F.size("asked")
        upto = F.greatest(F.lit(0), F.least(size - 1, size - F.coalesce("kth", F.lit(0)) + 1)).cast("int")
        return (self.topic_common.join(kth, "topic", "left")
                .select("topic", F.explode(F.slice("asked", F.lit(1), upto)).alias("word")))

    def search(self) -> DataFrame:
        """(topic, item, score, rank)"""
        best = written(self.best(self.candidates()).select("topic", "item", "score", "rank"))
        more = (self.common_postings.join(self.open_words(best), "word").select("topic", "item").distinct()
                .withColumn("score", F.lit(0).cast("bigint")))
        # an item that is a candidate too has its full score there
        scores = best.drop("rank").unionByName(self.scored(more)).groupBy("topic", "item").agg(F.max("score").alias("score"))
        return self.best(scores)


def topic_search(topics: DataFrame, catalogue: DataFrame, topic_id: str = "topic_id", topic: str = "topic",
                 item_id: str = "id", haystack: str = "haystack", k: int = 1, common_items: int = COMMON_ITEMS) -> DataFrame:
    """Best items per topic by shared words, plus a bonus when the topic names the item.

    Ties go to the first id; a score of 0 is no match; ids of topics and items are unique.  Items named by
    a topic are found by an equi join: every stretch of the topic that is as long as some id.  See TopicIndex.
    """
    found = TopicIndex(topics, catalogue, topic_id, topic, item_id, haystack, k, common_items).search()
    return found.select(F.col("topic").alias(topic_id), F.col("item").alias(item_id), "score", "rank")


def ungrounded(units: DataFrame, sources: DataFrame, keys: list[str], unit_cols: list[str], text: str = "text",
               headline: str = "headline", body: str = "body", squished: bool = False) -> DataFrame:
    """Sentences of a unit that are not literally in its own source, or whose source is missing.

    Sentence by sentence: a unit may join sentences that were apart in the source.  squished says that
    words in units are separated by single blanks, as in packed ones.
    """
    plain = F.lower(X.squish(F.concat_ws(" ", headline, body)))
    src = sources.select(*keys, plain.alias("_plain"))
    sents = units.select(*keys, *unit_cols, F.explode(X.sentences(text, squished=squished)).alias("sentence"))
    core = F.col("_core")
    sents = X.once(sents, _core=F.rtrim(F.lower("sentence"), F.lit(".!?…"))).filter(core != "")
    return (sents.join(src, keys, "left")
            .filter(F.col("_plain").isNull() | ~F.contains("_plain", core))
            .select(*keys, *unit_cols, "sentence",
                    F.when(F.col("_plain").isNull(), "missing_source").otherwise("not_in_source").alias("reason")))
