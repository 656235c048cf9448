"""Topic search against a search of every pair."""
import random
import re

import pytest

from reelspark.functions import constants as K
from reelspark.operators import search


def tokens(text):
    return {w for w in re.findall(r"[a-z0-9]+", text.lower()) if len(w) > 2 and w not in K.SEARCH_STOP_WORDS}


def every_pair(topics, items, k):
    out = set()
    for t, text in topics:
        q = tokens(text)
        score = [(len(q & tokens(hay)) + 2 * bool(q and i and i in text.lower().replace(" ", "-")), i) for i, hay in items]
        ranked = sorted((x for x in score if x[0] > 0), key=lambda x: (-x[0], x[1]))[:k]
        out |= {(t, i, s, r) for r, (s, i) in enumerate(ranked, 1)}
    return out


def frames(spark, topics, items):
    return (spark.createDataFrame(topics, "topic_id long, topic string"), spark.createDataFrame(items, "id string, haystack string"))


@pytest.mark.parametrize("k", [1, 3])
@pytest.mark.parametrize("common", [0, 5, 1000])
def test_topics_of_rare_and_common_words(spark, k, common):
    rng = random.Random(k)
    often = ["often", "usual", "plain", "daily", "every"]
    words = [f"word{i}" for i in range(60)]
    items = [(f"doc-{i}", " ".join(rng.sample(often, rng.randint(0, 5)) + rng.sample(words, rng.randint(0, 4)) + ["everywhere"] * (i % 7 > 0)))
             for i in range(120)]
    topics = [(t, " ".join(rng.sample(often, rng.randint(0, 5)) + rng.sample(words, rng.randint(0, 4)) + ["everywhere"] * (t % 3 > 0)))
              for t in range(60)]
    topics += [(100, "everywhere"), (101, "often usual plain daily every everywhere"), (102, "doc 7"), (103, "about doc 11 and doc 110"),
               (104, ""), (105, "nobody says this"), (106, "de la"), (107, None)]
    items += [("zz", ""), ("yy", None)]
    got = search.topic_search(*frames(spark, topics, items), k=k, common_items=common)
    assert {tuple(r) for r in got.collect()} == every_pair([(t, x or "") for t, x in topics], [(i, h or "") for i, h in items], k)


def test_a_word_of_all_items_is_not_joined(spark):
    """Rows read from common lists do not grow with the items while rare words give a topic its score."""
    for n in (300, 1200):
        items = [(f"doc-{i}", f"shared rare{i % (n // 3)} other{i % (n // 3)}") for i in range(n)]
        topics = [(t, f"shared rare{t} other{t}") for t in range(50)]
        index = search.TopicIndex(*frames(spark, topics, items), "topic_id", "topic", "id", "haystack", 3, common_items=20)
        candidates = index.candidates()
        assert index.open_words(index.best(candidates)).count() == 0
        assert candidates.count() <= 50 * 6                        # three items by rare words, three first ones of the shared word
    assert {tuple(r) for r in index.search().collect()} == every_pair(topics, items, 3)


def test_empty_sides(spark):
    topics, items = frames(spark, [(1, "some words")], [("a", "some words")])
    assert search.topic_search(topics.limit(0), items).count() == 0
    assert search.topic_search(topics, items.limit(0)).count() == 0
