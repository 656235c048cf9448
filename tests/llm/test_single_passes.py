"""Work that is done once: edges, words."""
import random

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("public_tokenizers")
from reelspark.llm import common, jaccard  # noqa: E402
from reelspark.llm.components import components  # noqa: E402


def test_components_make_their_edges_once(spark):
    made = spark.sparkContext.accumulator(0)
    rng = random.Random(5)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(1, 1), (70, 71), (71, 70), (80, 80), (None, 3)]

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch
    counted = spark.createDataFrame(edges, "a int, b int").mapInArrow(count, "a int, b int")
    got = {r.node: r.label for r in components(counted).collect()}
    assert made.value == len(edges)
    want = {n: n for e in edges if None not in e and e[0] != e[1] for n in e}
    for _ in want:
        for a, b in edges:
            if a in want and b in want:
                want[a] = want[b] = min(want[a], want[b])
    assert got == want


def test_words_become_python_values():
    for values, kind in (([b"", b"a", "é".encode()], pa.binary()), (["", "a", "é"], pa.string()), ([], pa.binary())):
        assert common.plain_values(pa.array(values, kind)) == values


def test_shingles_of_words_alone_in_a_batch_and_together():
    texts = ["a b c d e f g", None, "", "x", "A b c D e f g h", " \t", "é \ud800 b"]
    together = jaccard.shingles(texts)
    assert [len(x) for x in together] == [3, 0, 0, 1, 4, 0, 1]
    assert all(np.array_equal(x, jaccard.shingles([t])[0]) for x, t in zip(together, texts))
    assert not len(jaccard.shingles([None])[0]) and jaccard.shingles([]) == []


def test_texts_are_split_once_to_be_encoded(spark):
    """Both readers of the lists of words use one exchange."""
    import public_tokenizers

    from reelspark.llm import bpe
    docs = spark.createDataFrame([(i, f"text {i} of some words") for i in range(40)] + [(None, None), (None, "")], "doc_id long, text string")
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    assert coded.count() == 42 and coded.filter("size(ids) = 0").count() == 2
    plan = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", plan)
    assert text.count("MapInArrow") == 1 and text.count("ReusedExchange") == 1
