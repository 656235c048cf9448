"""Hard negatives, fill-in-the-middle and the quality classifier against brute-force versions."""
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspark.llm import classifier, fim, hardneg

rng = random.Random(5)


# --- hard negatives ---------------------------------------------------------------------------------
def brute(rows, anchors, scale=256.0, k=5):
    """rows: (key, label, vector) with repeats; the contract, row by row, in whole numbers of Python."""
    own = [(v, lab, [math.floor(scale * float(x)) for x in q]) for v, lab, q in rows
           if lab is not None and q is not None and all(x is not None and math.isfinite(x) for x in q)]
    out = []
    for i, (a, lab, q) in enumerate(own):
        if a is None or not anchors(a):
            continue
        score = [(sum(x * y for x, y in zip(q, other[2])), other) for other in own]
        rank = lambda j: (-score[j][0], own[j][0] is None, own[j][0] or 0)
        for p in sorted((j for j in range(len(own)) if j != i and own[j][1] == lab), key=rank)[:k]:
            ps = score[p][0]
            near = [j for j in range(len(own)) if own[j][1] != lab and 80 * ps <= 100 * score[j][0] <= 100 * ps]
            out += [(a, own[p][0], r, own[j][0], ps, score[j][0]) for r, j in enumerate(sorted(near, key=rank)[:k], 1)]
    return collections.Counter(out)


SCHEMA = "vec_id long, embedding array<float>, label int, q string, mark int"


def mined(spark, rows, **more):
    df = spark.createDataFrame([(v, q, lab, "x", 1) for v, lab, q in rows], SCHEMA)
    return collections.Counter(map(tuple, hardneg.mine(df, F.col("vec_id") % 10 == 0, **more).collect()))


@pytest.mark.parametrize("anchors, strip, scores", [(4096, 512, 1 << 20), (3, 7, 40)])
def test_hard_negatives(spark, monkeypatch, anchors, strip, scores):
    for name, value in (("ANCHORS", anchors), ("STRIP", strip), ("SCORES", scores)):
        monkeypatch.setattr(hardneg, name, value)
    f32 = lambda x: float(np.float32(x))
    rows = [(v, rng.randrange(3), [f32(rng.uniform(-1, 1) + (0.5 if d == 0 else 0)) for d in range(6)]) for v in range(150)]
    rows += [(10, 1, [0.5] * 6)] * 9 + [(20, 0, [0.5] * 6)] * 3 + [(21, 0, [0.5] * 6)] * 8       # copies, of anchors too
    rows += [(10, 1, [0.25] * 6), (10, 2, [0.5] * 6), (None, 0, [0.5] * 6), (None, 1, [0.5] * 6), (300, 0, [0.0] * 6)]
    rows += [(400, None, [1.0] * 6), (410, 1, None), (420, 1, [1.0, None]), (430, 1, [float("nan")] * 6), (440, 1, [float("inf")] * 6)]
    rows += [(450, 1, []), (460, 2, [1.0]), (461, 2, [0.75] * 9), (2**63 - 8, 2, [0.5] * 6), (-10, 1, [-0.5] * 6)]
    got = mined(spark, rows)
    assert got == brute(rows, lambda a: a % 10 == 0) and len(got) > 100


def test_hard_negatives_of_nothing(spark):
    assert not mined(spark, [])
    assert not mined(spark, [(1, 0, [1.0]), (2, 1, [1.0])]) and not mined(spark, [(10, 0, [1.0]), (2, 1, [1.0])])
    assert not mined(spark, [(10, 0, []), (20, None, None)])
    assert mined(spark, [(10, 0, []), (20, 0, []), (30, 1, [])]) == collections.Counter(
        {(10, 20, 1, 30, 0, 0): 1, (20, 10, 1, 30, 0, 0): 1})
    huge = [(10, 0, [1e30]), (20, 0, [1.0]), (30, 0, [1.0]), (31, 1, [1.0])]                     # no long holds its scores
    assert mined(spark, huge) == brute(huge[1:], lambda a: a % 10 == 0)


@pytest.mark.parametrize("width, top", [(1, 3), (64, 160), (65, 511), (200, 10_000), (64, hardneg.limit(64))])
def test_residue_product_is_exact(width, top):
    gen = np.random.default_rng(width)
    a, b = gen.integers(-top, top + 1, (7, width)), gen.integers(-top, top + 1, (11, width))
    a[0], b[0], a[1], b[1] = top, top, -top, top
    moduli = hardneg.primes(2 * width * top * top + 1)
    assert math.prod(moduli) > 2 * width * top * top + 1 and all(all(p % d for d in range(2, p)) for p in moduli)
    got = hardneg.product(hardneg.residues(a, moduli), hardneg.residues(b, moduli), moduli)
    assert (got.astype(object) == a.astype(object) @ b.astype(object).T).all()


# --- fill in the middle -----------------------------------------------------------------------------
def fim_brute(key, text):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(spark):
    parts = ["a", "Zoë", " ", "\n", "<", "<S", "S>", "<P", ">", "é", "日", "\U0001F600", "x1", "  ", "\x00", "word"]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for k in range(400)]
    rows += [(500, None), (501, ""), (502, "has <P> in it"), (None, "no key"), (None, None), (503, "long é " * 50_000), (7, rows[7][1]), (-3, "q")]
    docs = spark.createDataFrame([(k, t, "f", 3) for k, t in rows], "doc_id long, text string, form string, n int")
    got = fim.restore(fim.transform(docs)).collect()
    want = collections.Counter((k, *fim_brute(k, t or "")) for k, t in rows)
    assert collections.Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got) == want
    assert collections.Counter((r.doc_id, r.restored) for r in got) == collections.Counter((k, t or "") for k, t in rows)
    texts = {k: t for k, t in rows if k is not None}
    for r in got:
        assert r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(r.restored.encode()).hexdigest()
        if r.doc_id is not None:
            assert fim.render((texts[r.doc_id] or "").encode(), [tuple(p) for p in r.pieces]).decode() == r.output
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.restore(fim.transform(docs.limit(0))).count() == 0


def test_outputs_that_do_not_fit_are_restored_as_null(spark):
    rows = [("psm", "no marks"), ("psm", "x<P><S><M>"), ("spm", "<P>a<S>b<M>c"), ("odd", "<P><S><M>"), (None, "x"), ("plain", None), ("psm", "<P><S><M>")]
    got = fim.restore(spark.createDataFrame(rows, "form string, output string")).collect()
    assert [r.restored for r in got] == [None] * 6 + [""]


def test_cuts_of_many_pieces():
    pieces, data = [(0, 0, 3), (1, 0, 3), (0, 3, 4)], b"abcdefg"
    whole = fim.render(data, pieces)
    for a in range(len(whole) + 1):
        for b in range(a, len(whole) + 1):
            assert [fim.render(data, p) for p in fim.cut(pieces, [a, b])] == [whole[:a], whole[a:b], whole[b:]]
    assert [fim.render(b"", p) for p in fim.cut([], [0, 0])] == [b""] * 3


# --- quality classifier -----------------------------------------------------------------------------
def prose(n):
    return " ".join("".join(rng.choice("an re tion of ing er lo mi ka".split()) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_classifier_on_held_out_rows(spark):
    rows, labels = [], []
    for k in range(600):
        low = k % 3 == 0
        n = rng.choice([8, 40, 300])
        text = prose(n)
        if low:
            text = text + " " + (f"{prose(1)} " * n if k % 2 else " | ".join(prose(n).split()))
        rows.append((k, text, 0.5))
        labels.append((k, int(not low)))
    labels += [(None, 1), (5, None), (0, 0), (0, 1)]                       # of several labels the lower one counts
    docs = spark.createDataFrame([*rows, (None, None, 0.5), (700, "", 0.5), (701, "word " * 100_000, 0.5), (0, rows[0][1], 0.5)],
                                 "doc_id long, text string, score double")
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    model = classifier.train(docs, table)
    got = {r.doc_id: (r.score, r.predicted) for r in classifier.score(docs, model).collect()}
    held = [k for k in range(600) if zlib.crc32(str(k).encode()) % 3 == 1]
    assert np.mean([got[k][1] == (k % 3 > 0) for k in held]) > 0.95
    assert got[None] == got[700] and 0 < got[700][0] < 1 and got[701][1] == 0
    assert all(p == int(s >= 0.5) for s, p in got.values()) and len(classifier.score(docs, model).collect()) == docs.count()
    again = classifier.train(docs.repartition(5), table.repartition(3))
    assert (again.weights == model.weights).all() and again.intercept == model.intercept
    assert {r.score for r in classifier.score(docs, classifier.train(docs, table.limit(0))).collect()} == {0.5}
    one = classifier.train(docs, table.filter("quality = 1 and doc_id % 3 = 1"))
    assert {r.predicted for r in classifier.score(docs, one).collect()} == {1}
    assert classifier.score(docs.limit(0), model).count() == 0


def test_held_out_labels_teach_nothing(spark):
    docs = spark.createDataFrame([(k, prose(20)) for k in range(90)], "doc_id long, text string")
    held = [k for k in range(90) if zlib.crc32(str(k).encode()) % 3 == 1]
    base = [(k, k % 2) for k in range(90)]
    flipped = [(k, 1 - q if k in held else q) for k, q in base]
    a, b = (classifier.train(docs, spark.createDataFrame(x, "doc_id long, quality int")) for x in (base, flipped))
    assert (a.weights == b.weights).all() and a.intercept == b.intercept


def test_bounded_sample(spark, monkeypatch):
    monkeypatch.setattr(classifier, "SAMPLE_BYTES", 100_000)
    docs = spark.createDataFrame([(k, prose(30_000 if k < 3 else 10)) for k in range(60)] + [(4, "same text")] * 50, "doc_id long, text string")
    known = spark.createDataFrame([(k, k % 2) for k in range(60)], "known_key long, label int")
    got = classifier.sample(docs, known, 20, "doc_id", "text").collect()
    assert {r.label for r in got} == {0, 1} and max(len(r.text) for r in got) <= classifier.ROW_CHARS + classifier.PIECES
    assert max(collections.Counter(r.label for r in got).values()) <= 20 and len({(r.key, r.text) for r in got}) == len(got)


def test_leader_is_the_proximal_minimiser():
    z, n = np.array([2.0, -0.0005, -3.0]), np.array([1.0, 4.0, 0.25])
    grid = np.linspace(-2, 2, 400_001)
    for w, a, b in zip(classifier.leader(z, n, 0.5, 1e-3, 0.1), z, n):
        cost = a * grid + 1e-3 * abs(grid) + 0.5 * ((1 + math.sqrt(b)) / 0.5 + 0.1) * grid ** 2
        assert w == pytest.approx(grid[cost.argmin()], abs=2e-5)
