"""Toxicity scores of many texts at once, beside a version that looks at one word after the other."""
import zlib

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
from reelspark.llm import toxicity  # noqa: E402
from reelspark.llm.decontaminate import words  # noqa: E402

BUCKETS = 1 << 12


def parts(word):
    marked = "<" + word.decode("utf-8", "replace") + ">"
    return [marked] + [marked[i:i + n] for n in (3, 4, 5) for i in range(len(marked) - n + 1) if n < len(marked)]


def plain(slope, intercept, prior, text):
    sums = [(float(slope[[zlib.crc32(p.encode()) % BUCKETS for p in parts(w)]].sum()), len(parts(w))) for w in words(text)]
    if not sums:
        return prior
    running = np.cumsum([(0, 0), *sums], axis=0)
    means = [(running[min(a + 16, len(sums))] - running[a]) for a in range(0, max(len(sums) - 8, 1), 8)]
    x = intercept + max(a / b for a, b in means)
    return float(1 / (1 + np.exp(-np.clip(x, -700, 700))))


def texts():
    rng = np.random.default_rng(3)
    made = [" ".join(f"w{i}" for i in rng.integers(0, 200, n)) for n in (1, 8, 16, 17, 40, 300)]
    return [None, "", "...", "a", " ü ñandú ", "\ud800x y", "x" * 100 + " y", "é" * 66 + " q", "A" * 62 + " b", *made, "w1 w1 w1"]


def test_scores_as_one_word_after_the_other(monkeypatch):
    slope = np.random.default_rng(1).normal(0, 1, BUCKETS).astype(np.float32)
    want = [plain(slope, -1.0, 0.25, t) for t in texts()]
    for kept in (3, 1 << 18):
        monkeypatch.setattr(toxicity, "CACHE_WORDS", kept)
        model = toxicity.Model(slope, -1.0, 0.25)
        assert model.scores(texts()) == want
        assert [model.score(t) for t in texts()] == want
        assert not any(len(w) > toxicity.LONG_WORD for w in model.known)
    assert toxicity.Model(slope, -np.inf).scores(["a", None]) == [0.0, 0.0]


def test_common_words_are_hashed_once_however_many_others_come(monkeypatch):
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 10)
    hashed, crc = [], zlib.crc32
    monkeypatch.setattr(toxicity.zlib, "crc32", lambda x, *a: hashed.append(bytes(x)) or crc(x, *a))
    model = toxicity.Model(np.ones(BUCKETS, np.float32), 0.0)
    for i in range(20):
        assert 0 < toxicity.Model.score(model, "common " + " ".join(f"rare{i}x{j}" for j in range(4))) < 1
    assert hashed.count(b"<common>") == 1 and hashed.count(b"<rare3x2>") == 1
