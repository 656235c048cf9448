"""Character references against the standard library."""
import html
import random
from html.entities import html5

from reelspark.functions import entities
from reelspark.functions import text as X


def test_references_are_the_standard_ones(spark):
    rng = random.Random(3)
    parts = ["&", "&amp;", "&amp", "&lt", "&notit;", "&notin;", "&#", "&#x", "&#;", "&#0;", "&#13;", "&#128;", "&#129;", "&#x80", "&#xD800;", "&#x110000;",
             "&#99999999999999999999;", "&#00065;", "&#xFDD0;", "&#xFFFF;", "&#x1F600;", "&#127;", "&#11;", "&#12;", "&Tab;", "&NotEqualTilde;", "a", ";", " ",
             "é", "\U0001F600", "&" + "x" * 40, "&AMPx", "&ouml", "&oumlaut;", "&bogus;", "#", "41"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 8))) for _ in range(1500)] + [f"&{n}" for n in html5] + [f"&{n}q" for n in html5]
    texts += [f"&#{n};" for n in range(300)] + [f"&#x{n:X}" for n in range(0xD7F0, 0x11000, 257)] + [None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(8)
    got = {r.i: r.u for r in df.select("i", entities.unescape(df.t).alias("u")).collect()}
    wrong = [(t, got[i], html.unescape(t)) for i, t in enumerate(texts) if t is not None and got[i] != html.unescape(t)]
    assert not wrong, wrong[:5]
    assert got[len(texts) - 1] is None


def test_markup_goes_before_references(spark):
    df = spark.createDataFrame([("<p>A&lt;b&gt; &#xF1;and&uacute;<script>&amp;</script>&nbsp;&amp;lt;",), (None,)], "t string")
    assert [r[0] for r in df.select(X.strip_html("t")).collect()] == ["A<b> ñandú &lt;", ""]
