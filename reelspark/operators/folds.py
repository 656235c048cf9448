"""Order-dependent folds over the sentences of one document.

A document is one row, so each fold is a column expression without a shuffle, and the number of
documents per source or language does not matter. Only what depends on all that was said before runs in Arrow batches.
"""
from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import numeric as N
from ..functions import plain
from ..functions import text as X
from ..functions.text import let


# --- greedy packing -----------------------------------------------------------------
def pack(sentences: Column, seconds: float) -> Column:
    """Consecutive sentences joined while they fit; a long sentence stands alone.

    Returns an array of struct(text, n_words).
    """
    cap = int(seconds * K.WORDS_PER_SECOND)
    zero = F.expr("named_struct('starts', cast(array() as array<int>), 'n', 0)")

    def step(acc, x):
        # the fold carries where units start; their texts are cut out afterwards
        opens = (x["i"] == 1) | (acc["n"] + x["n"] > cap)
        return F.struct(F.when(opens, F.array_append(acc["starts"], x["i"])).otherwise(acc["starts"]).alias("starts"),
                        F.when(opens, x["n"]).otherwise(acc["n"] + x["n"]).alias("n"))

    def cut(sents, ns, starts):
        def unit(start, i):
            size = F.coalesce(F.get(starts, i + 1), F.size(sents) + 1) - start
            return let(size, lambda k: F.struct(
                F.array_join(F.slice(sents, start, k), " ").alias("text"),
                F.aggregate(F.slice(ns, start, k), F.lit(0), lambda a, n: a + n).alias("n_words")))
        return F.transform(starts, unit)

    def fold(sents, ns):
        numbered = F.transform(ns, lambda n, i: F.struct((i + 1).alias("i"), n.alias("n")))
        return let(F.aggregate(numbered, zero, step, lambda acc: acc["starts"]), lambda starts: cut(sents, ns, starts))

    return let(sentences, lambda s: let(F.transform(s, X.squished_count), lambda n: fold(s, n)))


def packed_units(df: DataFrame, key: str, text: str, seconds: float) -> DataFrame:
    units = df.select(key, F.posexplode(pack(X.sentences(text), seconds)).alias("pos", "u"))
    return units.select(key, (F.col("pos") + 1).alias("unit_idx"), "u.text", "u.n_words")


def priced_documents(df: DataFrame, key: str, text: str, seconds: float) -> DataFrame:
    """Number of units, words, frames and seconds that each document turns into."""
    packed = X.once(df.select(key, text), p=pack(X.sentences(text), seconds))       # the filter below must not fold again
    priced = packed.select(key, F.transform("p", lambda u: F.struct(
        u["n_words"].alias("n_words"), N.frames_for_words(u["n_words"]).alias("frames"))).alias("u"))
    total = lambda f: F.aggregate("u", F.lit(0).cast("bigint"), lambda a, u: a + u[f])
    return (priced.filter(F.size("u") > 0)
            .select(key, F.size("u").cast("bigint").alias("n_units"), total("n_words").alias("n_words"),
                    total("frames").alias("frames"))
            .withColumn("seconds", F.round(F.col("frames") / K.FPS, 6)))


# --- already-said filter ---------------------------------------------------------------
def _lines(texts: Column) -> Column:
    """An array of texts without line ends as one text, a line end before each; an empty array is an empty text.

    A batch of such texts is one buffer; only the document at hand becomes Python objects.
    """
    return F.array_join(F.transform(texts, lambda t: F.concat(F.lit("\n"), F.coalesce(t, F.lit("")))), "")


def already_said(stems: Column) -> Column:
    """What each sentence of a document adds to those kept before it, as an array beside `stems` (one array per sentence).

    Stems are distinct in a sentence and hold no blanks.  What has been said is a set, so the time follows the
    number of words; a document at a time is looked at.  A null document stays null.
    """
    @F.arrow_udf("array<struct<fresh:int,repeated:double,skip:boolean>>")
    def fold(documents: pa.Array) -> pa.Array:
        ends, fresh, share, skip = [0], array("i"), array("d"), bytearray()
        for document in documents:
            said = set()
            for line in (document.as_py() or "").split("\n")[1:]:
                own = set(line.split())
                found = plain.repeats(own, said)
                if not found[2]:
                    said |= own
                fresh.append(found[0])
                share.append(found[1])
                skip.append(found[2])
            ends.append(len(fresh))
        values = pa.StructArray.from_arrays([pa.array(np.frombuffer(fresh, np.int32)), pa.array(np.frombuffer(share, np.float64)),
                                             pa.array(np.frombuffer(skip, np.bool_))], ["fresh", "repeated", "skip"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=documents.is_null())
    return fold(_lines(F.transform(stems, lambda w: F.array_join(w, " "))))


def novelty_filter(df: DataFrame, key: str, text: str) -> DataFrame:
    """Keep or skip each sentence of a document by what was kept before it."""
    split = X.once(df.select(F.col(key), X.sentences(text).alias("_s")), _w=F.transform("_s", X.content_set))
    judged = split.select(key, F.arrays_zip("_s", already_said(F.col("_w")).alias("_v")).alias("_o"))
    return judged.select(key, F.posexplode("_o").alias("_p", "o")).select(
        key, (F.col("_p") + 1).alias("idx"), F.col("o._s").alias("sentence"), "o._v.fresh", "o._v.repeated", "o._v.skip")


# --- whole plan --------------------------------------------------------------------------
_PLAN = ("struct<takes:array<struct<text:string,n_words:int,frames:int>>,seconds:double,"
         "warnings:array<struct<kind:string,detail:string>>>")


def limits(max_seconds, target_seconds, max_frames=K.FRAMES_MAX) -> Column:
    """Words that a take holds, has at least, and that a cut leaves; seconds of the plan and frames of a take.

    All limits may be columns.
    """
    top_frames = X._c(max_frames)
    limit = F.least(X._c(max_seconds), top_frames / K.FPS)
    capacity = F.least(limit, F.lit(K.REFERENCE_TAKE_SECONDS)) * K.WORDS_PER_SECOND
    whole = lambda share, least: F.greatest(F.lit(least), F.floor(capacity * share).cast("int"))
    return F.struct(whole(K.CAPACITY_SLACK, 6).alias("cap"), whole(K.CAPACITY_FLOOR, 4).alias("floor"),
                    whole(K.MIN_CUT_SHARE, 6).alias("cut"), X._c(target_seconds).cast("double").alias("target"),
                    top_frames.cast("int").alias("frames"))


def _said(texts: Column, lim: Column, max_units: int, one_take: bool) -> Column:
    @F.arrow_udf(_PLAN)
    def fold(documents: pa.Array, cap: pa.Array, floor: pa.Array, cut: pa.Array, target: pa.Array, top: pa.Array) -> pa.Array:
        bounds = zip(*(c.to_pylist() for c in (cap, floor, cut, target, top)))
        plans = (plain.say(d.as_py().split("\n")[1:], *b, max_units, one_take) for d, b in zip(documents, bounds))
        return pa.array(plans, schema)
    schema = pa.struct([("takes", pa.list_(pa.struct([("text", pa.string()), ("n_words", pa.int32()), ("frames", pa.int32())]))),
                        ("seconds", pa.float64()), ("warnings", pa.list_(pa.struct([("kind", pa.string()), ("detail", pa.string())])))])
    return fold(_lines(texts), *[lim[f] for f in ("cap", "floor", "cut", "target", "frames")])


def _finished(units: Column, folded: Column) -> Column:
    """The plan of a document: takes, seconds, and all warnings: of the cuts, of the fold, of the takes' rates."""
    early = F.transform(F.filter(units, lambda u: u["kind"].isNotNull()),
                        lambda u: F.struct(u["kind"].alias("kind"), u["sentence"].alias("detail")))
    rate = lambda t: t["n_words"] / (t["frames"] / K.FPS)
    late = F.filter(F.transform(folded["takes"], lambda t: F.struct(
        N.rate_band(rate(t)).alias("kind"), t["text"].alias("detail"))), lambda w: w["kind"] != "ok")
    return F.struct(folded["takes"].alias("takes"), folded["seconds"].alias("seconds"),
                    F.concat(early, folded["warnings"], late).alias("warnings"))


def _folded(df: DataFrame, sentences: str, lim: Column, max_units: int, one_take: bool) -> DataFrame:
    """Adds `_lim`, `_units` (sentences, shortened where they do not fit) and `_f` (what is said of them)."""
    def unit(s, i):
        return let(X.shorten(s, F.col("_lim.cap"), F.col("_lim.cut"), squished=True), lambda t: F.struct(
            F.when(t.isNull() & (i == 0), X.close_sentence(s)).otherwise(t).alias("text"),
            F.when(t.isNull(), F.when(i == 0, "headline_uncut").otherwise("dropped")).alias("kind"),
            s.alias("sentence")))
    shaped = X.once(X.once(df, _lim=lim), _units=F.transform(sentences, unit))
    kept = F.transform(F.filter("_units", lambda u: u["text"].isNotNull()), lambda u: u["text"])
    return shaped.withColumn("_f", _said(kept, F.col("_lim"), max_units, one_take))


def planned(df: DataFrame, sentences: str, lim: Column, max_units: int = K.MAX_UNITS) -> DataFrame:
    """Adds the plan of each row's sentences as struct(takes, seconds, warnings).

    Sentences are shortened where they do not fit, skipped when already said, pruned when they
    open with a run said before, and packed into takes whose length follows their words.  What
    is said is chosen against a fixed reference length, so a longer take never changes the text.
    """
    return X.once(_folded(df, sentences, lim, max_units, False), plan=_finished(F.col("_units"), F.col("_f"))).drop("_lim", "_units", "_f")


def _split_news(news: DataFrame, key: str, headline: str, body: str, clean: bool) -> DataFrame:
    """(key, `_s`): the first sentence of the headline and all of the body."""
    h, b = (X.strip_html(headline), X.strip_html(body)) if clean else (F.col(headline), F.col(body))
    base = X.once(news, _h=h, _b=b).select(key, "_h", "_b")
    return X.once(base, _s=F.concat(F.slice(X.sentences("_h", squished=clean), 1, 1), X.sentences("_b", squished=clean))).select(key, "_s")


def plan_news(news: DataFrame, key: str = "doc_id", headline: str = "headline", body: str = "body",
              max_seconds: float = K.REFERENCE_TAKE_SECONDS, target_seconds: float = K.TARGET_SECONDS,
              max_units: int = K.MAX_UNITS, clean: bool = True) -> DataFrame:
    """One plan per document; `news_issues` names those that a caller may want to refuse."""
    split = _split_news(news, key, headline, body, clean)
    return planned(split, "_s", limits(max_seconds, target_seconds), max_units).select(key, "plan")


def plan_one_take(news: DataFrame, key: str = "doc_id", headline: str = "headline", body: str = "body",
                  budget_mib: float = K.MIB_BUDGET) -> DataFrame:
    """The whole document as one take: measure its words, choose the largest frame that fits, plan again.

    Only a short document gets other limits for its words from its frame; where they stay, the first plan's text
    stands and its frames are counted again.
    """
    words_of = lambda plan: F.aggregate(plan["takes"], F.lit(0), lambda a, t: a + t["n_words"])
    probe = _folded(_split_news(news, key, headline, body, True), "_s", limits(60.0, 9999.0), 1, True)
    sized = X.once(probe, format=N.one_take_format(words_of(F.col("_f")), budget_mib))
    seconds = F.col("format.frames") / K.FPS
    sized = X.once(sized, _lim2=limits(seconds, seconds, F.col("format.frames")))
    same = F.lit(True)
    for f in ("cap", "floor", "cut"):
        same = same & (F.col("_lim")[f] == F.col("_lim2")[f])
    recount = F.transform("_f.takes", lambda t: F.struct(
        t["text"].alias("text"), t["n_words"].alias("n_words"), N.frames_for_words(t["n_words"], F.col("format.frames")).alias("frames")))
    first = X.once(sized, _same=same, _t=recount)
    first = X.once(first, _first=F.struct(F.col("_t").alias("takes"), F.aggregate(
        "_t", F.lit(0.0), lambda a, t: a + t["frames"] / K.FPS).alias("seconds"), F.col("_f.warnings").alias("warnings")))
    first = X.once(first, _p1=_finished(F.col("_units"), F.col("_first")), _s2=F.when(F.col("_same"), F.slice("_s", 1, 0)).otherwise(F.col("_s")))
    again = _folded(first.select(key, "format", "_same", "_p1", "_lim2", "_s2"), "_s2", F.col("_lim2"), 1, True)
    return again.select(key, "format", F.when(F.col("_same"), F.col("_p1")).otherwise(_finished(F.col("_units"), F.col("_f"))).alias("plan"))


def plan_units(plans: DataFrame, key: str = "doc_id", *more: str) -> DataFrame:
    """One row per take, with `more` columns of its plan."""
    rate = F.rint(F.col("t.n_words") / (F.col("t.frames") / K.FPS) * 100) / 100
    return plans.select(key, F.posexplode("plan.takes").alias("_p", "t"), *more).select(
        key, (F.col("_p") + 1).alias("unit_idx"), "t.text", "t.n_words", "t.frames", rate.alias("rate"), *[c.split(".")[-1] for c in more])


def plan_warnings(plans: DataFrame, key: str = "doc_id") -> DataFrame:
    return plans.select(key, F.posexplode("plan.warnings").alias("_p", "w")).select(
        key, (F.col("_p") + 1).alias("seq"), "w.kind", "w.detail")


def news_issues(news: DataFrame, key: str = "doc_id", headline: str = "headline", body: str = "body", clean: bool = True) -> DataFrame:
    """(key, issue): documents without a headline, or with a part beyond its limit."""
    h, b = (X.strip_html(headline), X.strip_html(body)) if clean else (F.col(headline), F.col(body))
    base = X.once(news, _h=F.coalesce(h, F.lit("")), _b=F.coalesce(b, F.lit("")))
    issues = F.array(F.when(F.col("_h") == "", "no headline"), F.when(F.length("_h") > K.HEADLINE_MAX, "headline too long"),
                     F.when(F.length("_b") > K.BODY_MAX, "body too long"))
    return base.select(key, F.explode(F.filter(issues, lambda i: i.isNotNull())).alias("issue"))
