import random

import pytest
from pyspark.sql import functions as F

from reelspark.functions import constants as K
from reelspark.functions import text as X
from reelspark.operators import folds, search
from reelspark.views import news

NOUNS = "puerto barrio alcalde tormenta empresa comisión vecinos tribunal hospital tren museo lluvia ministro obra".split()
VERBS = "anunció confirmó cerraron aprobó visitaron investiga rechazó abrió pide mantienen".split()
TAILS = "tras la reunión|por la mañana|y varios heridos|con 30 y 31 personas|en EE.UU. durante el verano|aunque nadie lo sabe|pese a las críticas|para que la gente, los vecinos y el público".split("|")


def made_up(seed):
    r = random.Random(seed)

    def sentence():
        s = f"el {r.choice(NOUNS)} {r.choice(VERBS)} el {r.choice(NOUNS)} de {r.choice(NOUNS)}"
        for _ in range(r.randint(0, 5)):
            s += " " + r.choice(TAILS) + " " + r.choice(NOUNS)
        return s[0].upper() + s[1:] + r.choice([".", ".", "!", "…", "?"])

    body = [sentence() for _ in range(r.randint(1, 14))]
    if len(body) > 3:       # a literal repetition with something new after it
        body.append(" ".join(body[0].split()[:7]) + " y además otras cinco calles cerraron durante toda la noche.")
    return sentence()[:-1], " ".join(body)


@pytest.fixture(scope="module")
def corpus(spark, sf):
    rows = [(i, *made_up(i)) for i in range(60)]
    made = spark.createDataFrame(rows, "doc_id bigint, headline string, body string")
    real = news(spark, sf).filter(F.trim("headline") != "").select(
        (F.col("doc_id") + 1000).alias("doc_id"), "headline", "body").orderBy("doc_id").limit(24)
    return made.unionByName(real).repartition(8).cache()


def nearest_rung(words, top=K.FRAMES_MAX):
    """Frames whose seconds are nearest to the words' seconds; the shorter of two equally near."""
    seconds = words / K.WORDS_PER_SECOND + K.TAIL_SECONDS
    rungs = range(K.FRAMES_MIN, top + 1, K.LADDER_STEP)
    return min(rungs, key=lambda frames: (abs(frames / K.FPS - seconds), frames))


HEAD = "El alcalde anunció obras en el puerto"
NEXT = "La tormenta derribó cuatro torres eléctricas cerca del hospital provincial"


@pytest.mark.parametrize("body,takes", [
    ("", [HEAD + "."]),
    (HEAD + ".", [HEAD + "."]),                                                 # nothing new is said
    (f"{NEXT}. {NEXT}.", [f"{HEAD}. {NEXT}."]),                                 # said once
])
def test_plans_by_hand(spark, body, takes):
    rows = spark.createDataFrame([(1, HEAD, body)], "doc_id bigint, headline string, body string")
    plan = folds.plan_news(rows).first().plan
    assert [t.text for t in plan.takes] == takes
    assert [t.frames for t in plan.takes] == [nearest_rung(len(t.split())) for t in takes]


def test_takes_follow_the_source(corpus):
    src = {r.doc_id: f"{r.headline} {r.body}" for r in corpus.collect()}
    n = 0
    for r in folds.plan_news(corpus).collect():
        takes = r.plan.takes
        n += len(takes)
        assert all(t.frames == nearest_rung(len(t.text.split())) for t in takes), r.doc_id
        assert abs(r.plan.seconds - sum(t.frames for t in takes) / K.FPS) < 1e-9
        assert len({t.text for t in takes}) == len(takes) <= 8
        assert r.doc_id >= 1000 or takes[0].text.split()[:3] == src[r.doc_id].split()[:3]        # the headline comes first
    assert n > 120


def test_plan_properties(corpus):
    plans = folds.plan_news(corpus)
    units = folds.plan_units(plans).cache()
    assert units.filter(~(((F.col("frames") - 5) % 17 == 0) & F.col("frames").between(73, 396))).count() == 0
    assert units.filter(~F.col("text").rlike("[.!?…]$")).count() == 0
    # every unit is literally in its source
    src = corpus.select("doc_id", "headline", "body")
    assert search.ungrounded(units, src, ["doc_id"], ["unit_idx"]).count() == 0
    # never past the target by more than the last take
    over = plans.select(F.col("plan.seconds").alias("s"), F.try_element_at("plan.takes", F.lit(-1))["frames"].alias("f"))
    assert over.filter(F.col("s") - F.col("f") / 24 > 32.0 + 1e-6).count() == 0
    kinds = {r.kind for r in folds.plan_warnings(plans).select("kind").distinct().collect()}
    assert {"already_said", "pruned", "dropped"} <= kinds


def test_text_choice_does_not_depend_on_take_length(corpus):
    text = lambda s: folds.plan_news(corpus, max_seconds=s, target_seconds=9999.0, max_units=999).select(
        "doc_id", F.array_join(F.transform("plan.takes", lambda t: t["text"]), " ").alias("t"))
    assert text(8.0).exceptAll(text(16.0)).count() == 0


def test_same_plan_under_repartition(corpus):
    a = folds.plan_units(folds.plan_news(corpus))
    b = folds.plan_units(folds.plan_news(corpus.repartition(13)))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_one_take(corpus):
    rows = folds.plan_one_take(corpus).collect()
    assert rows
    for r in rows:
        assert all(t.frames == nearest_rung(len(t.text.split()), r.format.frames) for t in r.plan.takes)
        assert len(r.plan.takes) <= 1 and 73 <= r.format.frames <= 532 and r.format.width % 16 == 0 and r.format.height % 16 == 0


@pytest.mark.parametrize("sentence,cap,minimum,short", [
    ("Los técnicos cerraron la presa durante los días 30 y 31 de julio por orden del tribunal de la región", 12, 4, "Los técnicos cerraron la presa."),
    ("La reunión terminó entre Francia, Rusia y Ucrania sin acuerdo alguno para la región que espera", 9, 4, "La reunión terminó entre Francia, Rusia y Ucrania."),
    ("La reunión terminó entre Francia, Rusia y Ucrania sin acuerdo alguno", 6, 4, None),      # never inside a list
    ("El tren llegó", 8, 3, "El tren llegó."),
    ("Una frase larga sin forma verbal alguna para cortar con sentido entre tantas otras palabras vacías", 10, 4, None)])
def test_shorten(spark, sentence, cap, minimum, short):
    got = spark.range(1).select(X.shorten(F.lit(sentence), cap, minimum).alias("s")).first().s
    assert got == short


def test_repeated_prefix_and_prune(spark):
    said = "al menos cinco personas murieron en el puerto"
    unit = "Al menos cinco personas murieron y otras cinco resultaron heridas, tres de ellas de gravedad."
    row = spark.range(1).select(
        X.repeated_prefix(X.tokens(F.lit(unit)), F.lit(f" {said} ")).alias("n")).first()
    assert row.n == 5
    got = spark.range(1).select(X.prune_prefix(F.lit(unit), F.lit(5)).alias("t")).first().t
    assert got == "Otras cinco resultaron heridas, tres de ellas de gravedad."
    assert spark.range(1).select(X.repeated_prefix(X.tokens(F.lit("otra cosa")), F.lit(f" {said} ")).alias("n")).first().n == 0


def said_by_hand(sets):
    """(fresh, repeated, skip) of every set in turn; what is skipped is not said."""
    kept, out = [], []
    for own in sets:
        said = set().union(*kept)
        fresh = [x for x in own if x not in said]
        smaller = len(own) if not said else min(len(own), len(said))
        share = (len(own) - len(fresh)) / smaller if smaller else 0
        skip = bool(own) and (len(fresh) < K.NEW_STEMS_MIN or share >= K.REPEAT_SHARE_MAX)
        kept += [] if skip else [own]
        out.append((len(fresh), round(share, 9), skip))
    return out


def test_already_said(spark, corpus):
    rows = corpus.select("doc_id", "body").unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, " ")], "doc_id bigint, body string"))
    sets = {r.doc_id: r.w for r in rows.select("doc_id", F.transform(X.sentences("body"), X.content_set).alias("w")).collect()}
    got = {}
    for r in folds.novelty_filter(rows, "doc_id", "body").orderBy("doc_id", "idx").collect():
        assert r.idx == len(got.setdefault(r.doc_id, [])) + 1
        got[r.doc_id].append((r.fresh, round(r.repeated, 9), r.skip))
    assert got == {k: said_by_hand(w) for k, w in sets.items() if w}
    assert folds.novelty_filter(rows.limit(0), "doc_id", "body").count() == 0


def test_already_said_in_a_long_document(spark):
    """20,000 sentences of new words: every one is fresh, in time that follows the words."""
    body = " ".join(f"El barrio{i} cerró la calle{i} del puerto{i} y la plaza{i}." for i in range(20_000))
    out = folds.novelty_filter(spark.createDataFrame([(1, body)], "doc_id bigint, body string"), "doc_id", "body")
    assert out.agg(F.count("*"), F.max("idx")).first()[0] >= 20_000
