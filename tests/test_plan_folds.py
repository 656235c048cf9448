"""The plan's plain rules beside their columns, plans of long documents, and tasks that follow the files."""
import random
import time

import pytest
from pyspark.sql import functions as F

from reelspark import views
from reelspark.catalog import QUERIES
from reelspark.functions import constants as K
from reelspark.functions import plain
from reelspark.functions import text as X
from reelspark.operators import folds


def odd_texts():
    r = random.Random(7)
    words = ("El aLcalde cerró ciudades, y e PERO aunque, ,; : ıİ ΣΑΣ ǅ ñandú ﬁn café ́x naïve straße ½ x² 12,5 _a a_b década "
             "roza SÓ gritó. (dijo) «fue» llegó!; Además; ademas, rápidamente medidas 𝒳yz ا١ hay… está: mientras").split()
    return ["", ",;:", "y", *(" ".join(r.choices(words, k=r.randint(1, 14))) for _ in range(400))]


def test_plain_rules_are_the_columns(spark):
    rows = [(i, t, i % 5) for i, t in enumerate(odd_texts())]
    df = spark.createDataFrame(rows, "i int, t string, n int").select(
        "t", "n", X.fold_accents("t").alias("fold"), X.tokens("t").alias("tokens"), X.content_set("t").alias("stems"), X.has_verb("t").alias("verb"),
        X.close_sentence("t").alias("closed"), X.squished_count("t").alias("words"), X.prune_prefix(F.col("t"), F.col("n")).alias("pruned"),
        folds.N.frames_for_words(F.col("n") * 13, 396).alias("frames"))
    for r in df.collect():
        assert plain.fold_accents(r.t) == r.fold and plain.tokens(r.t) == r.tokens, r.t
        assert plain.content_set(r.tokens) == set(r.stems) and len(set(r.stems)) == len(r.stems)
        assert (plain.has_verb(r.t), plain.close_sentence(r.t), plain.word_count(r.t)) == (r.verb, r.closed, r.words), r.t
        assert plain.prune_prefix(r.t, r.n) == r.pruned and plain.frames_for_words(r.n * 13, 396) == r.frames, r.t


def test_repeated_runs_as_in_text(spark):
    r = random.Random(3)
    runs = [[r.choice("abc") for _ in range(r.randint(0, 9))] for _ in range(120)]
    spoken, said, rows = plain.Spoken(), " ", []
    for run in runs:
        rows.append((run, said, spoken.repeated(run)))
        spoken.add(run)
        said += " ".join(run) + " "
    df = spark.createDataFrame(rows, "run array<string>, said string, n int")
    assert df.filter(X.repeated_prefix(F.col("run"), F.col("said")) != F.col("n")).count() == 0 and any(n for *_, n in rows)


@pytest.mark.parametrize("plan", [folds.plan_news, folds.plan_one_take])
def test_plan_of_a_long_document(spark, plan):
    """Its time follows the words; an array of all that was said made it their square."""
    body = " ".join(f"El barrio{i} cerró la calle{i} del puerto{i} y la plaza{i}." for i in range(12_000))
    rows = spark.createDataFrame([(1, "El alcalde anunció obras en el puerto", body)], "doc_id bigint, headline string, body string")
    start = time.time()
    takes = plan(rows).first().plan.takes
    assert time.time() - start < 60
    assert takes and (plan is folds.plan_news or takes[0].n_words > 100_000)


def test_one_take_again_for_short_documents(spark):
    """Where the frame leaves room for fewer words, the text is chosen again within that frame's limits."""
    head = "El alcalde anunció obras en el puerto de la ciudad"
    rows = spark.createDataFrame([(1, head, ""), (2, "Lluvia", ""), (3, "", ""), (4, head, head + " y el hospital abrió dos plantas nuevas para los vecinos del barrio.")],
                                 "doc_id bigint, headline string, body string")
    for r in folds.plan_one_take(rows).collect():
        seconds = r.format.frames / K.FPS
        split = X.once(rows.filter(F.col("doc_id") == r.doc_id), _s=F.concat(F.slice(X.sentences("headline"), 1, 1), X.sentences("body")))
        again = folds._folded(split, "_s", folds.limits(seconds, seconds, F.lit(r.format.frames)), 1, True)
        want = again.select(folds._finished(F.col("_units"), F.col("_f")).alias("plan")).first().plan
        assert r.plan == want, r.doc_id


def test_one_take_is_planned_once(spark, sf):
    plan = QUERIES["plan_one_take"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("documents.parquet") <= 1


def test_tasks_follow_the_files(spark, tmp_path, monkeypatch):
    spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).coalesce(1).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    monkeypatch.setattr(views, "TASK_BYTES", size // 50)
    assert 50 <= views.spread(df).rdd.getNumPartitions() <= 52
    monkeypatch.setattr(views, "TASK_BYTES", size * 2)
    assert views.spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_packing_by_hand(spark):
    """Units start where the words no longer fit; texts are cut out of the sentences afterwards."""
    r = random.Random(11)
    docs = [[" ".join("w" * r.randint(1, 30)) for _ in range(r.randint(0, 40))] for _ in range(60)]
    cap = int(8.0 * K.WORDS_PER_SECOND)
    for row in spark.createDataFrame([(d,) for d in docs], "s array<string>").select("s", folds.pack(F.col("s"), 8.0).alias("u")).collect():
        units = []
        for s in row.s:
            if units and units[-1][1] + len(s.split()) <= cap:
                units[-1] = (units[-1][0] + " " + s, units[-1][1] + len(s.split()))
            else:
                units.append((s, len(s.split())))
        assert [(u.text, u.n_words) for u in row.u] == units


def test_squished_texts_are_split_alike(spark):
    df = spark.createDataFrame([(t,) for t in odd_texts()], "t string").select(X.squish("t").alias("t"))
    same = X.sentences("t") == X.sentences("t", squished=True)
    short = lambda known: F.transform(X.sentences("t"), lambda s: X.shorten(s, 6, 3, squished=known))
    assert df.filter(~same | ~short(True).eqNullSafe(short(False))).count() == 0
