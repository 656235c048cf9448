import os
import tempfile

import pytest
from pyspark.sql import functions as F

from reelspark.functions import numeric as N
from reelspark.functions import text as X
from reelspark.operators import timeline as T
from reelspark.plans import scripts as C
from reelspark.sources import readers as R
from reelspark.sources import sinks as S


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def put(folder, name, text, mode="w"):
    path = os.path.join(folder, name)
    with open(path, mode, **({} if "b" in mode else {"encoding": "utf-8"})) as fh:
        fh.write(text)
    return path


def test_news(spark, folder):
    put(folder, "uno.txt", "titular: Un titular\nFUENTE: https://x.example\nTema: mar\n\nPrimera línea.\n\nSegunda.\n")
    put(folder, "dos.txt", "\n  Sin cabecera\nFUENTE: esto ya es cuerpo\n")
    put(folder, "tres.txt", "TITULAR: Solo titular")
    put(folder, "otro.md", "no")
    got = {r.id: r for r in R.news_catalog(spark, folder).collect()}
    assert set(got) == {"uno", "dos", "tres"}
    assert (got["uno"].headline, got["uno"].source_url, got["uno"].topic) == ("Un titular", "https://x.example", "mar")
    assert got["uno"].body == "Primera línea.\n\nSegunda."
    assert (got["dos"].headline, got["dos"].body, got["dos"].source_url) == ("Sin cabecera", "FUENTE: esto ya es cuerpo", "")
    assert (got["tres"].headline, got["tres"].body) == ("Solo titular", "")
    with pytest.raises(ValueError):
        R.news_catalog(spark, tempfile.mkdtemp(prefix="spark-", dir="/tmp"))


def test_feed(spark, folder):
    put(folder, "a.xml", """<?xml version="1.0"?><rss xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>Canal</title>
      <item><title>Uno</title><description> </description><content:encoded>&lt;p&gt;Hola &amp;amp; adiós&lt;/p&gt;</content:encoded></item>
      <item><title>Dos</title><description>Cuerpo</description></item><item><description>sin título</description></item></channel></rss>""")
    got = sorted((r.headline, r.body, r.source) for r in R.read_feed(spark, folder).collect())
    assert got == [("Dos", "Cuerpo", "Canal"), ("Uno", "Hola & adiós", "Canal")]


def test_scripts(spark, folder):
    put(folder, "obra.guion", "﻿# nota\n@TIPO informativo\n@ESCENA plató\n@AMBIENTE sala\n@MUSICA nada\n\n"
        "TOMA|Hola a todos||\nTOMA|Otra|encadena|habla|mesa||frames=90\nHABLA|Fin|ancla:2\nTOMA|Mal|ancla:9\nTOMA|X|ancla|raro\nTOMA||ancla\nTOMA|z|a|b|c|d|e\n")
    put(folder, "vacia.guion", "@ESCENA a\n@ESCENA b\n")
    headers, takes, issues = R.read_scripts(spark, folder)
    t = {r.idx: r for r in takes.filter("script_id = 'obra'").collect()}
    assert (t[1].mode, t[1].take_type, t[1].scene) == ("inicio", "informativo", "plató")
    assert (t[2].mode, t[2].anchor_source, t[2].scene, t[2].own_frames, t[2].mode_warning) == ("ancla:1", 1, "mesa", 90, "chain_mode")
    assert (t[3].mode, t[3].take_type) == ("ancla:2", "habla")
    got = {(r.script_id, r.line_no, r.issue) for r in issues.collect()}
    assert {("obra", 10, "points_forward"), ("obra", 11, "unknown_type"), ("obra", 12, "empty_content"),
            ("vacia", None, "no_takes"), ("vacia", 2, "duplicate_header"), ("vacia", None, "missing_musica")} <= got
    assert ("obra", 13, "too_many_positional") in got


def test_rendered_script_parses_back(spark, folder):
    takes = spark.createDataFrame([("s", 1, "Hola", "habla", 90), ("s", 2, "Mesa", "detalle", None), ("s", 3, "Fin", "habla", 107)],
                                  "script_id string, idx int, content string, take_type string, frames int")
    headers = spark.createDataFrame([("s", k, v) for k, v in (("TIPO", "habla"), ("ESCENA", "e"), ("AMBIENTE", "a"), ("MUSICA", "m"))],
                                    "script_id string, key string, value string")
    lines = C.render_lines(takes, headers)
    _, back, issues = C.parse(lines)
    assert issues.count() == 0
    assert [(r.idx, r.content, r.mode, r.own_frames) for r in back.orderBy("idx").collect()] == [
        (1, "Hola", "inicio", 90), (2, "Mesa", "inicio", None), (3, "Fin", "ancla:1", 107)]
    S.write_scripts(lines, folder + "/out")
    text = "\n".join(r.value for r in spark.read.text(folder + "/out/script_id=s").collect())
    assert text.splitlines()[0] == "@TIPO habla" and text.splitlines()[-1] == "TOMA|Fin|ancla|habla|frames=107"


def test_telemetry_probes_srt(spark, folder):
    put(folder, "run.csv", "0, 3860;1, 205; RSS_KB=192680\n0, 4000;1, 205; RSS_KB=192700\n")
    got = [(r.run, r.sample_idx, r.device, r.mib, r.rss_kb) for r in R.read_telemetry(spark, folder + "/run.csv").orderBy("sample_idx", "device").collect()]
    assert got == [("run", 1, 0, 3860, 192680), ("run", 1, 1, 205, 192680), ("run", 2, 0, 4000, 192700), ("run", 2, 1, 205, 192700)]
    p = put(folder, "p.tsv", "ancho\talto\tframes\tsegundos_video\tcabe\tvram\tseg\tmotivo\n416\t736\t192\t8.0\tsi\t6232\t242\t\n416\t736\t447\t18.6\tno\t12723\t14\tvram\n")
    assert [(r.frames, r.fits, r.reason) for r in R.read_probes(spark, p).collect()] == [(192, True, None), (447, False, "vram")]
    put(folder, "x.srt", "1\n00:00:01,5 --> 00:00:03.25\nHola a\ntodos\n\n2\n00:00:05,000 --> 00:00:05,000\nnada\n\nsin tiempo\n")
    got = [(r.t0, r.t1, r.text) for r in R.read_srt(spark, folder).collect()]
    assert got == [(1.5, 3.25, "Hola a todos")]


def test_json_sources(spark, folder):
    put(folder, "c.json", '[{"nombre":"a","url":"https://x","diapositivas":[{"titulo":"t1","texto":"x1"},{"titulo":"t2","texto":"x2","cierre":"fin"}]}]')
    got = [(r.slide, r.slides, r.titulo, r.cierre) for r in R.slides(R.read_carousels(spark, folder + "/c.json")).collect()]
    assert got == [(1, 2, "t1", None), (2, 2, "t2", "fin")]
    put(folder, "k.json", '{"nombre":"n","ritmo":["detalle"],"apoyos":[],"formato":{"ancho":416}}')
    cats = R.read_categories(spark, folder + "/k.json")
    assert cats.first().formato.ancho == 416 and T.silent_rhythms(cats).count() == 1
    states = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    put(states, "a.json", '{"phase":"done","name":"a","completed":3,"total":4}')
    for i, bad in enumerate(('{"phase":1,"name":"b"}', '[1]', 'nope', '{"phase":"x","name":"c","completed":true}', '{"phase":"x","name":"c","pid":1.5}')):
        put(states, f"b{i}.json", bad)
    assert [(r.name, r.completed) for r in R.read_job_states(spark, states).collect()] == [("a", 3)]


def test_media_and_png(spark, folder):
    put(folder, "reel-416x736-a.mp4", b"x" * 2048, "wb")
    put(folder, "wide-736x416-b.mp4", b"x", "wb")
    rows = {r.name: r for r in R.media_catalog(spark, {"entrega": folder}).collect()}
    assert rows["reel-416x736-a.mp4"].vertical and not rows["wide-736x416-b.mp4"].vertical
    head = b"\x89PNG\r\n\x1a\n\x00\x00\x00\rIHDR" + (300).to_bytes(4, "big") + (200).to_bytes(4, "big") + b"rest"
    df = spark.createDataFrame([(1, bytearray(head)), (2, bytearray(b"GIF" + head)), (3, bytearray(head[:20]))], "id int, content binary")
    got = {r.id: r.d for r in df.select("id", N.png_dims("content").alias("d")).collect()}
    assert (got[1].width, got[1].height) == (300, 200) and got[2] is None and got[3] is None


def test_sinks(spark, folder):
    df = spark.createDataFrame([("a", 1, None), ("b", 2, "x")], "name string, n int, note string")
    S.write_report(df, folder + "/r")
    assert spark.read.csv(folder + "/r", sep="\t", header=True).count() == 2
    S.write_manifests(df, folder + "/m", by="name")
    assert spark.read.json(folder + "/m").filter("note is null").count() == 1
    S.publish(df, folder + "/p", "1")
    S.publish(df.limit(1), folder + "/p", "2")
    assert S.read_version(spark, folder + "/p").count() == 1 and S.read_version(spark, folder + "/p", "1").count() == 2
    with pytest.raises(Exception):
        S.publish(df, folder + "/p", "1")


def test_captions_lose_no_word(spark):
    text = "La vicepresidenta presentó anticonstitucionalmente un plan de vivienda en EE.UU."
    df = spark.createDataFrame([(1, text, 0.0, 10.0)], "id int, text string, t0 double, t1 double")
    rows = T.spread_text(df, ["id"], "text").orderBy("part").collect()
    assert " ".join(r.text.replace("\n", " ") for r in rows) == text.rstrip(".")
    assert rows[0].t0 == 0.0 and abs(rows[-1].t1 - 10.0) < 1e-9
    assert all(len(line) <= 15 or " " not in line for r in rows for line in r.text.split("\n"))
    assert all(len(r.text.split("\n")) <= 2 for r in rows)


def test_html_and_sentences(spark):
    row = spark.range(1).select(
        X.strip_html(F.lit("<script>x</script><p>A&lt;b&gt; &amp; c</p>")).alias("h"),
        X.sentences(F.lit("El Sr. Pérez viajó a EE.UU. ayer. ¿Volverá? «Sí».")).alias("s")).first()
    assert row.h == "A<b> & c"
    assert row.s == ["El Sr. Pérez viajó a EE.UU. ayer.", "¿Volverá?", "Sí»."]
