"""One pass over script lines: fields and issues by hand, chunks of a script, and what the plan reads."""
import random

from reelspark.catalog import QUERIES
from reelspark.plans import scripts as C

LINES = "script_id int, line_no int, line string"


def test_fields_and_issues_by_hand(spark):
    rows = [(1, 1, " @TIPO  detalle "), (1, 2, "@ESCENA uno"), (1, 3, "@ESCENA dos"), (1, 4, "@MUSICA"), (1, 5, "@AMBIENTE a\0b"),
            (1, 6, "TOMA| frames=22 |frames=39| ancla "), (1, 7, "HABLA|x|frames=5|inicio|frames=6"), (1, 8, "TOMA|x|a|b|c|d|e"), (1, 9, "TOMA|x|a|b|c|d|e|f"),
            (1, 10, "HABLA| |ancla:1"), (1, 11, "  # nota"), (1, 12, "HABLA|y|ancla:anclas/a.png|habla| plaza "), (1, 13, "TOMA|z|ancla:9|cantado||frames=7"),
            (1, 14, "TOMA|w|ancla:99999999999999999999"), (1, 15, " "), (2, 1, "suelta"), (3, 1, "# nota"), (4, 1, "@TIPO opera"), (4, 2, "TOMA|a")]
    headers, takes, issues = C.parse(spark.createDataFrame(rows, LINES))
    assert sorted(map(tuple, headers.collect())) == [(1, "ESCENA", 2, "uno"), (1, "TIPO", 1, "detalle"), (4, "TIPO", 1, "opera")]
    got = [(r.script_id, r.line_no, r.idx, r.content, r.take_type, r.mode, r.anchor_source, r.mode_warning, r.own_frames, r.scene) for r in takes.collect()]
    assert sorted(got) == [
        (1, 6, 1, "frames=22", "detalle", "inicio", None, None, 39, "uno"), (1, 12, 2, "y", "habla", "ancla:1", 1, "legacy_mode", None, "plaza"),
        (1, 13, 3, "z", "cantado", None, None, None, 7, "uno"), (1, 14, 4, "w", "detalle", None, None, None, None, "uno"),
        (4, 2, 1, "a", "opera", "inicio", None, None, None, None)]
    missing = ["missing_ambiente", "missing_escena", "missing_musica"]
    assert sorted((r.script_id, r.line_no or 0, r.issue) for r in issues.collect()) == sorted(
        [(1, 0, "missing_ambiente"), (1, 0, "missing_musica"), (1, 3, "duplicate_header"), (1, 4, "bad_header"), (1, 5, "nul_byte"),
         (1, 7, "repeated_frames"), (1, 8, "too_many_positional"), (1, 9, "field_count"), (1, 10, "empty_content"), (1, 13, "unknown_type"),
         (1, 13, "points_forward"), (1, 13, "frames_off_ladder"), (1, 14, "anchor_out_of_range"), (2, 0, "no_takes"), (2, 1, "unexpected_line"),
         (4, 1, "unknown_default_type"), (4, 2, "unknown_type")] + [(s, 0, m) for s in (2, 4) for m in missing])


def test_chunks_of_a_script(spark):
    r = random.Random(5)
    kinds = ["@TIPO habla", "@TIPO opera", "@ESCENA a", "@AMBIENTE b", "@MUSICA c", "# nota", "suelta", "HABLA|a|ancla:3", "TOMA|b", "TOMA|c|encadena|detalle||frames=7"]
    rows = [(s, i, r.choice(kinds)) for s in range(4) for i in range(1, 60)] + [(9, 1, "TOMA|a")]
    df = spark.createDataFrame(rows, LINES)
    for whole, cut in zip(C.parse(df), C.parse(df, max_rows=7)):
        assert whole.columns == cut.columns
        assert sorted(map(repr, whole.collect())) == sorted(map(repr, cut.collect()))


def test_lines_are_read_once(spark, sf):
    """Issues need no join of the lines with their own script, and headers need no order."""
    plan = lambda name: QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan("script_issues") and "Join" not in plan("script_takes")
    assert "_tail" not in plan("script_headers") and "_tail" not in plan("missing_headers")
