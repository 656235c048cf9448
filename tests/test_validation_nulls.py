from reelspark.operators import validation as V


def test_missing_measures_break_their_rules(spark):
    clips = spark.createDataFrame([(1, None, None, None, None, None, None, None), (2, 10, 416, 736, True, 24, 24.0, 1.0)],
                                  "k int, bytes long, width int, height int, has_audio boolean, frames int, fps double, duration double")
    expected = spark.createDataFrame([(k, 416, 736, 24, 24.0) for k in (1, 2, 3)],
                                     "k int, width_exp int, height_exp int, frames_exp int, fps_exp double")
    found = {}
    for r in V.check_clips(clips, expected, ["k"], 1).collect():
        found.setdefault(r.k, set()).add(r.issue)
    assert found == {1: {"too_small", "width", "height", "no_audio", "frame_count", "frame_rate", "no_duration", "duration"},
                     3: {"missing_clip"}}


def test_delivery_without_measures(spark):
    rows = spark.createDataFrame([("b", "dia-x", "x", None, 1.0, None, 1920, None, None)],
                                 "batch string, name string, story string, bytes long, duration double, width int, height int, has_audio boolean, lufs double")
    issues = {r.issue for r in V.accept_deliveries(rows, "batch", 1).collect()}
    assert {"no_audio", "too_small", "size", "loudness_unknown"} <= issues
