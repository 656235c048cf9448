"""Column functions over numbers: ladder, pacing, memory, scores, pose, names and times."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .text import _c, word_count


def clamp(x, low=0.0, high=1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), _c(x)))


def round_scaled(x, places: int) -> Column:
    """x rounded as SQL's round of a floating-point number: scaled, rounded half away from zero, scaled back.

    Spark's own round takes the shortest decimal that names the number, so beside a tie the two may differ by one unit."""
    scale = 10.0 ** places
    return F.round(_c(x) * scale) / scale


# --- frame ladder -------------------------------------------------------------
def ladder_valid(frames) -> Column:
    f = _c(frames)
    return (f >= K.LADDER_BASE) & (f <= K.INT32_MAX) & ((f - K.LADDER_BASE) % K.LADDER_STEP == 0)


def ladder_floor(frames) -> Column:
    f = _c(frames)
    return F.floor((f - K.LADDER_BASE) / K.LADDER_STEP) * K.LADDER_STEP + K.LADDER_BASE


def ladder_above(frames) -> Column:
    """The next rung above the floor rung, as a probe lists it for an invalid value."""
    return ladder_floor(frames) + K.LADDER_STEP


def nearest_rung(seconds, maximum=K.FRAMES_MAX) -> Column:
    """Ladder rung whose duration is nearest; the smaller one on a tie."""
    top = (F.lit(maximum) if isinstance(maximum, int) else _c(maximum))
    k_max = F.floor((top - K.FRAMES_MIN) / K.LADDER_STEP)
    k = F.ceil((_c(seconds) * K.FPS - K.FRAMES_MIN) / K.LADDER_STEP - 0.5)
    k = F.greatest(F.lit(0), F.least(k_max, k))
    return (K.FRAMES_MIN + K.LADDER_STEP * k).cast("int")


def spoken_seconds(n_words) -> Column:
    return _c(n_words) / K.WORDS_PER_SECOND + K.TAIL_SECONDS


def frames_for_words(n_words, maximum=K.FRAMES_MAX) -> Column:
    return nearest_rung(spoken_seconds(n_words), maximum)


def speech_rate(text, seconds) -> Column:
    s = _c(seconds)
    return F.when(s > 0, word_count(text) / s).otherwise(F.lit(0.0))


def rate_band(rate) -> Column:
    r = _c(rate)
    return F.when(r > K.RATE_MAX, "rushed").when(r < K.RATE_MIN, "slack").otherwise("ok")


# --- memory -------------------------------------------------------------------
MIB_PER_PIXEL_FRAME = K.MIB_PER_FRAME_416X736 / (K.BASE_WIDTH * K.BASE_HEIGHT)


def frames_that_fit(width, height, free_mib) -> Column:
    room = _c(free_mib) - K.MIB_BASE - K.MIB_MARGIN
    raw = F.floor(room / (_c(width) * _c(height) * MIB_PER_PIXEL_FRAME))
    return F.when(room <= 0, F.lit(K.FRAMES_MIN)).otherwise(
        F.greatest(F.lit(K.FRAMES_MIN), ladder_floor(raw))).cast("int")


def one_take_format(n_words, free_mib=K.MIB_BUDGET) -> Column:
    """Struct of frames, width and height at which this many words fit in one take."""
    raw = F.floor((F.rint(spoken_seconds(n_words) * K.FPS) - K.LADDER_BASE) / K.LADDER_STEP)
    frames = (raw + 1) * K.LADDER_STEP + K.LADDER_BASE
    frames = F.least(F.lit(K.FRAMES_MEASURED), F.greatest(F.lit(K.FRAMES_MIN), frames))
    room = _c(free_mib) - K.MIB_BASE - K.MIB_MARGIN
    px = room / (frames * MIB_PER_PIXEL_FRAME)
    high = F.floor(F.sqrt(px * 16 / 9) / 16) * 16
    wide = F.floor(high * 9 / 16 / 16) * 16
    roomy = (room <= 0) | (px >= K.BASE_WIDTH * K.BASE_HEIGHT)
    return F.struct(
        F.when(room <= 0, F.lit(K.FRAMES_MIN)).otherwise(frames).cast("int").alias("frames"),
        F.when(roomy, F.lit(K.BASE_WIDTH)).otherwise(F.greatest(F.lit(16), wide)).cast("int").alias("width"),
        F.when(roomy, F.lit(K.BASE_HEIGHT)).otherwise(F.greatest(F.lit(16), high)).cast("int").alias("height"))


def memory_ceiling_mib(free_mib) -> Column:
    f = _c(free_mib)
    share = F.floor(f * K.MEMORY_FRACTION)
    return F.greatest(F.lit(0), F.least(share, f - K.MEMORY_CUSHION_MIB)).cast("bigint")


def memory_budget_gb(frames, width, height, free_mib, anchored) -> Column:
    rate = F.when(_c(anchored), F.lit(K.BUFFER_MIB_PER_PIXEL_FRAME_ANCHORED)).otherwise(
        F.lit(K.BUFFER_MIB_PER_PIXEL_FRAME))
    buffer = F.floor(_c(frames) * _c(width) * _c(height) * rate).cast("bigint")
    left = memory_ceiling_mib(free_mib) - buffer
    # integer division truncates toward zero; anything below one is clamped to one anyway
    return F.greatest(F.lit(1), F.least(F.lit(K.MEMORY_CAP_GB), F.floor(left / 1024))).cast("int")


# --- predicates -----------------------------------------------------------------
def is_voice(take_type) -> Column:
    return _c(take_type).isin(list(K.VOICE_TYPES))


def valid_http_url(url) -> Column:
    u = _c(url)
    host = F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.coalesce(F.lower(u).rlike("^https?:") & (host != ""), F.lit(False))


def audio_ok(lufs, true_peak, sample_peak) -> Column:
    return ((F.abs(_c(lufs) - K.LUFS_TARGET) <= K.LUFS_TOLERANCE)
            & (_c(true_peak) <= K.TRUE_PEAK_MAX) & (_c(sample_peak) <= K.SAMPLE_PEAK_MAX))


def delivery_audio_ok(lufs, target=K.DELIVERY_LUFS, tolerance=K.DELIVERY_TOLERANCE) -> Column:
    return F.abs(_c(lufs) - target) <= tolerance


def aspect_ok(width, height, ratio: float = 9 / 16, tolerance: float = 0.02) -> Column:
    return F.abs(_c(width) / _c(height) - ratio) <= tolerance


# --- scores -----------------------------------------------------------------------
def two_sided_score(reference, value, tolerance: float, limit: float, points: float) -> Column:
    """Full points within the tolerance, none past the limit, linear between."""
    ref, val = _c(reference), _c(value)
    d = F.abs(val - ref) / F.abs(ref)
    return (F.when(ref.isNull() | val.isNull() | (ref == 0), F.lit(0.0))
            .when(d <= tolerance, F.lit(float(points)))
            .when(d >= limit, F.lit(0.0))
            .otherwise(points * (1 - (d - tolerance) / (limit - tolerance))))


def falling_score(value, full_at: float, zero_at: float, points: float) -> Column:
    """Full points up to `full_at`, none from `zero_at`, linear between."""
    v = _c(value)
    return (F.when(v <= full_at, F.lit(float(points))).when(v >= zero_at, F.lit(0.0))
            .otherwise(points * (1 - (v - full_at) / (zero_at - full_at))))


def noise_grade(level_db) -> Column:
    return clamp((K.NOISE_ZERO_DB - _c(level_db)) / 10 * 10, 0.0, 10.0)


def sharpness_score(value) -> Column:
    low, high = F.log1p(F.lit(K.SHARPNESS_MIN)), F.log1p(F.lit(K.SHARPNESS_TOP))
    return clamp((F.log1p(F.greatest(F.lit(0.0), _c(value))) - low) / (high - low))


def candidate_score(mouth, frontal, sharpness, velocity, confidence,
                    confidence_min: float = K.CONFIDENCE_MIN) -> Column:
    return (0.36 * _c(mouth) + 0.22 * _c(frontal) + 0.18 * sharpness_score(sharpness)
            + 0.18 * F.exp(-_c(velocity) / K.VELOCITY_SCALE)
            + 0.06 * clamp((_c(confidence) - confidence_min) / (1 - confidence_min)))


# --- geometry -----------------------------------------------------------------------
def tilt(ax, ay, bx, by) -> Column:
    angle = F.abs(F.degrees(F.atan2(by - ay, bx - ax)))
    return F.least(angle, F.abs(180.0 - angle))


def pose(points: list[tuple[Column, Column]]) -> Column:
    """Pose measures from five landmarks: two eyes, nose, two mouth corners."""
    (eax, eay), (ebx, eby), (nx, ny), (max_, may), (mbx, mby) = points
    eye_y, mouth_y = (eay + eby) / 2, (may + mby) / 2
    da, db = F.hypot(nx - eax, ny - eay), F.hypot(nx - ebx, ny - eby)
    yaw = F.abs(da - db) / F.greatest(F.lit(1e-6), da + db)
    nose = (ny - eye_y) / F.greatest(F.lit(1e-6), mouth_y - eye_y)
    eye_tilt, mouth_tilt = tilt(eax, eay, ebx, eby), tilt(max_, may, mbx, mby)
    penalty = (0.34 * clamp(eye_tilt / K.EYE_TILT_MAX) + 0.14 * clamp(mouth_tilt / K.MOUTH_TILT_MAX)
               + 0.36 * clamp(yaw / K.YAW_MAX)
               + 0.16 * clamp(F.abs(nose - K.NOSE_CENTRE) / K.NOSE_SPREAD))
    return F.struct(eye_tilt.alias("eye_tilt"), mouth_tilt.alias("mouth_tilt"), yaw.alias("yaw"),
                    nose.alias("nose_ratio"), clamp(1.0 - penalty).alias("frontal"))


def box_area_share(w, h, frame_width, frame_height) -> Column:
    zero = F.lit(0.0)
    return (F.greatest(zero, _c(w)) * F.greatest(zero, _c(h))
            / F.greatest(F.lit(1.0), _c(frame_width) * _c(frame_height)))


def box_extreme(x, y, w, h, frame_width, frame_height) -> Column:
    """Box within 1 % of an edge, or with an area outside 2.5–80 % of the frame."""
    x, y, w, h, fw, fh = (_c(v) for v in (x, y, w, h, frame_width, frame_height))
    cut = (x < 0.01 * fw) | (y < 0.01 * fh) | (x + w > fw - 0.01 * fw) | (y + h > fh - 0.01 * fh)
    area = box_area_share(w, h, fw, fh)
    return cut | (area < 0.025) | (area > 0.80)


def crop_box(width, height, region: str) -> Column:
    fx, fy, fw, fh = K.REGIONS[region]
    w, h = _c(width), _c(height)
    return F.struct(F.floor(w * fx).cast("int").alias("x"), F.floor(h * fy).cast("int").alias("y"),
                    F.floor(w * fw).cast("int").alias("w"), F.floor(h * fh).cast("int").alias("h"))


# --- names and times --------------------------------------------------------------------
def timestamp_hms(seconds) -> Column:
    ms = F.greatest(F.lit(0), F.rint(_c(seconds) * 1000).cast("bigint"))

    def two(x):
        return F.lpad(x.cast("string"), 2, "0")

    hours = F.floor(ms / 3600000).cast("bigint")
    hour_text = F.when(hours < 100, two(hours)).otherwise(hours.cast("string"))
    return F.concat(hour_text, F.lit(":"), two(F.floor(ms / 60000).cast("bigint") % 60), F.lit(":"),
                    two(F.floor(ms / 1000).cast("bigint") % 60), F.lit("."),
                    F.lpad((ms % 1000).cast("string"), 3, "0"))


SRT_STAMP = r"(\d+):(\d+):(\d+)[,.](\d+)\s+-->\s+(\d+):(\d+):(\d+)[,.](\d+)"


def srt_seconds(line, first_group: int) -> Column:
    """Seconds of one side of an SRT time line; milliseconds are padded or cut to three digits."""
    part = [F.regexp_extract(line, SRT_STAMP, first_group + i) for i in range(4)]
    ms = F.substring(F.rpad(part[3], 3, "0"), 1, 3)
    return (part[0].cast("bigint") * 3600 + part[1].cast("bigint") * 60 + part[2].cast("bigint")
            + ms.cast("double") / 1000)


def story_key(name) -> Column:
    """The name before its size: of the sizes in K.STORY_SIZES, the first listed one that occurs decides."""
    whole, cut = _c(name), None
    for size in K.STORY_SIZES:
        here, before = F.contains(whole, F.lit(size)), F.substring_index(whole, size, 1)
        cut = F.when(here, before) if cut is None else cut.when(here, before)
    return cut.otherwise(whole)


def name_dims(name) -> Column:
    """Width and height written in a file name as `-WxH-`."""
    def part(i):
        return F.regexp_extract(_c(name), r"-(\d+)x(\d+)-", i).try_cast("int")

    return F.struct(part(1).alias("width"), part(2).alias("height"))


def png_dims(content) -> Column:
    """Width and height from a PNG header, or null when the header is not a valid one."""
    head = F.hex(F.substring(_c(content), 1, 24))

    def number(at):
        return F.conv(F.substring(head, at, 8), 16, 10).cast("bigint")

    w, h = number(33), number(41)
    ok = (head.startswith("89504E470D0A1A0A") & (F.substring(head, 25, 8) == "49484452")
          & (F.length(head) == 48) & w.between(1, 16384) & h.between(1, 16384))
    return F.when(ok, F.struct(w.cast("int").alias("width"), h.cast("int").alias("height")))


def first_match(rules, default=None) -> Column:
    """Label of the first condition that holds, as one `when` chain."""
    rules = list(rules)
    chain = reduce(lambda acc, r: acc.when(r[0], F.lit(r[1])), rules[1:], F.when(rules[0][0], F.lit(rules[0][1])))
    return chain.otherwise(F.lit(default)) if default is not None else chain
