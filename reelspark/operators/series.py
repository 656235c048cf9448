"""Time-series quality analysis: medians, spikes, silences, coverage, drift, chains, scores."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.numeric import falling_score, first_match, noise_grade, two_sided_score
from .ordered import OrderedGroups, medians, numbered, ordered, top_per_group, value_ranks


def round_at(x, digits: int) -> Column:
    """Half-even rounding on the binary value, the same in every engine."""
    scale = float(10 ** digits)
    return F.rint((F.col(x) if isinstance(x, str) else x) * scale) / scale


def entropy(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Shannon entropy in bits of the value histogram per group.

    H = log2 N − Σ c·log2 c / N needs no second pass over the rows.
    """
    hist = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("c"))
    c = F.col("c").cast("double")
    return hist.groupBy(*keys).agg(
        F.sum("c").alias("n"),
        (F.log2(F.sum(c)) - F.sum(c * F.log2(c)) / F.sum(c)).alias("entropy"))


def spike_threshold(series: DataFrame, keys: list[str], value: str = "v",
                    max_rows: int | None = None) -> DataFrame:
    """Upper median plus four population deviations, at least ten above the median.

    One histogram gives median, deviation, peak and mean square: rows are read once.  Its sums stand beside
    every value, so the second moment is taken about the mean (no large numbers cancel) without a join.
    """
    c, v = F.col("c"), F.col(value)
    mean = F.col("_sum") / F.col("n")
    stats = value_ranks(series, keys, value, max_rows, _sum=v * c).groupBy(*keys).agg(
        F.max("n").alias("n"),
        F.min(F.when(F.col("cum") >= F.floor(F.col("n") / 2) + 1, v)).alias("median"),
        F.sqrt(F.sum(c * (v - mean) ** 2) / F.max("n")).alias("deviation"),
        F.max(v).alias("peak"), (F.sum(c * v * v) / F.max("n")).alias("mean_square"))
    return stats.select(
        *keys, "n", "median", "deviation", "peak", "mean_square",
        (F.col("median") + F.greatest(K.SPIKE_SIGMAS * F.col("deviation"),
                                      F.lit(K.SPIKE_MIN_RISE))).alias("threshold"))


def spike_groups(series: DataFrame, thresholds: DataFrame, keys: list[str], t: str = "t",
                 v: str = "v", gap: float = K.SPIKE_GAP_SECONDS, max_rows: int | None = None) -> DataFrame:
    """Rows above the threshold, grouped while they follow each other within `gap`.

    Times are rounded before the gap test; only spikes reach the shuffle.
    """
    spikes = (series.join(thresholds.select(*keys, "threshold"), keys)
              .filter(F.col(v) > F.col("threshold"))
              .select(*keys, round_at(t, 2).alias("t"), round_at(v, 1).alias("v")))
    return islands(spikes, keys, ["t", "v"], "t", gap, max_rows).groupBy(*keys, "group_no").agg(
        F.min("t").alias("start"), F.max("v").alias("spike"), F.count(F.lit(1)).alias("n_rows"))


def islands(df: DataFrame, keys: list[str], order: list[str], t: str, gap: float,
            max_rows: int | None = None, name: str = "group_no", closed: bool = False) -> DataFrame:
    """Number runs of rows whose distance to the previous row is at most `gap` (less than, if closed)."""
    groups = OrderedGroups.plan(df, keys, order, max_rows)
    lagged = groups.add(groups.tag(df), lag={"_prev": t})
    step = F.col(t) - F.col("_prev")
    opens = F.when(F.col("_prev").isNull() | (step >= gap if closed else step > gap), 1).otherwise(0)
    return groups.untag(groups.add(lagged, running={name: opens})).drop("_prev")


def spot_report(series: DataFrame, keys: list[str], gap: float = K.SPIKE_GAP_SECONDS,
                max_rows: int | None = None) -> DataFrame:
    """Per clip: median, threshold, peak, mean square, number of spike groups and the verdict."""
    thresholds = spike_threshold(series, keys, max_rows=max_rows)
    counts = (spike_groups(series, thresholds, keys, gap=gap, max_rows=max_rows).groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("spots"), F.sum("n_rows").alias("spike_rows")))
    spots = F.coalesce(F.col("spots"), F.lit(0))
    return thresholds.join(counts, keys, "left").select(
        *keys, "n", "median", "threshold", "peak", "mean_square",
        F.coalesce("spike_rows", F.lit(0)).cast("bigint").alias("spike_rows"),
        spots.cast("bigint").alias("spots"), spot_verdict(spots).alias("verdict"))


def spot_verdict(spots: Column) -> Column:
    return first_match([(spots == 0, "LIMPIO"), (spots == 1, "MANCHA AISLADA")], "ABERRACIONES")


def decibels(mean_square: Column) -> Column:
    return 20 * F.log10(F.sqrt(mean_square))


def rms_level(df: DataFrame, keys: list[str], value: str = "v") -> DataFrame:
    """Root mean square in dB with its noise grade."""
    level = decibels(F.avg(F.col(value) * F.col(value)))
    return df.groupBy(*keys).agg(level.alias("rms_db")).withColumn(
        "grade", noise_grade("rms_db")).withColumn("clean", F.col("rms_db") <= K.NOISE_CLEAN_DB)


def level_of(value: Column) -> Column:
    """Level of one sample in dB; a sample of zero lies below every level."""
    return F.when(value == 0, F.lit(float("-inf"))).otherwise(20 * F.log10(value))


def silence_levels(samples: DataFrame, keys: list[str], t: str = "t", value: str = "v",
                   below: float = K.SILENCE_BELOW_RMS_DB) -> DataFrame:
    """(keys, duration, threshold_db): a clip's last time, and the level under which its samples are silent.

    The level follows the clip's own loudness, to a tenth of a decibel; a clip that has none gets a fixed one.
    """
    level = decibels(F.avg(F.col(value) * F.col(value))) - below
    return samples.groupBy(*keys).agg(
        F.max(t).alias("duration"), F.coalesce(round_at(level, 1), F.lit(K.SILENCE_WITHOUT_RMS_DB)).alias("threshold_db"))


def silences(levels: DataFrame, keys: list[str], t: str = "t", level: str = "level_db",
             threshold: str = "threshold_db", min_length: float = K.SILENCE_MIN_SECONDS,
             ties: tuple[str, ...] = (), max_rows: int | None = None) -> DataFrame:
    """Runs of consecutive rows under the threshold that last at least `min_length`.

    A run ends at the next row that is not under; an unclosed run ends with the clip.
    ties: columns that order rows of equal times.
    """
    under = levels.select(*keys, t, *ties, (F.col(level) < F.col(threshold)).alias("_under"))
    groups = OrderedGroups.plan(under, keys, [t, *ties], max_rows)
    near = groups.add(groups.tag(under), lag={"_before": "_under"}, lead={"_next": t})
    opens = (F.col("_under") & ~F.coalesce(F.col("_before"), F.lit(False))).cast("int")
    runs = groups.untag(groups.add(near, running={"run": opens})).filter("_under")
    return (runs.groupBy(*keys, "run")
            .agg(F.min(t).alias("t0"), F.max(F.coalesce("_next", t)).alias("t1"))
            .filter(F.col("t1") - F.col("t0") >= min_length))


def _decimals(x: Column) -> Column:
    """Two decimals of the binary value, as C prints them; `format_string` rounds its shortest decimal form."""
    return F.call_function("format_number", x, F.lit("0.00"))


def coverage(intervals: DataFrame, clips: DataFrame, keys: list[str], duration: str = "duration",
             first: int = 12, longest_allowed: float = K.LONGEST_SILENCE, max_rows: int | None = None) -> DataFrame:
    """Share of each clip that is not silent, the longest silence, the first ones, and the verdict."""
    length = F.col("t1") - F.col("t0")
    shown = F.when(F.col("_k") <= first, F.struct("t0", "t1"))                # nulls are not collected
    total = numbered(intervals, keys, ["t0"], "_k", max_rows).groupBy(*keys).agg(
        F.sum(length).alias("silent"), F.max(length).alias("longest"), F.count(F.lit(1)).alias("n_silences"),
        F.array_join(F.transform(F.array_sort(F.collect_list(shown)),
                                 lambda s: F.concat(_decimals(s["t0"]), F.lit("-"), _decimals(s["t1"]))), " ").alias("first_silences"))
    d = F.col(duration)
    out = (clips.select(*keys, duration).join(total, keys, "left")
           .withColumn("silent", F.coalesce("silent", F.lit(0.0)))
           .withColumn("longest", F.coalesce("longest", F.lit(0.0)))
           .withColumn("n_silences", F.coalesce("n_silences", F.lit(0)).cast("bigint"))
           .withColumn("first_silences", F.coalesce("first_silences", F.lit("")))
           .withColumn("coverage", F.when(d != 0, 100 * (d - F.col("silent")) / d).otherwise(F.lit(0.0))))
    return out.withColumn("verdict", coverage_verdict(F.col("coverage"), F.col("longest"), longest_allowed))


def coverage_verdict(share: Column, longest: Column, longest_allowed: float = K.LONGEST_SILENCE) -> Column:
    return first_match([(share < K.COVERAGE_MUTE, "MUDO"), (longest > longest_allowed, "CORTADO"),
                        (share > K.COVERAGE_RUSHED, "ATROPELLADO")], "OK")


def drift(series: DataFrame, keys: list[str], order: list[str], values: list[str],
          max_rows: int | None = None) -> DataFrame:
    """Percent change between the upper medians of the first and the last third, per value."""
    placed = ordered(series, keys, order, max_rows, row_number="_pos", total={"_n": F.lit(1)})
    third = F.greatest(F.lit(2), F.floor(F.col("_n") / 3))
    part = F.when(F.col("_pos") <= third, "first").when(F.col("_pos") > F.col("_n") - third, "last")
    # overlapping thirds do not occur: at least six rows are required
    ends = placed.filter(F.col("_n") >= K.DRIFT_MIN_ROWS).withColumn("_part", part).filter("_part is not null")
    long = ends.select(*keys, "_part", "_n", F.explode(F.create_map(
        *[x for v in values for x in (F.lit(v), F.col(v).cast("double"))])).alias("measure", "value"))
    mids = medians(long, [*keys, "_part", "measure"], "value", max_rows)
    one = lambda part: F.max(F.when(F.col("_part") == part, F.col("median_high")))
    return (mids.groupBy(*keys, "measure").agg(one("first").alias("m_first"), one("last").alias("m_last"))
            .withColumn("drift_pct", 100 * (F.col("m_last") - F.col("m_first")) / F.col("m_first")))


def drift_report(series: DataFrame, keys: list[str], order: list[str], tone: str, edges: str,
                 max_rows: int | None = None) -> DataFrame:
    d = drift(series, keys, order, [tone, edges], max_rows)
    pick = lambda m: F.max(F.when(F.col("measure") == m, F.col("drift_pct")))
    out = d.groupBy(*keys).agg(pick(tone).alias("tone_pct"), pick(edges).alias("edges_pct"))
    return out.withColumn("verdict", drift_verdict(F.greatest(F.abs("tone_pct"), F.abs("edges_pct"))))


def drift_verdict(worst: Column) -> Column:
    return first_match([(worst < K.DRIFT_STABLE, "ESTABLE"), (worst < K.DRIFT_LIGHT, "DERIVA LEVE")], "DERIVA")


def link_verdict(excess: Column, score: Column) -> Column:
    return first_match([(F.coalesce(score < K.MIN_SHOT_SCORE, F.lit(False)), "REGENERAR"),
                        (excess <= K.EXCESS_OK, "OK"), (excess <= K.EXCESS_REANCHOR, "REANCLAR")], "REGENERAR")


def background_verdict(deviation: Column, mean: Column) -> Column:
    return first_match([((deviation < 6) & (mean < 8), "NEGRO"), (deviation < 12, "CASI NEGRO")], "CON OBJETOS")


def _percent(change: Column, of: Column) -> Column:
    """100 * change / of as floating point defines it: of zero, infinite in the direction of the change, or NaN."""
    return (F.when(of != 0, 100 * change / of).when(change > 0, F.lit(float("inf")))
            .when(change < 0, F.lit(float("-inf"))).when(change == 0, F.lit(float("nan"))))


def chain_links(shots: DataFrame, keys: list[str], order: list[str], max_rows: int | None = None,
                zero_is_missing: bool = True) -> DataFrame:
    """Each shot against its successor.

    shots: edge_first, edge_last, entropy_first, score.  The reference is the first edge value
    of the chain; null measures give null jumps.  So do zeros, where zero_is_missing; else they
    are measures, and a change from zero is infinite (none: NaN).
    """
    if zero_is_missing:
        shots = shots.withColumns({c: F.when(F.col(c) != 0, F.col(c)) for c in ("edge_first", "edge_last", "entropy_first")})
    nexts = {"_next_edge": "edge_first", "_next_entropy": "entropy_first", "_next_score": "score",
             "to_shot": order[0]}
    linked = ordered(shots, keys, order, max_rows, lead=nexts).filter(F.col("to_shot").isNotNull())
    ref = shots.groupBy(*keys).agg(F.min_by("edge_first", F.struct(*order)).alias("ref_edge"))

    last = F.col("edge_last")
    excess = F.when(last.isNotNull(), _percent(last - F.col("ref_edge"), F.col("ref_edge"))).otherwise(F.lit(0.0))
    return linked.join(ref, keys).select(
        *keys, F.col(order[0]).alias("from_shot"), "to_shot", excess.alias("excess_pct"),
        _percent(F.col("_next_edge") - last, last).alias("edge_jump_pct"),
        _percent(F.col("_next_entropy") - F.col("entropy_first"), F.col("entropy_first")).alias("entropy_jump_pct"),
        link_verdict(excess, F.col("_next_score")).alias("verdict"))


def chain_summary(links: DataFrame, shots: DataFrame, keys: list[str]) -> DataFrame:
    """Mean and worst score, the worst link among those not OK, and the action it asks for."""
    scores = shots.groupBy(*keys).agg(F.avg("score").alias("mean_score"), F.min("score").alias("worst_score"))
    # the first of equal excesses wins
    rank = F.struct(F.col("excess_pct"), -F.col("from_shot"))
    worst = (links.filter(F.col("verdict") != "OK").groupBy(*keys)
             .agg(F.max_by(F.struct("from_shot", "excess_pct", "verdict"), rank).alias("w")))
    return scores.join(worst, keys, "left").select(
        *keys, "mean_score", "worst_score", F.col("w.from_shot").alias("worst_from"),
        F.col("w.excess_pct").alias("worst_excess"),
        F.coalesce("w.verdict", F.lit("NINGUNA")).alias("action"))


def quality_score(samples: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Six-block score, 0–100, of each clip from its ordered samples.

    samples: entropy, edges, chroma, grain, floor_db, jump_ratio (any may be null).
    Null samples are skipped, so first and last are the outermost measured ones.
    """
    at = F.col(position)

    def first(c):
        return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), at))

    def last(c):
        return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at))

    agg = samples.groupBy(*keys).agg(
        F.count("entropy").alias("n_entropy"),
        first("entropy").alias("e0"), last("entropy").alias("e1"),
        first("edges").alias("b0"), last("edges").alias("b1"),
        first("chroma").alias("c0"), last("chroma").alias("c1"),
        first("grain").alias("g0"), F.max("grain").alias("gmax"),
        F.count("floor_db").alias("n_floor"), F.min("floor_db").alias("fmin"),
        F.max("floor_db").alias("fmax"), F.max("jump_ratio").alias("jump"))
    base = F.greatest(F.col("g0"), F.lit(0.35))
    excess = F.greatest(F.lit(0.0), (F.col("gmax") - base) / base)
    grain = (F.when(F.col("gmax").isNull(), F.lit(0.0)).when(F.col("gmax") <= 0.35, F.lit(20.0))
             .otherwise(falling_score(excess, 0.10, 0.80, 20.0)))
    audio = F.when(F.col("n_floor") >= 4, falling_score("fmin", -34.0, -18.0, 10.0)
                   + falling_score(F.col("fmax") - F.col("fmin"), 7.0, 16.0, 5.0)).otherwise(F.lit(0.0))
    joins = F.when(F.col("jump").isNull(), F.lit(10.0)).otherwise(falling_score("jump", 1.3, 4.0, 10.0))
    out = agg.filter(F.col("n_entropy") >= 4).select(
        *keys, two_sided_score("e0", "e1", 0.03, 0.20, 25.0).alias("gradation"),
        two_sided_score("b0", "b1", 0.05, 0.40, 20.0).alias("structure"), grain.alias("grain"),
        two_sided_score("c0", "c1", 0.10, 0.50, 10.0).alias("chroma"), audio.alias("audio"),
        joins.alias("transitions"))
    blocks = ["gradation", "structure", "grain", "chroma", "audio", "transitions"]
    return out.withColumn("total", sum((F.col(b) for b in blocks[1:]), F.col(blocks[0])))


def background_report(corners: DataFrame, keys: list[str]) -> DataFrame:
    """Mean, deviation and peak over corner measures, with the verdict."""
    out = corners.groupBy(*keys).agg(F.avg("mean").alias("mean"), F.avg("deviation").alias("deviation"),
                                     F.max("peak").alias("peak"))
    return out.withColumn("verdict", background_verdict(F.col("deviation"), F.col("mean")))


def compare_formats(series: DataFrame, format_col: str, keys: list[str], gap: float,
                    max_rows: int | None = None) -> DataFrame:
    """One row per format: clips, rows, spots, drift of tone and edges, verdict and noise level."""
    by = [format_col, *keys]
    spots = spot_report(series, by, gap, max_rows).groupBy(format_col).agg(
        F.count(F.lit(1)).alias("clips"), F.sum("n").alias("n_rows"), F.sum("spots").alias("spots"),
        decibels(F.sum(F.col("mean_square") * F.col("n")) / F.sum("n")).alias("rms_db"))
    d = drift_report(series.withColumn("edges", F.col("v") * F.col("v")), by, ["t"], "v", "edges", max_rows)
    drifts = d.groupBy(format_col).agg(F.avg("tone_pct").alias("tone_pct"), F.avg("edges_pct").alias("edges_pct"))
    return (spots.join(drifts, format_col, "left")
            .withColumn("verdict", drift_verdict(F.greatest(F.abs("tone_pct"), F.abs("edges_pct")))))


def first_per_group(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    return top_per_group(df, keys, order, n)


def positions(df: DataFrame, keys: list[str], order: list[str], max_rows: int | None = None) -> DataFrame:
    return numbered(df, keys, order, "idx", max_rows)
