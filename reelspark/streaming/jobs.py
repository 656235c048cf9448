"""Structured Streaming jobs and their batch twins.

The rules know no event time.  Chosen here: ten minutes of lateness, later rows are dropped; state is
keyed by device or job name and expires with its timer.  Keyed streams use typed state: they take a
key's rows frame by frame, in whatever order micro-batches bring them, and need Spark's RocksDB state store.
"""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.ordered import ordered
from ..operators.series import islands
from ..sources.growing import PART_BYTES, GrowingText

LATENESS = "10 minutes"
LOW_MEMORY_MIB = 1200
ACTIVE_PHASES = ("planned", "waiting_resources", "generating", "mounting")
ALERT_SCHEMA = "device string, seq bigint, free double, alert string"
_TEXT_FIELDS, _COUNT_FIELDS = ("phase", "message", "final"), ("completed", "total")
_STATE_FIELDS = (*_TEXT_FIELDS, *_COUNT_FIELDS)
_KEPT = ("seq", "updates", "planned_at", *[x for f in _STATE_FIELDS for x in (f, f"{f}_at")])
STATE_SCHEMA = "name string, seq bigint, phase string, message string, final string, completed bigint, total bigint, updates bigint"


# --- low-memory alerts ---------------------------------------------------------------------
def alerts(samples: DataFrame, keys: list[str], order: list[str], free: str = "free", own: str = "own",
           threshold: float = LOW_MEMORY_MIB, max_rows: int | None = None) -> DataFrame:
    """Batch twin of the alert stream.

    An own breach acts every time; a foreign breach warns once per episode and recovery is told
    once.  Whether a foreign episode is open depends on the previous sample alone.
    """
    breach = F.col(free) < threshold
    tagged = samples.withColumn("_foreign", breach & ~F.col(own)).withColumn("_breach", breach)
    near = ordered(tagged, keys, order, max_rows, lag={"_before": "_foreign"})
    open_ = F.coalesce("_before", F.lit(False))
    alert = (F.when(F.col("_breach") & F.col(own), "act").when(F.col("_foreign") & ~open_, "warn")
             .when(~F.col("_breach") & open_, "recovered"))
    return near.withColumn("alert", alert).filter("alert is not null").select(*keys, *order, free, "alert")


_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _typed_state(stream: DataFrame) -> None:
    """Typed state is only kept by the RocksDB store."""
    name = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in stream.sparkSession.conf.get(name, ""):
        stream.sparkSession.conf.set(name, _ROCKSDB)


class AlertProcessor(StatefulProcessor):
    """Samples wait in slots of time until the watermark has passed their slot, and are then judged in order.

    State of a device: whether a foreign episode is open; for each waiting slot the number of its parts; and the
    parts, one for each frame of rows that came.  A device is never held as a whole, only one slot of it.
    """

    def __init__(self, threshold: float, slot_ms: int):
        self.threshold, self.slot_ms = threshold, slot_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "open boolean")
        self.parts = handle.getMapState("parts", "slot bigint", "parts int")
        self.waiting = handle.getMapState("waiting", "slot bigint, part int",
                                          "ms array<bigint>, seq array<bigint>, free array<double>, own array<boolean>")
        self.handle = handle

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for slot, part in frame.groupby(frame["ms"] // self.slot_ms):
                slot, had = int(slot), self.parts.getValue((int(slot),))
                n = had[0] if had else 0
                self.waiting.updateValue((slot, n), tuple(part[c].tolist() for c in ("ms", "seq", "free", "own")))
                self.parts.updateValue((slot,), (n + 1,))
                if not n:
                    self.handle.registerTimer((slot + 1) * self.slot_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        slot = expiredTimerInfo.getExpiryTimeInMs() // self.slot_ms - 1
        parts = []
        for n in range(self.parts.getValue((slot,))[0]):
            parts.append(pd.DataFrame(dict(zip(("ms", "seq", "free", "own"), self.waiting.getValue((slot, n))))))
            self.waiting.removeKey((slot, n))
        self.parts.removeKey((slot,))
        rows = pd.concat(parts).sort_values(["ms", "seq"])
        breach = rows["free"] < self.threshold
        foreign = breach & ~rows["own"]
        before = foreign.shift(1, fill_value=bool(self.open.exists() and self.open.get()[0]))
        rows["alert"] = None
        rows.loc[breach & rows["own"], "alert"] = "act"
        rows.loc[foreign & ~before, "alert"] = "warn"
        rows.loc[~breach & before, "alert"] = "recovered"
        self.open.update((bool(foreign.iloc[-1]),))
        rows["device"] = key[0]
        yield rows.loc[rows["alert"].notna(), ["device", "seq", "free", "alert"]]


def alert_stream(samples: DataFrame, threshold: float = LOW_MEMORY_MIB, lateness: str = LATENESS, slot_ms: int = 60_000) -> DataFrame:
    """Streaming form of `alerts`, by (ts, seq): columns device, seq, ts, free, own.  Null times or values are left out."""
    _typed_state(samples)
    rows = (samples.select("device", "seq", "ts", F.unix_millis("ts").alias("ms"), F.col("free").cast("double").alias("free"), "own")
            .dropna().withWatermark("ts", lateness))
    return rows.groupBy("device").transformWithStateInPandas(AlertProcessor(threshold, slot_ms), ALERT_SCHEMA, "append", "eventTime")


# --- job states ----------------------------------------------------------------------------
def latest_states(updates: DataFrame, name: str = "name", seq: str = "seq", alive: str | None = None) -> DataFrame:
    """State of every job after all its updates.

    Absent fields keep their value; a `planned` update first clears message and final.  Two
    map-side combined aggregates, so a job with very many updates stays spread over tasks.
    """
    at = F.col(seq)
    planned = updates.groupBy(name).agg(F.max(F.when(F.col("phase") == "planned", at)).alias("_planned"))
    both = updates.join(planned, name)
    since = F.col("_planned").isNull() | (at >= F.col("_planned"))
    last = lambda c, ok: F.max_by(F.col(c), F.when(F.col(c).isNotNull() & ok, at))
    out = both.groupBy(name).agg(
        F.max(at).alias("seq"), last("phase", F.lit(True)).alias("phase"), last("message", since).alias("message"),
        last("final", since).alias("final"), last("completed", F.lit(True)).alias("completed"), last("total", F.lit(True)).alias("total"))
    return out


def visible_phase(states: DataFrame, owner_alive: str) -> DataFrame:
    """An active phase whose owner is gone shows as interrupted."""
    gone = F.col("phase").isin(list(ACTIVE_PHASES)) & ~F.coalesce(F.col(owner_alive), F.lit(False))
    return states.withColumn("phase", F.when(gone, "interrupted").otherwise(F.col("phase")))


class JobStateProcessor(StatefulProcessor):
    """Latest known value of every field, each with the number of the update that gave it.

    The larger number wins, so updates may come in any order and any number of frames.
    """

    def __init__(self, silence_ms: int | None):
        self.silence_ms = silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        texts = ", ".join(f"{f} string, {f}_at bigint" for f in _TEXT_FIELDS)
        counts = ", ".join(f"{f} bigint, {f}_at bigint" for f in _COUNT_FIELDS)
        self.state = handle.getValueState("state", f"seq bigint, updates bigint, planned_at bigint, {texts}, {counts}")
        self.handle = handle

    def _row(self, name, state: dict, phase: str | None = None) -> pd.DataFrame:
        row = {f: state[f] for f in _STATE_FIELDS}
        for f in ("message", "final"):      # what was said before the job was planned anew is gone
            if state["planned_at"] is not None and state[f"{f}_at"] is not None and state[f"{f}_at"] < state["planned_at"]:
                row[f] = None
        row["phase"] = phase or row["phase"]
        out = pd.DataFrame([{"name": name, "seq": state["seq"], **row, "updates": state["updates"]}])
        return out.astype({f: "Int64" for f in _COUNT_FIELDS})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = dict(zip(_KEPT, self.state.get())) if self.state.exists() else dict.fromkeys(_KEPT)
        latest = lambda a, b: b if a is None else max(a, b)
        for frame in rows:
            state["updates"] = (state["updates"] or 0) + len(frame)
            state["seq"] = latest(state["seq"], int(frame["seq"].max()))
            planned = frame.loc[frame["phase"] == "planned", "seq"]
            if len(planned):
                state["planned_at"] = latest(state["planned_at"], int(planned.max()))
            for f in _STATE_FIELDS:
                said = frame.loc[frame[f].notna(), ["seq", f]]
                if len(said):
                    at = said["seq"].idxmax()
                    if state[f"{f}_at"] is None or said.at[at, "seq"] >= state[f"{f}_at"]:
                        value = said.at[at, f]
                        state[f], state[f"{f}_at"] = value if f in _TEXT_FIELDS else int(value), int(said.at[at, "seq"])
        self.state.update(tuple(state[n] for n in _KEPT))
        if self.silence_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.silence_ms)
        yield self._row(key[0], state)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = dict(zip(_KEPT, self.state.get()))
        self.state.clear()
        if state["phase"] in ACTIVE_PHASES:
            yield self._row(key[0], state, "interrupted")


def state_stream(updates: DataFrame, silence_ms: int | None = 600_000) -> DataFrame:
    """Upserts per job; the one with most `updates` is its newest.

    A job in an active phase that stays silent is reported as interrupted once.  Spark looks at such timers in
    batch after batch, so a query that is to end by itself (`drain`) takes `silence_ms=None`: no timers, and
    states that stay.  Updates without a number are left out.
    """
    _typed_state(updates)
    rows = updates.select(F.col("name").cast("string").alias("name"), "seq", *_STATE_FIELDS).filter("seq is not null")
    return rows.groupBy("name").transformWithStateInPandas(
        JobStateProcessor(silence_ms), STATE_SCHEMA, "update", "none" if silence_ms is None else "processingTime")


# --- windows ---------------------------------------------------------------------------------
def usage_windows(samples: DataFrame, keys: list[str], ts: str = "ts", value: str = "value", width: str = "1 hour",
                  watermark: str | None = None) -> DataFrame:
    """Smallest and largest value per key and tumbling window; works on batches and streams."""
    rows = samples.withWatermark(ts, watermark) if watermark else samples
    return rows.groupBy(*keys, F.window(ts, width).alias("w")).agg(
        F.min(value).alias("low"), F.max(value).alias("high"), F.count(F.lit(1)).alias("samples")).select(
        *keys, F.col("w.start").alias("start"), "low", "high", "samples")


def spike_sessions(spikes: DataFrame, keys: list[str], ts: str = "ts", value: str = "value", gap: str = "12 hours",
                   watermark: str | None = None) -> DataFrame:
    """Spikes closer than `gap` as one session.  A gap of exactly that length closes the session."""
    rows = spikes.withWatermark(ts, watermark) if watermark else spikes
    return rows.groupBy(*keys, F.session_window(ts, gap).alias("s")).agg(
        F.max(value).alias("peak"), F.count(F.lit(1)).alias("spikes")).select(
        *keys, F.col("s.start").alias("start"), "peak", "spikes")


def spike_session_report(spikes: DataFrame, keys: list[str], t: str = "t", value: str = "value", gap: float = 12.0,
                         max_rows: int | None = None) -> DataFrame:
    """Batch twin of `spike_sessions` over numeric times; a hot key is split and not sorted in one task."""
    runs = islands(spikes, keys, [t, value], t, gap, max_rows, "session", closed=True)
    return runs.groupBy(*keys, "session").agg(F.min(t).alias("start"), F.max(value).alias("peak"),
                                              F.count(F.lit(1)).alias("spikes")).drop("session")


def progress_eta(events: DataFrame, keys: list[str], elapsed: str, done: str, total: str) -> DataFrame:
    """Remaining time = elapsed × remaining ÷ newly done; unknown before anything new is done."""
    fresh = F.max(done) - F.min(done)
    out = events.groupBy(*keys).agg((F.max(elapsed) - F.min(elapsed)).alias("elapsed"), F.max(done).alias("done"),
                                    F.max(total).alias("total"), fresh.alias("_new"))
    eta = F.when(F.col("_new") > 0, F.floor(F.col("elapsed") * (F.col("total") - F.col("done")) / F.col("_new")))
    return out.withColumn("eta_seconds", eta).drop("_new")


# --- growing files -------------------------------------------------------------------------------
def follow_text(spark: SparkSession, path: str, suffix: str = "", part_bytes: int = PART_BYTES) -> DataFrame:
    """Lines (path, position, value) of text files that are written to the end, as they arrive; see sources.growing."""
    spark.dataSource.register(GrowingText)
    return (spark.readStream.format("growing_text").option("suffix", suffix).option("partBytes", part_bytes)
            .option("path", path).load())


def follow_states(spark: SparkSession, path: str, schema: str, suffix: str = ".jsonl") -> DataFrame:
    """Updates that are appended to files as one JSON object per line; `problem` has the line where it is none."""
    lines = follow_text(spark, path, suffix).filter("trim(value) <> ''")
    parsed = F.from_json("value", f"{schema}, problem string", {"columnNameOfCorruptRecord": "problem"})
    return lines.withColumn("_s", parsed).select("path", "position", "_s.*")


def follow_landed_text(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Text files that are complete when they land, as a stream of lines with their file."""
    return (spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
            .select(F.col("_metadata.file_path").alias("path"), "value"))


def follow_json(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def drain(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append", fmt: str = "parquet"):
    """Take everything that has landed, write it, and stop; the checkpoint makes the next run continue."""
    return (stream.writeStream.format(fmt).option("path", sink).option("checkpointLocation", checkpoint)
            .outputMode(mode).trigger(availableNow=True).start())
