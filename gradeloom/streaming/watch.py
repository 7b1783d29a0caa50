"""Watching runs as they go, by stateful processors with timers and a time to live.

The same processor serves two clocks. On the processing-time clock a service gives alerts while a run hangs. On the
event-time clock recorded lines are replayed: a line counts at its own time and timers go off as the watermark passes them,
so that a replay gives the same alerts every time and can be checked against a batch query.

Start these streams inside :func:`gradeloom.streaming.sinks.rocksdb_state`, or in a session whose state store is RocksDB.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from gradeloom.functions.rules import WARNING_EPOCH, WARNING_LOSS
from gradeloom.streaming.alerts import first_per_batch

#: What a row of a run's history says.
LAUNCH, LINE, END = "launch", "line", "end"
#: How long a warned run is remembered, and a silent one after its last line.
KEEP_HOURS = 7 * 24
#: Milliseconds by which a replay's clock is ahead: watermarks begin at 1970, and what is older would count as late.
AHEAD_MS = 2_000 * 366 * 86_400_000

# Processors go to the workers by value: these need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _WarnOnce(StatefulProcessor):
    """Gives the earliest late point of a run; a flag with a time to live keeps it from warning again."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.warned = handle.getValueState("warned", "warned boolean", self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best = min(rows, key=lambda r: r["ord"], default=None)
        if best is not None and not self.warned.exists():
            self.warned.update((True,))
            yield best

    def close(self) -> None:
        pass


def early_warnings(points: DataFrame, epoch: float = WARNING_EPOCH, loss: float = WARNING_LOSS, keep_hours: float = KEEP_HOURS) -> DataFrame:
    """The first point per run past the epoch whose loss is still too high, once per run; append mode.

    A run is remembered for ``keep_hours`` of processing time after its warning, then its state is dropped; a run that
    comes back later than that warns again. Of each Arrow batch only a run's earliest point is shuffled.
    """
    late = points.filter((F.col("epoch") > epoch) & (F.col("loss") > loss)).select("run", "ord", "epoch", "loss")
    reduced = first_per_batch(late)
    return reduced.groupBy("run").transformWithState(_WarnOnce(int(keep_hours * 3_600_000)), late.schema, "append", "ProcessingTime")


class _Watch(StatefulProcessor):
    """Silence and wall alerts of a run. State: its start, its last line, whether it was silent or over time."""

    def __init__(self, silence_ms: int, wall_ms: int, keep_ms: int, event_time: bool):
        self.silence_ms, self.wall_ms, self.keep_ms, self.event_time = silence_ms, wall_ms, keep_ms, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "start bigint, last bigint, silent boolean, over boolean")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        at = initialState["ms"] if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        self._keep(at, at, False, False)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        start, last, silent, over = self._state()
        for row in sorted(rows, key=lambda r: (r["ms"], r["event"] == END)):
            at = row["ms"] if self.event_time else timerValues.getCurrentProcessingTimeInMs()
            if start is None:
                start = last = at
            yield from self._due(key, start, last, silent, over, at)
            over = over or self._past(start, self.wall_ms, at)
            if at - last >= self.keep_ms and not self._open(silent or self._past(last, self.silence_ms, at), over):
                start, over = at, False  # forgotten meanwhile
            if row["event"] == END:
                self._forget()
                start = last = None
                silent = over = False
            else:
                last, silent = max(last, at), False
        if start is not None:
            self._keep(start, last, silent, over)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        start, last, silent, over = self._state()
        at = expiredTimerInfo.getExpiryTimeInMs()
        if start is None:
            return
        yield from self._due(key, start, last, silent, over, at)
        silent = silent or self._past(last, self.silence_ms, at)
        over = over or self._past(start, self.wall_ms, at)
        if at > last + self.keep_ms and not self._open(silent, over):
            self._forget()
        else:
            self._keep(start, last, silent, over, passed=at)

    def close(self) -> None:
        pass

    def _state(self) -> tuple:
        return self.run.get() if self.run.exists() else (None, None, False, False)

    @staticmethod
    def _past(since: int, limit_ms: int, now: int) -> bool:
        return bool(limit_ms) and now - since > limit_ms

    def _open(self, silent: bool, over: bool) -> bool:
        """Whether an alert may still come without another line."""
        return bool(self.silence_ms) and not silent or bool(self.wall_ms) and not over

    def _due(self, key, start: int, last: int, silent: bool, over: bool, now: int) -> Iterator[Row]:
        if not over and self._past(start, self.wall_ms, now):
            yield Row(run=key[0], kind="wall", at_ms=start + self.wall_ms)
        if not silent and self._past(last, self.silence_ms, now):
            yield Row(run=key[0], kind="silence", at_ms=last + self.silence_ms)

    def _forget(self) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.run.clear()

    def _keep(self, start: int, last: int, silent: bool, over: bool, passed: int | None = None) -> None:
        self.run.update((start, last, silent, over))
        # A limit is passed a moment after it, and a timer goes off at its moment.
        wanted = {last + self.keep_ms + 1}
        if self.wall_ms and not over:
            wanted.add(start + self.wall_ms + 1)
        if self.silence_ms and not silent:
            wanted.add(last + self.silence_ms + 1)
        known = set(self.handle.listTimers())
        for timer in known - wanted:
            if timer != passed:
                self.handle.deleteTimer(timer)
        for timer in wanted - known:
            if passed is None or timer > passed:
                self.handle.registerTimer(timer)


def watch_runs(
    history: DataFrame,
    silence: float = 0,
    wall: float = 0,
    launches: DataFrame | None = None,
    event_time: bool = False,
    delay: str = "0 seconds",
    keep_hours: float = KEEP_HOURS,
) -> DataFrame:
    """Alerts ``(run, kind, at_ms)`` of running jobs, in append mode: ``silence`` seconds without a line, ``wall`` since the start.

    ``history`` is a stream of ``(run, ts, event)``: a run's launch, its lines and its end. A run starts with its launch, so one
    that never writes a line is noticed, or with its first line. An end drops its state; else that goes ``keep_hours`` after
    the last line, when no alert is left to come. Wall alerts come once per run, silence alerts once per silence.
    ``launches (run, ts)``, a table, are runs launched before the stream began. A limit of zero turns an alert off.

    With ``event_time`` the stream is a replay: lines count at their ``ts``, and time passes with the watermark, ``delay``
    behind the newest line. Lines are reduced to the first and last of each slot of ``silence`` seconds before they are
    shuffled; within a slot no pause is long enough. A null ``ts`` says nothing and is left out; lines without a run are
    those of one run, as in a table grouped by it. The watermark of a replay runs ``AHEAD_MS`` ahead of its lines.
    """
    silence_ms, wall_ms, keep_ms = int(silence * 1000), int(wall * 1000), int(keep_hours * 3_600_000)
    ahead = AHEAD_MS if event_time else 0
    # Cut towards zero, as SQL divides; unix_millis differs by one before 1970.
    ms = F.expr(f"unix_micros(CAST(ts AS timestamp)) div 1000 + {ahead}").alias("ms")
    rows = _slot_ends(history.filter("ts IS NOT NULL").select("run", ms, "event"), max(silence_ms, 1) if event_time else None)
    if event_time:
        rows = rows.withColumn("at", F.timestamp_millis("ms")).withWatermark("at", delay)
    start = None
    if launches is not None:
        start = launches.filter("ts IS NOT NULL").groupBy("run").agg(F.min(ms).alias("ms")).groupBy("run")
    kind = history.schema["run"].dataType
    schema = StructType([StructField("run", kind)]).add("kind", "string").add("at_ms", LongType())
    processor = _Watch(silence_ms, wall_ms, keep_ms, event_time)
    alerts = rows.groupBy("run").transformWithState(processor, schema, "append", "EventTime" if event_time else "ProcessingTime", start)
    return alerts.withColumn("at_ms", F.col("at_ms") - ahead) if ahead else alerts


def _slot_ends(rows: DataFrame, slot_ms: int | None) -> DataFrame:
    """Per Arrow batch, run, event and slot of time the first and last row; without slots, of the batch."""
    slot = F.floor(F.col("ms") / slot_ms) if slot_ms else F.lit(0).cast("bigint")

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = pa.Table.from_batches([batch]).group_by(["run", "event", "slot"]).aggregate([("ms", "min"), ("ms", "max")])
            longer = ends.filter(pc.greater(ends["ms_max"], ends["ms_min"]))
            for table, at in ((ends, "ms_min"), (longer, "ms_max")):
                yield from pa.table([table["run"], table[at], table["event"]], ["run", "ms", "event"]).to_batches()

    return rows.withColumn("slot", slot).mapInArrow(reduce, rows.schema)
