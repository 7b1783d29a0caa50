"""Alerts as rows from a stream of trainer lines."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from gradeloom.functions.rules import WARNING_EPOCH, WARNING_LOSS

ALERT_FIELDS = "kind string, seconds double"


def line_processor(
    lines: DataFrame,
    process: Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]],
    output: StructType | str,
    state: str,
    timeout: str = GroupStateTimeout.NoTimeout,
    by: str = "run",
) -> DataFrame:
    """Run a callback with state over the lines of each run, in append mode."""
    return lines.groupBy(by).applyInPandasWithState(process, output, state, "append", timeout)


def first_per_batch(rows: DataFrame, by: str = "run", order: str = "ord") -> DataFrame:
    """At most one row (the earliest) per run and Arrow batch, before any shuffle.

    Keeps a chatty run from sending all its lines to the one task that holds its state.
    Arrow, not pandas: beside a null a whole number would become a float and lose digits.
    """

    def reduce(batches):
        for batch in batches:
            lines = pa.Table.from_batches([batch]).sort_by(order)
            lines = lines.append_column("_at", pa.array(range(len(lines)), pa.int64()))
            first = lines.group_by(by).aggregate([("_at", "min")])["_at_min"]
            yield from lines.drop_columns("_at").take(first).to_batches()

    return rows.mapInArrow(reduce, rows.schema)


def early_warning_stream(points: DataFrame, epoch: float = WARNING_EPOCH, loss: float = WARNING_LOSS) -> DataFrame:
    """The first point per run past the epoch whose loss is still too high, once per run."""
    late = points.filter((F.col("epoch") > epoch) & (F.col("loss") > loss)).select("run", "ord", "epoch", "loss")

    def warn(key, batches, state):
        if state.exists:
            return
        best = None
        for pdf in batches:
            row = pdf.loc[[pdf["ord"].idxmin()]]
            if best is None or row["ord"].iloc[0] < best["ord"].iloc[0]:
                best = row
        if best is not None:
            state.update((True,))
            yield best[["run", "ord", "epoch", "loss"]]

    return line_processor(first_per_batch(late), warn, late.schema, "warned boolean")


def timer_alerts(lines: DataFrame, silence: float = 0, wall: float = 0) -> DataFrame:
    """Processing-time alerts per run: ``silence`` seconds without a line, ``wall`` seconds since the first.

    A zero turns an alert off. A wall alert is given once; a silence alert once per silence.
    """
    silence_ms, wall_ms = int(silence * 1000), int(wall * 1000)

    def watch(key, batches, state):
        now = state.getCurrentProcessingTimeMs()
        start, last, silent, over = state.get if state.exists else (now, now, False, False)
        out = []
        if not state.hasTimedOut:
            for _ in batches:
                pass
            last, silent = now, False
        if wall_ms and not over and now - start > wall_ms:
            over = True
            out.append((key[0], "wall", (now - start) / 1000.0))
        if silence_ms and not silent and now - last > silence_ms:
            silent = True
            out.append((key[0], "silence", (now - last) / 1000.0))
        state.update((start, last, silent, over))
        due = []
        if wall_ms and not over:
            due.append(start + wall_ms)
        if silence_ms and not silent:
            due.append(last + silence_ms)
        if due:
            state.setTimeoutDuration(max(1, min(due) - now + 1))
        if out:
            yield pd.DataFrame(out, columns=["run", "kind", "seconds"])

    seen = first_per_batch(lines.select("run", "ord"))
    return line_processor(
        seen, watch, f"run {seen.schema['run'].dataType.simpleString()}, {ALERT_FIELDS}", "start bigint, last bigint, silent boolean, over boolean",
        GroupStateTimeout.ProcessingTimeTimeout,
    )


def silence_alerts(lines: DataFrame, seconds: float) -> DataFrame:
    """Runs without a line for longer than ``seconds`` of processing time."""
    return timer_alerts(lines, silence=seconds)


def wall_alerts(lines: DataFrame, seconds: float) -> DataFrame:
    """Runs going on for longer than ``seconds`` of processing time."""
    return timer_alerts(lines, wall=seconds)


def silence_sessions(log: DataFrame, seconds: int, delay: str = "0 seconds", run: str = "run", ts: str = "ts") -> DataFrame:
    """Event-time twin of the silence alert: stretches of lines without a longer pause.

    A stretch is given once the watermark passes its end, that is, when the run has been
    silent for longer than ``seconds``. Works in batch as well. Lines later than ``delay``
    are dropped by the watermark.

    Sessions gather all rows of a run in one task, so lines are first reduced to the first
    and last of each slot of ``seconds``, within which no pause can end a session.
    """
    width = seconds * 1_000_000
    kind = dict(log.dtypes)[ts]
    lines = log.select(run, F.unix_micros(F.col(ts).cast("timestamp")).alias("us")).filter("us IS NOT NULL")
    ends = (_slot_ends_stream if log.isStreaming else _slot_ends)(lines, run, width)
    # A pause of exactly the limit is no alert, hence the extra microsecond.
    gap = f"{seconds} seconds 1 microsecond"
    return (
        ends.select(run, F.timestamp_micros("us").alias("at"), "n")
        .withWatermark("at", delay)
        .groupBy(run, F.session_window("at", gap).alias("_s"))
        .agg(
            F.min("at").cast(kind).alias("first_ts"), F.max("at").cast(kind).alias("last_ts"), F.sum("n").alias("n_lines")
        )
        .drop("_s")
    )


def _slot_ends(lines: DataFrame, run: str, width: int) -> DataFrame:
    """First line of each slot with the slot's line count, and its last line with count 0."""
    slots = lines.groupBy(run, F.floor(F.col("us") / width).alias("_slot")).agg(
        F.min("us").alias("_lo"), F.max("us").alias("_hi"), F.count(F.lit(1)).alias("_n")
    )
    zero = F.lit(0).cast("bigint")
    pair = F.array(F.struct(F.col("_lo").alias("us"), F.col("_n").alias("n")), F.struct(F.col("_hi").alias("us"), zero.alias("n")))
    return slots.select(run, F.inline(pair))


def _slot_ends_stream(lines: DataFrame, run: str, width: int) -> DataFrame:
    """:func:`_slot_ends` per Arrow batch, before the shuffle; batches merge in the session."""

    def reduce(batches):
        for pdf in batches:
            slots = pdf.groupby([run, pdf["us"] // width], sort=False)["us"].agg(["min", "max", "count"])
            runs = slots.index.get_level_values(0)
            first = pd.DataFrame({run: runs, "us": slots["min"].to_numpy(), "n": slots["count"].to_numpy()})
            last = pd.DataFrame({run: runs, "us": slots["max"].to_numpy(), "n": 0})
            yield pd.concat([first, last], ignore_index=True)

    return lines.mapInPandas(reduce, StructType([*lines.schema.fields, StructField("n", LongType())]))


def wall_overrun_runs(log: DataFrame, seconds: int, run: str = "run", ts: str = "ts") -> DataFrame:
    """Event-time twin of the wall alert: runs whose lines span more than ``seconds``; update mode."""
    us = F.unix_micros(F.max(ts).cast("timestamp")) - F.unix_micros(F.min(ts).cast("timestamp"))
    return (
        log.groupBy(run)
        .agg(F.min(ts).alias("start_ts"), F.max(ts).alias("last_ts"), (us / 1_000_000.0).alias("elapsed_seconds"))
        .filter(F.col("elapsed_seconds") > seconds)
    )
