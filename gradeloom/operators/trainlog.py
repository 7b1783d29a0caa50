"""Training-log analytics in batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.functions.logs import LOSS_KEY, parse_loss
from gradeloom.functions.rules import WARNING_EPOCH, WARNING_LOSS, loss_health, step_estimate
from gradeloom.plans.once import compute_once
from gradeloom.plans.skew import lookup_join


def loss_points(lines: DataFrame, line: str = "line", by: Sequence[str] = ("run", "ord")) -> DataFrame:
    """``(run, ord, epoch, loss)`` of the lines that carry a loss.

    Other lines are dropped on a plain substring first; the pattern runs once per line left.
    """
    likely = lines.filter(F.contains(F.col(line), F.lit(LOSS_KEY)))
    parsed = compute_once(likely.select(*by, line), {"p": parse_loss(F.col(line))})
    return parsed.filter(F.col("p").isNotNull()).select(*by, "p.*")


def loss_summary_columns() -> list[Column]:
    """First and last loss, last epoch and point count in arrival order."""
    return [
        F.min_by("loss", "ord").alias("first_loss"),
        F.max_by("loss", "ord").alias("final_loss"),
        F.max_by("epoch", "ord").alias("final_epoch"),
        F.count(F.lit(1)).alias("n_points"),
    ]


def loss_summary(points: DataFrame, *others: Column) -> DataFrame:
    """The summary per run, with ``others``, aggregates of the same pass."""
    return points.groupBy("run").agg(*loss_summary_columns(), *others).withColumn("health", loss_health(F.col("final_loss")))


def with_step_estimate(summary: DataFrame, steps: str = "steps") -> DataFrame:
    """Add the step estimate of each run; ``steps`` is null where none was resolved."""
    est = step_estimate(F.col("first_loss"), F.col("final_loss"), F.col("n_points"), F.col(steps))
    return summary.withColumn("e", est).select("*", "e.*").drop("e")


def early_warning(points: DataFrame, epoch: float = WARNING_EPOCH, loss: float = WARNING_LOSS) -> DataFrame:
    """The first point per run past the epoch whose loss is still too high."""
    late = points.filter((F.col("epoch") > epoch) & (F.col("loss") > loss))
    return late.groupBy("run").agg(
        F.min("ord").alias("ord"), F.min_by("epoch", "ord").alias("epoch"), F.min_by("loss", "ord").alias("loss")
    )


def silence_gaps(log: DataFrame, seconds: int, run: str = "run", ts: str = "ts") -> DataFrame:
    """Pauses longer than ``seconds`` between consecutive lines of a run.

    Lines fall into time slots of that width, and within a slot no pause can exceed it. So
    first and last time per slot are enough: a hash aggregate combines them map-side, and
    only the slot table, not the lines, is ordered per run.
    """
    width = seconds * 1_000_000
    kind = dict(log.dtypes)[ts]
    order = Window.partitionBy(run).orderBy("_slot")
    slots = (
        log.select(run, F.unix_micros(F.col(ts).cast("timestamp")).alias("_us"))
        .groupBy(run, F.floor(F.col("_us") / width).alias("_slot"))
        .agg(F.min("_us").alias("_head"), F.max("_us").alias("_tail"))
    )
    gaps = slots.withColumn("_prev", F.lag("_tail").over(order)).filter(F.col("_head") - F.col("_prev") > width)
    return gaps.select(
        run,
        F.timestamp_micros("_head").cast(kind).alias(ts),
        F.timestamp_micros("_prev").cast(kind).alias("prev_ts"),
        ((F.col("_head") - F.col("_prev")) / 1_000_000.0).alias("gap_seconds"),
    )


def wall_overruns(log: DataFrame, seconds: int, run: str = "run", ts: str = "ts", tie: str = "ord") -> DataFrame:
    """Lines later than ``seconds`` after the first line of their run."""
    starts = log.groupBy(run).agg(F.min(ts).alias("start_ts"))
    elapsed = (
        F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("start_ts").cast("timestamp"))
    ) / 1_000_000.0
    return (
        lookup_join(log.select(run, tie, ts), starts, [run], [tie], label="run-starts")
        .withColumn("elapsed_seconds", elapsed)
        .filter(F.col("elapsed_seconds") > seconds)
    )
