"""Losses from a stream of trainer lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.rules import loss_health
from gradeloom.operators.trainlog import loss_points, loss_summary_columns


def loss_stream(lines: DataFrame) -> DataFrame:
    """Loss points of arriving lines ``(run, ord, line)``; append mode."""
    return loss_points(lines)


def loss_summary_stream(points: DataFrame) -> DataFrame:
    """Running loss summary per run; update mode. Points are combined before they are shuffled."""
    return points.groupBy("run").agg(*loss_summary_columns()).withColumn("health", loss_health(F.col("final_loss")))
