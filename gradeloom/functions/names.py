"""Run, checkpoint and dataset names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_model(model: Column) -> Column:
    """Model name usable in a file name."""
    return F.replace(model, F.lit("/"), F.lit("_"))


def file_stem(path: Column) -> Column:
    """File name without folders and without its last suffix."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def parse_run_name(name: Column) -> Column:
    """``<date>_<time>_<model>`` into timestamp and model."""
    parts = F.split(name, "_")
    return F.struct(
        F.array_join(F.slice(parts, 1, 2), "_").alias("timestamp"),
        F.array_join(F.slice(parts, F.lit(3), F.greatest(F.size(parts), F.lit(0))), "_").alias("model"),
    )


def run_time(timestamp: Column) -> Column:
    """Minute-resolution run timestamp as a timestamp value."""
    return F.try_to_timestamp(timestamp, F.lit("yyyy-MM-dd_HHmm"))


def checkpoint_step(name: Column) -> Column:
    """Step number of ``checkpoint-<step>``; null unless it is a positive integer."""
    step = F.get(F.split(name, "-"), F.lit(1)).try_cast("int")
    return F.when(F.startswith(name, F.lit("checkpoint-")) & (step > 0), step)


def parse_checkpoint(name: Column, adapter: Column) -> Column:
    """Step and candidate model name of a checkpoint folder."""
    step = checkpoint_step(name)
    return F.struct(
        step.alias("step"),
        F.when(step.isNotNull(), F.concat(adapter, F.lit("-ckpt"), F.get(F.split(name, "-"), F.lit(1)))).alias("candidate"),
    )


def run_meta(model: Column, adapter: Column, holdout_path: Column, adapter_path: Column) -> Column:
    """Evaluation-set name, and the adapter path when the adapter itself was evaluated."""
    return F.struct(
        file_stem(holdout_path).alias("eval_set"),
        F.when(model == adapter, adapter_path).alias("lora_path"),
    )
