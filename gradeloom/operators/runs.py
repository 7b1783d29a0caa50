"""Run lookups and checkpoint selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.names import parse_checkpoint
from gradeloom.plans.skew import top_k

EVAL_KIND = "eval"


def nth_latest_run(runs: DataFrame, n: int = 1, kind: str | None = EVAL_KIND) -> DataFrame:
    """The n-th newest run of each model; runs of other kinds are left out by default."""
    if kind is not None and "run_kind" in runs.columns:
        runs = runs.filter(F.col("run_kind") == kind)
    newest = [F.col("mtime").desc(), F.col("run_id").desc()]
    return top_k(runs, ["model"], newest, n, "_rank").filter(F.col("_rank") == n).drop("_rank")


def checkpoint_rows(names: DataFrame, name: str = "name", adapter: str = "adapter") -> DataFrame:
    """Checkpoint folders with a positive step, in no order: for further operators."""
    parsed = names.withColumn("_p", parse_checkpoint(F.col(name), F.col(adapter)))
    return parsed.select(*names.columns, "_p.*").filter(F.col("step").isNotNull())


def checkpoint_candidates(names: DataFrame, name: str = "name", adapter: str = "adapter") -> DataFrame:
    """Checkpoint folders with a positive step, in step order."""
    return checkpoint_rows(names, name, adapter).orderBy("step")


def candidates(final: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """The final adapter and its checkpoints, in the order ties are settled: final, then by step."""
    return (
        final.withColumn("is_final", F.lit(True))
        .unionByName(checkpoints.withColumn("is_final", F.lit(False)), allowMissingColumns=True)
        .withColumn("ord", F.when(F.col("is_final"), F.lit(0)).otherwise(F.col("step")))
    )


def best_checkpoint(scored: DataFrame, by: str = "adapter") -> DataFrame:
    """The best-scoring candidate, the earliest on a tie, and its lead over the final adapter.

    Candidates without a score (their evaluation failed) are skipped.
    """
    usable = scored.filter(F.col("avg_score").isNotNull())
    rank = F.struct(F.col("avg_score"), (-F.col("ord")).alias("o"))
    best = F.max_by(F.struct("candidate", "step", "avg_score"), rank)
    final = F.max(F.when(F.col("is_final"), F.col("avg_score")))
    return (
        usable.groupBy(by)
        .agg(best.alias("_best"), final.alias("final_score"), F.count(F.lit(1)).alias("n_scored"))
        .select(by, "_best.*", "final_score", "n_scored")
        .withColumn("lead", F.col("avg_score") - F.col("final_score"))
    )
