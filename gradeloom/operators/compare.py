"""Run-over-run, tag and base-model comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.functions.rules import MEANINGFUL_DELTA, delta_verdict, diagnosis, is_strong
from gradeloom.functions.text import trend
from gradeloom.plans.skew import hot_key_join, lookup_join, salted_join, top_k
from gradeloom.plans.suffix import suffix_minimum

TAG_DEAD_ZONE = 0.005


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row per key in original order."""
    return top_k(df, [key], [F.col(order).desc()], 1, "_rank").drop("_rank")


def compare_runs(
    curr: DataFrame, prev: DataFrame, min_delta: float = MEANINGFUL_DELTA, keep: Sequence[str] = ()
) -> DataFrame:
    """Examples present in both runs whose score moved by at least ``min_delta``.

    Of several previous rows with one id the last counts; all current rows stay. Failed rows
    take part with score 0. Deltas are differences of stored four-digit scores as doubles.
    Pass stored results: ids of the current run are counted before the join. ``keep`` names further columns of the
    current run.
    """
    before = prev.groupBy("id").agg(F.max_by("score", "ord").alias("prev_score"))
    now = curr.select(*keep, "id", "label", "ord", F.col("score").alias("curr_score"))
    delta = F.col("curr_score") - F.col("prev_score")
    return (
        hot_key_join(now, before, "id", ["ord"])
        .withColumn("delta", delta)
        .withColumn("change", F.when(delta <= -min_delta, "regression").when(delta >= min_delta, "improvement"))
        .filter(F.col("change").isNotNull())
    )


def order_changes(changes: DataFrame) -> DataFrame:
    """Improvements first, largest first; then regressions, worst first."""
    return changes.orderBy(
        F.when(F.col("change") == "improvement", 0).otherwise(1), F.abs("delta").desc(), "ord"
    )


def compare_tags(curr: DataFrame, prev: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Change per tag tested in both runs; ``keep`` names further columns of the current one."""
    joined = curr.select(*keep, "convention", F.col("avg").alias("curr_avg")).join(
        prev.select("convention", F.col("avg").alias("prev_avg")), "convention"
    )
    delta = F.col("curr_avg") - F.col("prev_avg")
    return joined.withColumn("delta", delta).withColumn("arrow", trend(F.col("delta"), TAG_DEAD_ZONE))


def order_tag_deltas(deltas: DataFrame) -> DataFrame:
    return deltas.orderBy(F.abs("delta").desc(), "convention")


def compare_to_base(tuned: DataFrame, base: DataFrame, on: str = "base_model") -> DataFrame:
    """Averages of tuned runs beside their base model's, with verdict and diagnosis.

    A tuned run without a base run keeps null base columns and is judged on its own.
    """
    joined = salted_join(tuned, base.select(on, F.col("avg_score").alias("base_avg")), [on], ["run_id"], "left")
    ft, ref = F.col("avg_score"), F.col("base_avg")
    return joined.withColumns(
        {
            "delta": ft - ref,
            "verdict": delta_verdict(ft, ref),
            "diagnosis": diagnosis(ft, ref),
            "strong": is_strong(ft),
        }
    )


def uncovered_tags(manifest_tags: DataFrame, tested: DataFrame) -> DataFrame:
    """Manifest tags no example tests, by name."""
    return tag_difference(manifest_tags.select("tag"), tested.select(F.col("convention").alias("tag"))).orderBy("tag")


def tag_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.distinct().join(b.distinct(), a.columns, "left_anti")


def shared_tags(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def base_run_asof(runs: DataFrame, base_runs: DataFrame) -> DataFrame:
    """For each run the first base run (by ``mtime``) at or after it, else the latest one.

    Both sides need ``base_model, run_id, ts, mtime``. Runs of one model and time have the same answer, so both sides are
    first reduced to one row per model and time; a suffix minimum over these replaces the inequality join. It is taken in
    nodes of bounded size, so neither a model nor an hour with very many runs meets in one task. A run without a model, or
    whose model has no base run, keeps a null; one without a time takes the latest.
    """
    pick = F.struct("mtime", F.col("run_id").alias("base_run"))
    key = ["base_model", "ts"]
    times = base_runs.groupBy(*key).agg(F.min(pick).alias("_least"), F.max(pick).alias("_most"))
    asked = runs.select(*key).distinct().withColumn("_least", F.lit(None).cast(times.schema["_least"].dataType))
    both = times.select(*key, "_least").unionByName(asked).filter("ts IS NOT NULL AND base_model IS NOT NULL")
    places = both.groupBy(*key).agg(F.min("_least").alias("_least")).withColumn("_at", F.unix_micros(F.col("ts").cast("timestamp")))
    found = suffix_minimum(places, "base_model", "_at", F.col("_least"), "_match").select(*key, F.col("_match.base_run").alias("_match"))
    latest = times.groupBy("base_model").agg(F.max("_most").alias("_latest")).select("base_model", F.col("_latest.base_run").alias("_latest"))
    rows = lookup_join(runs.select("base_model", "run_id", "ts"), found, key, ["run_id"], "left", "asof")
    rows = lookup_join(rows, latest, ["base_model"], ["run_id"], "left", "latest-base")
    return rows.select(
        "base_model", "run_id", "ts", F.coalesce("_match", "_latest").alias("base_run"), F.col("_match").isNotNull().alias("at_or_after")
    )


def previous_run(runs: DataFrame, policy: str = "latest_other") -> DataFrame:
    """The run to compare with, per run (``latest_other``) or per model (``second_latest``).

    ``latest_other`` is the newest run of the same model other than the run itself, even a
    newer one; ``second_latest`` is the second newest of the model, whoever asks.
    """
    newest = top_k(runs.select("model", "run_id", "mtime"), ["model"], _newest_first(), 2)
    if policy == "second_latest":
        return newest.filter("rank = 2").select("model", F.col("run_id").alias("previous_run"))
    top = newest.groupBy("model").agg(
        F.max(F.when(F.col("rank") == 1, F.col("run_id"))).alias("_first"),
        F.max(F.when(F.col("rank") == 2, F.col("run_id"))).alias("_second"),
    )
    other = F.when(F.col("run_id") == F.col("_first"), F.col("_second")).otherwise(F.col("_first"))
    return salted_join(runs.select("model", "run_id"), top, ["model"], ["run_id"], "left").select(
        "model", "run_id", other.alias("previous_run")
    )


def _newest_first() -> list[Column]:
    return [F.col("mtime").desc(), F.col("run_id").desc()]
