"""What to generate next: boosts, skips, gaps, format health and seed examples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.names import file_stem
from gradeloom.functions.rules import boost_priority, next_action, priority_rank, skip_reason
from gradeloom.functions.text import WEAK_SCORE, exact_round, strip_fences
from gradeloom.operators.aggregate import boilerplate_cases, format_health, run_summary, scored_only, tag_breakdown
from gradeloom.plans.skew import lookup_join, join_measured, materialize, materialize_measured, salted_join, top_k

SEEDS = 3
URGENT = ("critical", "high")


def manifest_tags(manifest: DataFrame) -> DataFrame:
    """Distinct ``(manifest, tag)`` over the three pattern lists of each manifest."""
    lists = ("patterns", "training.contrast_patterns", "training.patterns")
    tags = [
        manifest.select("manifest", F.explode(path).alias("p")).select("manifest", F.explode("p.tags").alias("tag"))
        for path in lists
    ]
    return tags[0].unionByName(tags[1]).unionByName(tags[2]).distinct()


def boost_tags(breakdown: DataFrame) -> DataFrame:
    """Weak tags with their priority."""
    return breakdown.filter(F.col("avg") < WEAK_SCORE).select(
        "run_id",
        F.col("convention").alias("name"),
        F.col("avg").alias("avg_score"),
        F.col("n").alias("n_holdout_examples"),
        boost_priority(F.col("avg"), F.col("n")).alias("priority"),
    )


def order_boost(boost: DataFrame) -> DataFrame:
    return boost.orderBy("run_id", priority_rank(F.col("priority")), "avg_score", "name")


def skip_tags(breakdown: DataFrame) -> DataFrame:
    """Tags that need no more data."""
    return breakdown.filter(F.col("avg") >= WEAK_SCORE).select(
        "run_id", F.col("convention").alias("name"), F.col("avg").alias("avg_score"), skip_reason(F.col("avg")).alias("reason")
    )


def examples_for_tags(results: DataFrame, targets: DataFrame) -> DataFrame:
    """Non-failed examples of each target ``(run_id, name)``; a target without any keeps one null row."""
    hits = scored_only(results).select("run_id", F.explode("conventions_tested").alias("name"), "rec_id", "ord", "score")
    found = salted_join(hits, targets.select("run_id", "name").distinct(), ["run_id", "name"], ["rec_id"])
    empty = targets.select("run_id", "name").distinct().join(found.select("run_id", "name").distinct(), ["run_id", "name"], "left_anti")
    return found.unionByName(empty, allowMissingColumns=True)


def seed_candidates(results: DataFrame, boost: DataFrame, k: int = SEEDS) -> DataFrame:
    """The ``k`` lowest-scoring examples per critical or high tag, fences removed.

    Ranks run over narrow rows of all tags and are limited before the shuffle; the few
    survivors then meet the targets and fetch their texts. A target without examples keeps
    one row of nulls.
    """
    targets = boost.filter(F.col("priority").isin(*URGENT)).select("run_id", "name")
    narrow = scored_only(results).select("run_id", F.explode("conventions_tested").alias("name"), "rec_id", "ord", "score")
    lowest = top_k(narrow, ["run_id", "name"], [F.col("score"), F.col("ord")], k).drop("ord", "score")
    chosen, fits = materialize_measured(targets.join(lowest, ["run_id", "name"]), "seeds")
    texts = results.select("run_id", "rec_id", "id", "label", "score", "conventions_tested", "prompt", "expected", "generated")
    seeds = join_measured(texts, chosen, fits, ["run_id", "rec_id"], ["id"]).select(
        "run_id",
        "name",
        F.col("rank").cast("bigint").alias("rank"),
        "id",
        "label",
        exact_round(F.col("score"), 3).alias("score"),
        "conventions_tested",
        "prompt",
        strip_fences(F.col("expected")).alias("expected"),
        strip_fences(F.col("generated")).alias("generated"),
    )
    empty = targets.join(chosen.select("run_id", "name").distinct(), ["run_id", "name"], "left_anti")
    return seeds.unionByName(empty, allowMissingColumns=True)


def status_summary(
    results: DataFrame,
    runs: DataFrame,
    manifest_meta: DataFrame | None = None,
    averages: DataFrame | None = None,
    breakdown: DataFrame | None = None,
) -> DataFrame:
    """One row per run: action, averages (three digits), band counts, format health.

    ``runs`` carries ``run_id, holdout_file, manifest`` and the looked-up ``previous_run`` and
    ``base_run``, which may be null.
    Their averages come from ``averages`` (``run_id, avg_score``), by default those of ``results``.
    """
    summary = run_summary(results)
    averages = summary if averages is None else averages
    breakdown = tag_breakdown(results) if breakdown is None else breakdown
    boosts = boost_tags(breakdown).groupBy("run_id").agg(F.count(F.lit(1)).alias("n_boost"))

    def with_average(df: DataFrame, column: str, out: str) -> DataFrame:
        known = averages.select(F.col("run_id").alias(column), exact_round(F.col("avg_score"), 3).alias(out))
        return salted_join(df, known, [column], ["run_id"], "left")

    joined = (
        runs.join(summary, "run_id").join(boosts, "run_id", "left").join(format_health(results), "run_id", "left")
    )
    joined = with_average(with_average(joined, "previous_run", "previous_avg"), "base_run", "base_model_avg")
    if manifest_meta is None:
        joined = joined.withColumn("cycle", F.lit(None).cast("int"))
    else:
        joined = salted_join(joined, manifest_meta.select("manifest", "cycle"), ["manifest"], ["run_id"], "left")
    return joined.select(
        "run_id",
        "cycle",
        file_stem(F.col("holdout_file")).alias("eval_set"),
        next_action(F.coalesce(F.col("n_boost"), F.lit(0)), F.col("avg_score")).alias("action"),
        exact_round(F.col("avg_score"), 3).alias("avg_similarity"),
        "previous_avg",
        "base_model_avg",
        "excellent",
        "good",
        "partial",
        "poor",
        "total",
        F.coalesce(F.col("func_start_pct"), F.lit(0.0)).alias("func_start_pct"),
        F.coalesce(F.col("boilerplate_detected"), F.lit(0)).alias("boilerplate_detected"),
    )


def uncovered_by_run(breakdown: DataFrame, runs: DataFrame, tags: DataFrame) -> DataFrame:
    """Tags of each run's manifest that the run does not test, each once.

    A manifest's tags are one sorted list, given to its runs by a lookup, and a run's tested tags another; what is missing is
    their difference. So rows are not multiplied by tags before they meet, and a manifest that all runs name is no hot key.
    """
    wanted = tags.groupBy("manifest").agg(F.array_sort(F.collect_set("tag")).alias("_wanted"))
    tested = breakdown.groupBy("run_id").agg(F.collect_set("convention").alias("_tested"))
    asked = lookup_join(runs.select("run_id", "manifest"), wanted, ["manifest"], ["run_id"], label="manifest-tags")
    missing = F.array_except("_wanted", F.coalesce("_tested", F.array().cast("array<string>")))
    return asked.join(tested, "run_id", "left").select("run_id", F.explode(missing).alias("name"))


def status_parts(
    results: DataFrame,
    runs: DataFrame,
    tags: DataFrame | None = None,
    manifest_meta: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The parts of a status as tables: summary, boost, skip, uncovered, boilerplate and seed.

    Several parts read the tag breakdown (one row per run and tag), so it is stored once;
    pass stored results as well.
    """
    breakdown = materialize(tag_breakdown(results), "breakdown")
    boost = boost_tags(breakdown)
    parts = {
        "summary": status_summary(results, runs, manifest_meta, breakdown=breakdown),
        "boost": boost,
        "skip": skip_tags(breakdown),
        "boilerplate": boilerplate_cases(results),
        "seed": seed_candidates(results, boost),
    }
    if tags is not None:
        parts["uncovered"] = uncovered_by_run(breakdown, runs, tags)
    return parts


SEED_FIELDS = ("id", "label", "score", "conventions_tested", "prompt", "expected", "generated")


def build_status(parts: dict[str, DataFrame]) -> DataFrame:
    """The whole status as rows ``(run_id, section, rank, name, item)``; ``item`` is JSON.

    Lists stay rows because some have no bound (every boilerplate case is one item);
    ``rank`` and ``name`` order a section. For nested documents of named
    runs see :func:`gradeloom.sources.sinks.status_documents`.
    """
    zero = F.lit(0.0)
    rank = {
        "summary": zero,
        "boost": priority_rank(F.col("priority")) + F.col("avg_score"),
        "skip": F.col("avg_score"),
        "boilerplate": F.col("ord"),
        "seed": F.coalesce(F.col("rank"), F.lit(0)),
        "uncovered": zero,
    }
    name = {"summary": "action", "boilerplate": "func"}
    hidden = ("run_id", "ord", "rank")

    def rows(section: str, df: DataFrame) -> DataFrame:
        fields = SEED_FIELDS if section == "seed" else [c for c in df.columns if c not in hidden]
        return df.select(
            "run_id",
            F.lit(section).alias("section"),
            rank[section].cast("double").alias("rank"),
            F.col(name.get(section, "name")).alias("name"),
            F.to_json(F.struct(*fields)).alias("item"),
        )

    return reduce(DataFrame.unionByName, [rows(section, df) for section, df in parts.items()])
