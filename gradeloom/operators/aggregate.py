"""Run averages, band counts, tag breakdowns and their orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.text import ALL_BANDS, ERROR_BAND, WEAK_SCORE, band, basis_points, exact_round, flags_of, mean_of_points, strip_fences
from gradeloom.plans.once import compute_once
from gradeloom.plans.skew import top_k

WORST_TAGS = 5
FAILING_BANDS = ("POOR", "PARTIAL", ERROR_BAND)
RUN = ("run_id",)


def scored_only(results: DataFrame) -> DataFrame:
    return results.filter(F.col("band") != ERROR_BAND)


def failing_examples(results: DataFrame) -> DataFrame:
    """Rows worth a look, in original order."""
    return results.filter(F.col("band").isin(*FAILING_BANDS)).orderBy("run_id", "ord")


def _average(points: str, counted: Column) -> tuple[Column, Column]:
    return F.coalesce(F.sum(F.when(counted, F.col(points))), F.lit(0)), F.count_if(counted)


def run_average(results: DataFrame, by: Sequence[str] = RUN) -> DataFrame:
    """Average over rows that did not fail; 0.0 when all did."""
    total, n = _average("score_bp", F.col("band") != ERROR_BAND)
    return (
        results.groupBy(*by)
        .agg(total.alias("_bp"), n.alias("n_scored"))
        .select(*by, "n_scored", mean_of_points(F.col("_bp"), F.col("n_scored"), 4).alias("avg_score"))
    )


def band_columns(band_col: str = "band") -> list[Column]:
    return [F.count_if(F.col(band_col) == b).alias(b.lower()) for b in ALL_BANDS]


def band_counts(results: DataFrame, band_col: str = "band", by: Sequence[str] = RUN) -> DataFrame:
    """Rows per band, failed ones included; absent bands are 0."""
    return results.groupBy(*by).agg(*band_columns(band_col))


def run_summary(results: DataFrame, by: Sequence[str] = RUN) -> DataFrame:
    """Average, band counts and row count of a run in one pass."""
    total, n = _average("score_bp", F.col("band") != ERROR_BAND)
    return (
        results.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("total"), total.alias("_bp"), n.alias("n_scored"), *band_columns())
        .withColumn("avg_score", mean_of_points(F.col("_bp"), F.col("n_scored"), 4))
        .drop("_bp")
    )


def tag_scores(results: DataFrame, score_col: str = "score", by: Sequence[str] = RUN) -> DataFrame:
    """One row per tag and example. Score lists stay rows: a hot tag's list has no bound."""
    return results.select(*by, F.explode("conventions_tested").alias("convention"), "ord", F.col(score_col).alias("score"))


def tag_breakdown(results: DataFrame, score_col: str = "score", by: Sequence[str] = RUN) -> DataFrame:
    """Average (three digits) and count per tag; failed rows count as 0.

    Texts are dropped before tags are exploded, and averages are combined map-side.
    """
    return (
        results.select(*by, "conventions_tested", basis_points(F.col(score_col)).alias("_p"))
        .select(*by, F.explode("conventions_tested").alias("convention"), "_p")
        .groupBy(*by, "convention")
        .agg(F.sum("_p").alias("_bp"), F.count(F.lit(1)).alias("n"))
        .select(*by, "convention", mean_of_points(F.col("_bp"), F.col("n"), 3).alias("avg"), "n")
    )


def tested_tags(breakdown: DataFrame) -> DataFrame:
    return breakdown.select("run_id", "convention").distinct()


def weak_tags(breakdown: DataFrame, below: float = WEAK_SCORE) -> DataFrame:
    """Tags whose rounded average is too low."""
    return breakdown.filter(F.col("avg") < below)


def worst_tags(breakdown: DataFrame) -> DataFrame:
    return breakdown.withColumn("band", band(F.col("avg"))).orderBy("run_id", "avg", "convention")


def worst_examples(results: DataFrame) -> DataFrame:
    return results.orderBy("run_id", "score", "ord")


def top_weak_tags(breakdown: DataFrame, k: int = WORST_TAGS) -> DataFrame:
    """The weakest tags of each run, at most ``k``."""
    return top_k(weak_tags(breakdown), ["run_id"], [F.col("avg"), F.col("convention")], k)


def with_format_flags(results: DataFrame) -> DataFrame:
    """Add ``func_start`` and ``boilerplate``."""
    bare = results.withColumn("_text", strip_fences(F.col("generated")))
    return compute_once(bare, {"_flags": flags_of(F.col("_text"))}).select(*results.columns, "_flags.*")


def format_health(results: DataFrame) -> DataFrame:
    """Share of answers that open with a function, and how many carry boilerplate."""
    return (
        with_format_flags(scored_only(results).select("run_id", "generated"))
        .groupBy("run_id")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.count_if("func_start").alias("_starts"),
            F.count_if("boilerplate").alias("boilerplate_detected"),
        )
        .select(
            "run_id",
            exact_round(F.lit(100.0) * F.col("_starts") / F.greatest(F.col("_n"), F.lit(1)), 1).alias("func_start_pct"),
            "boilerplate_detected",
        )
    )


def boilerplate_cases(results: DataFrame) -> DataFrame:
    """The answers behind :func:`format_health`'s boilerplate count."""
    return (
        with_format_flags(scored_only(results))
        .filter("boilerplate")
        .select("run_id", "ord", F.col("label").alias("func"), exact_round(F.col("score"), 3).alias("score"), "length_ratio")
    )
