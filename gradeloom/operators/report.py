"""Reports as long tables ``(section, rank, key, value)``.

``rank`` is the sort value inside a section, not a row number: ordering a table by
``(run_id, section, rank, key)`` gives the report without numbering rows in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.rules import delta_verdict, diagnosis, is_strong
from gradeloom.functions.text import ALL_BANDS, ERROR_BAND, WEAK_SCORE, band, score_bar, three_digits, trend, two_digits
from gradeloom.operators.aggregate import FAILING_BANDS, run_summary, tag_breakdown, top_weak_tags, weak_tags
from gradeloom.operators.compare import compare_runs, compare_tags
from gradeloom.plans.skew import materialize


def _rows(df: DataFrame, section: str, rank: Column, key: Column, value: Column) -> DataFrame:
    return df.select(
        "run_id",
        F.lit(section).alias("section"),
        rank.cast("double").alias("rank"),
        key.cast("string").alias("key"),
        value.cast("string").alias("value"),
    )


def _unpivot(df: DataFrame, section: str, values: dict[str, Column]) -> DataFrame:
    """One row per named value of a per-run table."""
    items = F.array(
        *[
            F.struct(F.lit(i).alias("rank"), F.lit(k).alias("key"), v.cast("string").alias("value"))
            for i, (k, v) in enumerate(values.items())
        ]
    )
    flat = df.select("run_id", F.explode(items).alias("i"))
    return _rows(flat, section, F.col("i.rank"), F.col("i.key"), F.col("i.value"))


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def next_steps(summary: DataFrame, breakdown: DataFrame, k: int = 5) -> DataFrame:
    """Advice per run: its weakest tags to target, or what to do when none is weak."""
    weak = weak_tags(breakdown).groupBy("run_id").agg(F.count(F.lit(1)).alias("n_weak"))
    advice = (
        F.when(F.col("n_weak") > 0, F.lit(None).cast("string"))
        .when(F.col("avg_score") >= 0.8, "evaluate on real tasks; consider more capacity")
        .when(F.col("avg_score") >= WEAK_SCORE, "check partial answers; target the lowest examples")
        .otherwise("fill data gaps before training longer; compare with the base model")
    )
    general = summary.join(weak, "run_id", "left").select("run_id", advice.alias("advice")).filter("advice IS NOT NULL")
    targets = top_weak_tags(breakdown, k)
    return _rows(general, "next", F.lit(0), F.lit("advice"), F.col("advice")).unionByName(
        _rows(targets, "next", F.col("rank"), F.col("convention"), two_digits(F.col("avg")))
    )


def eval_report(results: DataFrame) -> DataFrame:
    """Overall figures, tags worst first, examples worst first, failures and advice."""
    # Both are small and read by several sections.
    summary = materialize(run_summary(results), "summary")
    tags = materialize(tag_breakdown(results), "tags")
    failing = results.filter(F.col("band").isin(*FAILING_BANDS))
    out_of = {b: F.concat(F.col(b.lower()), F.lit("/"), F.col("total")) for b in ALL_BANDS}
    return _stack(
        [
            _unpivot(summary, "overall", {"average": two_digits(F.col("avg_score")), **out_of}),
            _rows(
                tags, "tags", F.col("avg"), F.col("convention"),
                F.concat_ws(" | ", two_digits(F.col("avg")), F.col("n"), band(F.col("avg"))),
            ),
            _rows(weak_tags(tags), "weak", F.col("avg"), F.col("convention"), two_digits(F.col("avg"))),
            _rows(
                results, "examples", F.col("score"), F.col("id"),
                F.concat_ws(" | ", F.col("label"), two_digits(F.col("score")), F.col("band"), two_digits(F.col("length_ratio"))),
            ),
            _rows(
                failing, "failing", F.col("ord"), F.col("id"),
                F.concat_ws(
                    "\n", F.array_join("conventions_tested", ", "), F.col("source_file"),
                    F.coalesce(F.col("error"), F.concat_ws("\n", F.col("prompt"), F.col("expected"), F.col("generated"))),
                ),
            ),
            next_steps(summary, tags),
        ]
    )


def prompt_baseline_report(results: DataFrame) -> DataFrame:
    """The shorter report of a prompt-only run: overall figures and tags."""
    summary = materialize(run_summary(results), "summary")
    out_of = {b: F.concat(F.col(b.lower()), F.lit("/"), F.col("total")) for b in ALL_BANDS if b != ERROR_BAND}
    tags = tag_breakdown(results)
    shown = F.concat_ws(" | ", three_digits(F.col("avg")), F.col("n"))
    return _unpivot(summary, "overall", {"average": three_digits(F.col("avg_score")), **out_of}).unionByName(
        _rows(tags, "tags", F.col("avg"), F.col("convention"), shown)
    )


def cycle_report(tuned: DataFrame, base: DataFrame, prev: DataFrame) -> DataFrame:
    """Tuned run against its base run and the previous run.

    Each argument holds the results of one run, or no rows where there is none; the sections
    of absent runs are then empty, and the diagnosis judges the tuned run on its own.
    """
    ft, ref, old = (materialize(run_summary(r), "summary") for r in (tuned, base, prev))
    tags, old_tags = materialize(tag_breakdown(tuned), "tags"), tag_breakdown(prev)

    roles = (("ft", ft), ("base", ref), ("prev", old))
    sides = [df.select(F.lit(name).alias("role"), "run_id", "avg_score") for name, df in roles]

    def only(column: str, name: str) -> Column:
        return F.max(F.when(F.col("role") == name, F.col(column)))

    pair = reduce(DataFrame.unionByName, sides).agg(
        only("run_id", "ft").alias("run_id"), *[only("avg_score", name).alias(name) for name, _ in roles]
    )
    f, b, p = F.col("ft"), F.col("base"), F.col("prev")

    def bands(df: DataFrame, section: str) -> DataFrame:
        return _unpivot(df, section, {x: F.col(x.lower()) for x in ALL_BANDS})

    tag_moves = compare_tags(tags, old_tags, keep=["run_id", "n"])
    moves = compare_runs(tuned, prev, keep=["run_id"])
    # Said only where there was a previous run to compare with.
    unmoved = pair.filter(F.col("prev").isNotNull()).join(moves.select("run_id").distinct(), "run_id", "left_anti")
    still = _rows(unmoved, "example changes", F.lit(0), F.lit("none"), F.lit("no meaningful change"))
    return _stack(
        [
            _unpivot(
                pair,
                "summary",
                {
                    "tuned": score_bar(f),
                    "base": score_bar(b),
                    "delta": two_digits(f - b),
                    "verdict": delta_verdict(f, b),
                    "previous": two_digits(p),
                    "trend": F.when(p.isNotNull(), F.concat(trend(f - p), two_digits(F.abs(f - p)))),
                    "diagnosis": diagnosis(f, b),
                    "strong": is_strong(f),
                },
            ).filter("value IS NOT NULL"),
            bands(ft, "tuned bands"),
            bands(ref, "base bands"),
            _rows(tags, "tags", F.col("avg"), F.col("convention"), two_digits(F.col("avg"))),
            _rows(top_weak_tags(tags), "targets", F.col("rank"), F.col("convention"), two_digits(F.col("avg"))),
            _rows(
                tag_moves, "tag changes", -F.abs("delta"), F.col("convention"),
                F.concat(
                    F.col("arrow"), two_digits(F.abs("delta")), F.lit(" | "), two_digits(F.col("prev_avg")), F.lit(" → "),
                    two_digits(F.col("curr_avg")), F.lit(" | "), F.col("n"), F.when(F.col("curr_avg") < WEAK_SCORE, " | weak").otherwise(""),
                ),
            ),
            _rows(
                moves, "example changes",
                F.when(F.col("change") == "improvement", -F.col("delta")).otherwise(F.lit(2.0) + F.col("delta")),
                F.col("id"),
                F.concat_ws(" | ", F.concat_ws(" ", "change", two_digits(F.col("delta"))), "label", two_digits(F.col("prev_score")), two_digits(F.col("curr_score"))),
            ),
            still,
        ]
    )
