"""Holdout records and answers to scored result rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.chat import first_by_role
from gradeloom.functions.metrics import Metric, metric, table_metric
from gradeloom.functions.text import ERROR_BAND, band, basis_points, length_ratio, stored_score
from gradeloom.plans.once import compute_once


def with_defaults(df: DataFrame, order_col: str) -> DataFrame:
    """Fill missing id, label, tags and source; ``order_col`` is the zero-based record index."""
    ident = F.coalesce(F.col("id"), F.col(order_col).cast("string"))
    return df.withColumns(
        {
            "id": ident,
            "label": F.coalesce(F.col("label"), ident),
            "conventions_tested": F.coalesce(F.col("conventions_tested"), F.array().cast("array<string>")),
            "source_file": F.coalesce(F.col("source_file"), F.lit("")),
        }
    )


def with_reference(holdout: DataFrame, messages: str = "messages") -> DataFrame:
    """Add ``prompt`` and ``expected`` from the first user and the first assistant turn."""
    return holdout.withColumns(
        {
            "prompt": first_by_role(F.col(messages), "user"),
            "expected": first_by_role(F.col(messages), "assistant"),
        }
    )


def attach_predictions(holdout: DataFrame, predictions: DataFrame, runs: list[str] | None = None) -> DataFrame:
    """Each holdout record with its answer per run.

    ``rec_id`` is unique in the holdout. A record without an answer row becomes an error, so
    with several runs their ids are given and every record is expected once in each. A record and its texts are joined once;
    it is repeated per run only behind the join.
    """
    answer = F.struct("generated", F.col("error").alias("_failed"), F.lit(True).alias("_answered"))
    # Scoring comes next and is bound by CPU: the shuffle of a merge join spreads its rows,
    # where a broadcast of few answers would leave them in as few tasks as the input has blocks.
    if runs is None:
        joined = holdout.join(predictions.select("rec_id", answer.alias("_answer")).hint("merge"), "rec_id", "left")
        return error_row(joined.select(*_quoted(holdout), "_answer.*")).drop("_failed", "_answered")
    named = F.struct("run_id", answer.alias("answer"))
    asked = predictions.filter(F.col("run_id").isin(*runs)).groupBy("rec_id").agg(F.collect_list(named).alias("_answers"))
    joined = holdout.join(asked.hint("merge"), "rec_id", "left")
    none = F.lit(None).cast(asked.schema["_answers"].dataType.elementType["answer"].dataType)

    def of_run(run: str) -> Column:
        run_id = F.lit(run).alias("run_id")
        found = F.transform(F.filter("_answers", lambda a: a["run_id"] == run), lambda a: F.struct(run_id, a["answer"].alias("_answer")))
        return F.when(F.size(found) > 0, found).otherwise(F.array(F.struct(run_id, none.alias("_answer"))))

    rows = joined.select(*_quoted(holdout), F.inline(F.concat(*[of_run(r) for r in runs])))
    return error_row(rows.select(*_quoted(holdout), "run_id", "_answer.*")).drop("_failed", "_answered")


def _quoted(df: DataFrame) -> list[str]:
    return [f"`{c}`" for c in df.columns]


def error_row(joined: DataFrame) -> DataFrame:
    """Add ``error``: the failed call's message, or what the record lacks; null for scorable rows.

    A null answer of a call that did not fail is the empty answer.
    """
    reason = (
        F.when(F.col("expected").isNull(), "no assistant turn")
        .when(F.col("_answered").isNull(), "no prediction")
        .when(F.col("_failed").isNotNull(), F.col("_failed"))
        .when(F.col("prompt").isNull(), "no user turn")
    )
    return joined.withColumn("error", reason).withColumn("generated", F.coalesce(F.col("generated"), F.lit("")))


def score_results(answered: DataFrame, by: str | Metric = "char_ratio", keys: Sequence[str] = ("run_id", "rec_id")) -> DataFrame:
    """Result rows: score (four digits and basis points), band, texts and length ratio.

    Error rows keep their message, score 0 and carry no texts. The metric sees only the two
    texts of scorable rows. ``keys`` are unique and not null; only a metric over tables needs them, to find its rows again.
    """
    ok = F.col("error").isNull()
    by_table = table_metric(by)
    if by_table is None:
        rated = answered.withColumn("_raw", metric(by)(F.when(ok, F.col("expected")), F.when(ok, F.col("generated"))))
    else:
        raws = by_table(answered.filter(ok).select(*keys, "expected", "generated"), keys)
        rated = answered.join(raws.withColumnRenamed("raw", "_raw"), list(keys), "left")
    scored = compute_once(
        rated,
        {
            "score": F.when(ok, stored_score(F.col("_raw"))).otherwise(F.lit(0.0)),
            "band": F.when(ok, band(F.col("_raw"))).otherwise(ERROR_BAND),
        },
    ).drop("_raw")
    text = {c: F.when(ok, F.col(c)).otherwise(F.lit("")) for c in ("prompt", "expected", "generated")}
    return scored.withColumns(
        {
            "score_bp": basis_points(F.col("score")),
            "length_ratio": F.when(ok, length_ratio(F.col("generated"), F.col("expected"))).otherwise(F.lit(0.0)),
            "source_file": F.when(ok, F.col("source_file")),
            **text,
        }
    )
