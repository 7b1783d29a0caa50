"""Second-opinion scoring: requests for a judge, its responses, and its summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.jsontext import whole_json
from gradeloom.functions.text import ERROR_BAND, band, basis_points, mean_of_points, py_strip, stored_score
from gradeloom.operators.aggregate import band_columns, tag_breakdown
from gradeloom.plans.once import compute_once

# The fences tolerated around a response, and the reasons of unscored rows.
RESPONSE_FENCES = r"\A```(?:json)?\n?|\n?```\z"
NOT_JUDGED = "error_or_empty"
PARSE_FAILURE, CALL_FAILURE = "parse_error: ", "api_error: "
SHOWN_CHARS = 80
# Numbers a response may spell as text.
NUMBER_TEXT = r"(?i)\A\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)\s*\z"


def _eligible() -> Column:
    return (F.col("band") != ERROR_BAND) & (F.coalesce(F.length("generated"), F.lit(0)) > 0)


def judge_requests(results: DataFrame) -> DataFrame:
    """Rows a judge is asked about: not failed, with an answer."""
    return results.filter(_eligible())


def judge_prompt(df: DataFrame, rubric: Column | str) -> DataFrame:
    """Add ``judge_prompt``: the rubric, the task, the reference and the answer to grade."""
    rubric = F.lit(rubric) if isinstance(rubric, str) else rubric

    def section(title: str, body: str, fenced: bool = True) -> list[Column]:
        quote = ("```\n", "\n```") if fenced else ("", "")
        return [F.lit(f"## {title}\n\n{quote[0]}"), F.col(body), F.lit(f"{quote[1]}\n\n")]

    return df.withColumn(
        "judge_prompt",
        F.concat(
            rubric,
            F.lit("\n\n---\n\n"),
            *section("Task", "prompt", fenced=False),
            *section("Reference answer", "expected"),
            *section("Answer to grade", "generated"),
            F.lit("Reply with the JSON object only."),
        ),
    )


def parse_judgement(response: Column, failure: Column | None = None) -> Column:
    """``struct<judge_raw, judge_reason>`` of a judge's response.

    A response that is not an object with a numeric score counts 0.0 with a parse error; a
    failed call (its error type in ``failure``) counts 0.0 as well. Scores are not clamped.
    """
    text = response_text(response)
    return judgement_of(text, whole_json(text), failure)


def response_text(response: Column) -> Column:
    return F.regexp_replace(py_strip(response), RESPONSE_FENCES, "")


def judgement_of(text: Column, parsed: Column, failure: Column | None = None) -> Column:
    """:func:`parse_judgement` of bare response text and its parsed form."""
    shown = F.try_variant_get(parsed, "$.score", "string")
    truth = F.when(shown == "true", 1.0).when(shown == "false", 0.0)
    kind = F.schema_of_variant(F.try_variant_get(parsed, "$.score", "variant"))
    spelled = F.when(F.rlike(shown, F.lit(NUMBER_TEXT)), F.trim(shown).try_cast("double"))
    score = F.when(kind == "BOOLEAN", truth).otherwise(spelled)
    reason = F.try_variant_get(parsed, "$.reason", "variant")
    said = F.when(F.is_variant_null(reason), "None").otherwise(F.coalesce(F.try_variant_get(reason, "$", "string"), F.lit("")))
    bad_call = F.lit(None).cast("string") if failure is None else failure
    return F.struct(
        F.when(bad_call.isNotNull(), 0.0).otherwise(F.coalesce(score, F.lit(0.0))).alias("judge_raw"),
        F.when(bad_call.isNotNull(), F.concat(F.lit(CALL_FAILURE), bad_call))
        .when(score.isNull(), F.concat(F.lit(PARSE_FAILURE), F.left(F.coalesce(text, F.lit("")), F.lit(SHOWN_CHARS))))
        .otherwise(said)
        .alias("judge_reason"),
    )


def judgements(responses: DataFrame) -> DataFrame:
    """Parsed responses ``(run_id, rec_id, judge_raw, judge_reason)``."""
    keys = ["run_id", "rec_id"]
    texts = responses.select(*keys, "failure", response_text(F.col("response")).alias("_text"))
    parsed = texts.withColumn("_json", whole_json(F.col("_text")))
    judged = compute_once(parsed, {"j": judgement_of(F.col("_text"), F.col("_json"), F.col("failure"))})
    return judged.select(*keys, "j.*")


def attach_judgements(results: DataFrame, judged: DataFrame) -> DataFrame:
    """Result rows with judge score (four digits), band and reason.

    Rows no judge was asked about count 0.0; so do rows whose response is missing.
    """
    joined = results.join(judged, ["run_id", "rec_id"], "left")
    asked = _eligible()
    raw = F.when(asked, F.coalesce(F.col("judge_raw"), F.lit(0.0))).otherwise(F.lit(0.0))
    reason = F.when(asked, F.coalesce(F.col("judge_reason"), F.lit(CALL_FAILURE + "missing"))).otherwise(NOT_JUDGED)
    return joined.withColumns(
        {"judge_score": stored_score(raw), "judge_band": band(raw), "judge_reason": reason}
    ).drop("judge_raw")


def judge_summary(judged: DataFrame) -> DataFrame:
    """Judge average over all rows (failed ones as 0) and band counts per run."""
    return (
        judged.groupBy("run_id")
        .agg(
            F.sum(basis_points(F.col("judge_score"))).alias("_bp"),
            F.count(F.lit(1)).alias("total"),
            *band_columns("judge_band"),
        )
        .withColumn("judge_avg", mean_of_points(F.col("_bp"), F.col("total"), 4))
        .drop("_bp", ERROR_BAND.lower())
    )


def judge_tag_breakdown(judged: DataFrame) -> DataFrame:
    return tag_breakdown(judged, "judge_score")


def metric_agreement(run_summary: DataFrame, judge: DataFrame) -> DataFrame:
    """Similarity and judge averages of a run side by side."""
    return run_summary.select("run_id", "avg_score").join(judge.select("run_id", "judge_avg"), "run_id").withColumns(
        {
            "difference": F.col("judge_avg") - F.col("avg_score"),
            "same_band": band(F.col("judge_avg")) == band(F.col("avg_score")),
        }
    )
