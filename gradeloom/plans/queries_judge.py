"""Judge queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradeloom.operators import aggregate as agg
from gradeloom.operators import judge
from gradeloom.plans import sqltext as q
from gradeloom.plans.registry import query
from gradeloom.plans.skew import materialize
from gradeloom.plans.standins import RESULTS_SQL, SUMMARY_SQL, breakdown_sql, results

RUBRIC = "Grade from 0.0 to 1.0."


def response(key):
    """A judge's response by record: plain, fenced, numeric text, no score, no JSON, null score, boolean."""
    rule = F.pmod(key, F.lit(9))
    number = F.concat(F.lit("0."), F.pmod(key, F.lit(10)).cast("string"), F.lit("5"))
    plain = F.concat(F.lit('{"score": '), number, F.lit(', "reason": "r'), key.cast("string"), F.lit('"}'))
    return (
        F.when(rule == 1, F.concat(F.lit("```json\n"), plain, F.lit("\n```")))
        .when(rule == 2, F.concat(F.lit(' {"score": "'), number, F.lit('"}')))
        .when(rule == 3, F.lit('{"reason": "x"}'))
        .when(rule == 4, F.concat(F.lit("not json "), F.repeat(F.lit("z"), 90)))
        .when(rule == 5, F.lit('{"score": null, "reason": "y"}'))
        .when(rule == 6, F.lit('{"score": true, "reason": null}'))
        .when(rule == 7, F.concat(F.lit("```\n"), plain, F.lit("```")))
        .otherwise(plain)
    )


def responses(res):
    key = F.col("rec_id")
    asked = judge.judge_requests(res)
    return asked.select(
        "run_id", "rec_id", response(key).alias("response"), F.when(F.pmod(key, F.lit(13)) == 12, "APITimeoutError").alias("failure")
    )


def judged(spark, sf):
    res = materialize(results(spark, sf), "results")
    return judge.attach_judgements(res, judge.judgements(responses(res)))


_NUM = "('0.' || (rec_id % 10) || '5')"
_PLAIN = f"""('{{"score": ' || {_NUM} || ', "reason": "r' || rec_id || '"}}')"""
PARSED_SQL = f"""asked AS (SELECT *, band <> 'ERROR' AND length(generated) > 0 AS asked FROM results),
verdicts AS (SELECT *, CASE WHEN rec_id % 13 = 12 THEN 0e0 WHEN rec_id % 9 IN (3, 4, 5) THEN 0e0 WHEN rec_id % 9 = 6 THEN 1e0 ELSE CAST({_NUM} AS DOUBLE) END AS raw,
  CASE WHEN rec_id % 13 = 12 THEN 'api_error: APITimeoutError' WHEN rec_id % 9 = 3 THEN 'parse_error: {{"reason": "x"}}'
    WHEN rec_id % 9 = 4 THEN 'parse_error: not json ' || repeat('z', 71) WHEN rec_id % 9 = 5 THEN 'parse_error: {{"score": null, "reason": "y"}}'
    WHEN rec_id % 9 = 6 THEN 'None' WHEN rec_id % 9 = 2 THEN '' ELSE 'r' || rec_id END AS reason FROM asked),
judged AS (SELECT *, CASE WHEN asked THEN raw ELSE 0e0 END AS judge_score, {q.band("CASE WHEN asked THEN raw ELSE 0e0 END")} AS judge_band,
  CASE WHEN asked THEN reason ELSE 'error_or_empty' END AS judge_reason FROM verdicts)"""
J = q.ctes(RESULTS_SQL, PARSED_SQL)


@query("judge_requests", J + "SELECT run_id, rec_id FROM asked WHERE asked")
def _(spark, sf):
    return judge.judge_requests(results(spark, sf)).select("run_id", "rec_id")


@query("judge_prompt", J + f"""SELECT run_id, rec_id, md5('{RUBRIC}' || e'\\n\\n---\\n\\n## Task\\n\\n' || prompt || e'\\n\\n## Reference answer\\n\\n```\\n' || expected
  || e'\\n```\\n\\n## Answer to grade\\n\\n```\\n' || generated || e'\\n```\\n\\nReply with the JSON object only.') AS prompt FROM asked WHERE asked""")
def _(spark, sf):
    asked = judge.judge_prompt(judge.judge_requests(results(spark, sf)), RUBRIC)
    return asked.select("run_id", "rec_id", F.md5("judge_prompt").alias("prompt"))


@query("parse_judgement", J + "SELECT run_id, rec_id, raw AS judge_raw, reason AS judge_reason FROM verdicts WHERE asked")
def _(spark, sf):
    return judge.judgements(responses(results(spark, sf)))


@query("attach_judgements", J + "SELECT run_id, rec_id, judge_score, judge_band, judge_reason FROM judged")
def _(spark, sf):
    return judged(spark, sf).select("run_id", "rec_id", "judge_score", "judge_band", "judge_reason")


JUDGE_SUMMARY = f"""judge_summary AS (SELECT run_id, count(*) AS total, {q.band_counts('judge_band').rsplit(', ', 1)[0]},
  {q.rounded('CAST(sum(CAST(round(judge_score*1e4) AS BIGINT)) AS DOUBLE) / (count(*)*1e4)', 4)} AS judge_avg FROM judged GROUP BY run_id)"""


@query("judge_summary", J.rstrip() + ",\n" + JUDGE_SUMMARY + " SELECT * FROM judge_summary")
def _(spark, sf):
    return judge.judge_summary(judged(spark, sf))


@query("judge_tag_breakdown", J.rstrip() + ",\n" + breakdown_sql("judge_score", "judged") + " SELECT * FROM breakdown")
def _(spark, sf):
    return judge.judge_tag_breakdown(judged(spark, sf))


@query("metric_agreement", J.rstrip() + ",\n" + JUDGE_SUMMARY + ",\n" + SUMMARY_SQL + f"""
SELECT run_id, avg_score, judge_avg, judge_avg - avg_score AS difference, {q.band('judge_avg')} = {q.band('avg_score')} AS same_band
FROM summary JOIN judge_summary USING (run_id)""")
def _(spark, sf):
    rows = materialize(judged(spark, sf), "judged")
    return judge.metric_agreement(agg.run_summary(rows), judge.judge_summary(rows))
