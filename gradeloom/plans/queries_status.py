"""Status and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradeloom.operators import aggregate as agg
from gradeloom.operators import compare, report, status
from gradeloom.plans import sqltext as q
from gradeloom.plans.registry import query
from gradeloom.plans.skew import materialize
from gradeloom.plans.standins import (
    BASE_RUN, BREAKDOWN_SQL, NEW_RUN, OLD_RUN, RESULTS_SQL, RUNS, SUMMARY_SQL, code_like, code_like_sql, results, table,
)

B = q.ctes(RESULTS_SQL, BREAKDOWN_SQL).rstrip()
BOOST = """boost AS (SELECT run_id, convention AS name, avg AS avg_score, n AS n_holdout_examples,
  CASE WHEN n >= 10 AND avg < 5e-1 THEN 'critical' WHEN avg < 3e-1 THEN 'high' WHEN avg < 5e-1 THEN 'medium' ELSE 'low' END AS priority
  FROM breakdown WHERE avg < 6e-1)"""


def breakdown(spark, sf):
    return agg.tag_breakdown(results(spark, sf))


@query("boost_tags", B + ",\n" + BOOST + " SELECT * FROM boost")
def _(spark, sf):
    return status.boost_tags(breakdown(spark, sf))


@query("order_boost", B + ",\n" + BOOST + " SELECT run_id, name, priority FROM boost")
def _(spark, sf):
    return status.order_boost(status.boost_tags(breakdown(spark, sf))).select("run_id", "name", "priority")


@query("skip_tags", B + " SELECT run_id, convention AS name, avg AS avg_score, CASE WHEN avg >= 8e-1 THEN 'EXCELLENT' ELSE 'GOOD' END AS reason FROM breakdown WHERE avg >= 6e-1")
def _(spark, sf):
    return status.skip_tags(breakdown(spark, sf))


def scores_only(spark, sf):
    """Stored results without their texts, for what never shows them."""
    return materialize(results(spark, sf).drop("prompt", "expected", "generated"), "scores")


def targets(tags):
    """Weak tags and, per run, one tag nothing carries."""
    weak = status.boost_tags(tags).select("run_id", "name", "priority")
    none = tags.select("run_id").distinct().withColumns({"name": F.lit("never-seen"), "priority": F.lit("high")})
    return weak.unionByName(none)


TARGETS = BOOST + """,
targets AS (SELECT run_id, name, priority FROM boost UNION ALL SELECT DISTINCT run_id, 'never-seen', 'high' FROM breakdown)"""


@query("examples_for_tags", B + ",\n" + TARGETS + """,
hits AS (SELECT run_id, unnest(tags) AS name, rec_id, ord, score FROM results WHERE band <> 'ERROR')
SELECT t.run_id, t.name, h.rec_id, h.ord, h.score FROM targets t LEFT JOIN hits h ON h.run_id = t.run_id AND h.name = t.name""")
def _(spark, sf):
    res = scores_only(spark, sf)
    return status.examples_for_tags(res, targets(agg.tag_breakdown(res)))


SEED_SQL = """ranked AS (SELECT *, row_number() OVER (PARTITION BY run_id, name ORDER BY score, ord) AS rank
  FROM (SELECT *, unnest(tags) AS name FROM results WHERE band <> 'ERROR'))"""


@query("seed_candidates", B + ",\n" + TARGETS + ",\n" + SEED_SQL + f"""
SELECT t.run_id, t.name, r.rank, r.id, r.label, {q.rounded('r.score', 3)} AS score, md5({q.strip_fences('r.expected')}) AS expected, md5({q.strip_fences('r.generated')}) AS generated
FROM targets t LEFT JOIN ranked r ON r.run_id = t.run_id AND r.name = t.name AND r.rank <= 3 WHERE t.priority IN ('critical', 'high')""")
def _(spark, sf):
    res = materialize(results(spark, sf), "results")
    seeds = status.seed_candidates(res, targets(agg.tag_breakdown(res)))
    return seeds.select("run_id", "name", "rank", "id", "label", "score", F.md5("expected").alias("expected"), F.md5("generated").alias("generated"))


# Manifests: one row per document, filed under its source, and one per turn, filed under ``chats``.
def doc_manifests(spark, sf):
    def tagged(*tags):
        return F.array(F.struct(F.array_compact(F.array(*tags)).alias("tags")))

    long = F.col("n_chars") > 2000
    return table(spark, sf, "documents").select(
        F.col("source").alias("manifest"),
        tagged(F.col("lang")).alias("patterns"),
        F.struct(
            tagged(F.when(long, F.concat("lang", F.lit("-long")))).alias("contrast_patterns"),
            tagged(F.concat(F.lit("even-"), F.pmod("doc_id", F.lit(2))), F.col("lang")).alias("patterns"),
        ).alias("training"),
    )


@query("manifest_tags", """SELECT DISTINCT source AS manifest, unnest([lang, CASE WHEN n_chars > 2000 THEN lang || '-long' ELSE lang END, 'even-' || (doc_id % 2)]) AS tag FROM documents""")
def _(spark, sf):
    return status.manifest_tags(doc_manifests(spark, sf))


def chat_tags(spark, sf):
    turns = table(spark, sf, "conversations")
    doc = turns.select(
        F.lit("chats").alias("manifest"),
        F.array(F.struct(F.array(F.col("role")).alias("tags"))).alias("patterns"),
        F.struct(
            F.array(F.struct(F.array(F.concat(F.lit("turns-"), F.col("turn") + 1)).alias("tags"))).alias("contrast_patterns"),
            F.array(F.struct(F.array(F.lit("multi-turn")).alias("tags"))).alias("patterns"),
        ).alias("training"),
    )
    return status.manifest_tags(doc)


CHAT_TAGS = "chat_tags AS (SELECT DISTINCT unnest([role, 'turns-' || (turn + 1), 'multi-turn']) AS tag FROM conversations)"


@query("uncovered_tags", B + ",\n" + CHAT_TAGS + " SELECT tag FROM chat_tags WHERE tag NOT IN (SELECT convention FROM breakdown)")
def _(spark, sf):
    return compare.uncovered_tags(chat_tags(spark, sf), agg.tested_tags(breakdown(spark, sf)))


@query("tag_difference", "SELECT DISTINCT lang AS tag FROM documents EXCEPT SELECT DISTINCT lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND quality = 0)")
def _(spark, sf):
    docs, labels = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("tag")), table(spark, sf, "labels")
    bad = docs.join(labels.filter("toxic = 1 AND quality = 0"), "doc_id", "left_semi")
    return compare.tag_difference(docs.select("tag"), bad.select("tag"))


def status_inputs(spark, sf):
    """Scored results with code-like answers, and their runs with looked-up previous and base runs."""
    res = results(spark, sf).withColumn("generated", F.when(F.col("error").isNull(), code_like(F.col("generated"), F.col("rec_id"))).otherwise(""))
    res = materialize(res, "results")
    named = spark.createDataFrame(
        [(r, m, "base", i, f"/data/{m}/holdout_v1.jsonl", "chats") for i, (r, m, _) in enumerate(RUNS)],
        "run_id string, model string, base_model string, mtime bigint, holdout_file string, manifest string",
    ).withColumn("ts", F.to_timestamp(F.substring("run_id", 1, 15), "yyyy-MM-dd_HHmm"))
    prev = compare.previous_run(named).select("run_id", "previous_run")
    base = compare.base_run_asof(named, named.filter("model = 'base'")).select("run_id", "base_run")
    runs = named.select("run_id", "holdout_file", "manifest").join(prev, "run_id", "left").join(base, "run_id", "left")
    cycle = chat_tags(spark, sf).groupBy("manifest").agg(F.count(F.lit(1)).cast("int").alias("cycle"))
    return res, runs, chat_tags(spark, sf), cycle


CODED = f"""flagged AS (SELECT *, starts_with(g, 'func ') AS func_start, len(list_filter(
  CASE WHEN pos > 0 THEN list_slice(ls, 1, pos - 1) ELSE ls END,
  lambda x: starts_with(x, 'package ') OR starts_with(x, 'import ') OR starts_with(x, 'import('))) > 0 AS boilerplate
  FROM (SELECT *, list_position(list_transform(ls, lambda x: starts_with(x, 'func ')), true) AS pos
    FROM (SELECT *, list_transform(regexp_split_to_array(g, {q.LINES}), lambda x: {q.strip('x')}) AS ls
      FROM (SELECT run_id, ord, label, score, length_ratio, {q.strip_fences(code_like_sql('generated', 'rec_id'))} AS g FROM results WHERE band <> 'ERROR'))))"""
LINKS = f"links AS (SELECT * FROM (VALUES ('{BASE_RUN}', NULL, '{BASE_RUN}'), ('{OLD_RUN}', '{NEW_RUN}', '{BASE_RUN}'), ('{NEW_RUN}', '{OLD_RUN}', '{BASE_RUN}')) l(run_id, previous_run, base_run))"


@query("status_summary", B + ",\n" + ",\n".join([BOOST, SUMMARY_SQL, CODED, LINKS, CHAT_TAGS]) + f"""
SELECT s.run_id, (SELECT CAST(count(*) AS INT) FROM chat_tags) AS cycle, 'holdout_v1' AS eval_set,
  CASE WHEN (SELECT count(*) FROM boost b WHERE b.run_id = s.run_id) > 0 THEN 'GENERATE_DATA' WHEN s.avg_score < 6e-1 THEN 'TRAIN' WHEN s.avg_score >= 8e-1 THEN 'DONE' ELSE 'EVAL' END AS action,
  {q.rounded('s.avg_score', 3)} AS avg_similarity, {q.rounded('p.avg_score', 3)} AS previous_avg, {q.rounded('b.avg_score', 3)} AS base_model_avg,
  s.excellent, s.good, s.partial, s.poor, s.total, f.func_start_pct, f.boilerplate_detected
FROM summary s JOIN links l ON l.run_id = s.run_id LEFT JOIN summary p ON p.run_id = l.previous_run LEFT JOIN summary b ON b.run_id = l.base_run
JOIN (SELECT run_id, {q.rounded('100e0 * count(*) FILTER (func_start) / greatest(count(*), 1)', 1)} AS func_start_pct, count(*) FILTER (boilerplate) AS boilerplate_detected FROM flagged GROUP BY run_id) f ON f.run_id = s.run_id""")
def _(spark, sf):
    res, runs, _, cycle = status_inputs(spark, sf)
    return status.status_summary(res, runs, cycle)


@query("build_status", B + ",\n" + ",\n".join([BOOST, CODED, SEED_SQL, CHAT_TAGS]) + f"""
SELECT run_id, section, count(*) AS items, count(DISTINCT name) AS names FROM (
  SELECT run_id, 'summary' AS section, 'x' AS name FROM (SELECT DISTINCT run_id FROM results)
  UNION ALL SELECT run_id, 'boost', name FROM boost
  UNION ALL SELECT run_id, 'skip', convention FROM breakdown WHERE avg >= 6e-1
  UNION ALL SELECT run_id, 'boilerplate', label FROM flagged WHERE boilerplate
  UNION ALL SELECT t.run_id, 'seed', t.name FROM boost t LEFT JOIN ranked r ON r.run_id = t.run_id AND r.name = t.name AND r.rank <= 3 WHERE t.priority IN ('critical', 'high')
  UNION ALL SELECT u.run_id, 'uncovered', c.tag FROM (SELECT DISTINCT run_id FROM results) u, chat_tags c
    WHERE NOT EXISTS (SELECT 1 FROM breakdown b WHERE b.run_id = u.run_id AND b.convention = c.tag))
GROUP BY run_id, section""")
def _(spark, sf):
    rows = status.build_status(status.status_parts(*status_inputs(spark, sf)))
    return rows.groupBy("run_id", "section").agg(
        F.count(F.lit(1)).alias("items"), F.count_distinct("name").alias("names")
    )


# ---------------------------------------------------------------- reports

REPORT_SQL = B + ",\n" + SUMMARY_SQL + f""",
weak AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY avg, convention) AS rank FROM breakdown WHERE avg < 6e-1),
report AS (
  SELECT run_id, 'overall' AS section, CAST(i AS DOUBLE) AS rank, ['average', 'EXCELLENT', 'GOOD', 'PARTIAL', 'POOR', 'ERROR'][i + 1] AS key,
    CASE WHEN i = 0 THEN {q.two_digits('avg_score')} ELSE [0, excellent, good, partial, poor, error][i + 1] || '/' || total END AS value FROM summary, range(6) t(i)
  UNION ALL SELECT run_id, 'tags', avg, convention, {q.two_digits('avg')} || ' | ' || n || ' | ' || {q.band('avg')} FROM breakdown
  UNION ALL SELECT run_id, 'weak', avg, convention, {q.two_digits('avg')} FROM weak
  UNION ALL SELECT run_id, 'examples', score, id, label || ' | ' || {q.two_digits('score')} || ' | ' || band || ' | ' || {q.two_digits('length_ratio')} FROM results
  UNION ALL SELECT run_id, 'failing', CAST(ord AS DOUBLE), id, concat_ws(chr(10), array_to_string(tags, ', '), CASE WHEN error IS NULL THEN '' END, coalesce(error, prompt || chr(10) || expected || chr(10) || generated)) FROM results WHERE band IN ('POOR', 'PARTIAL', 'ERROR')
  UNION ALL SELECT run_id, 'next', CAST(rank AS DOUBLE), convention, {q.two_digits('avg')} FROM weak WHERE rank <= 5
  UNION ALL SELECT run_id, 'next', 0e0, 'advice', CASE WHEN avg_score >= 8e-1 THEN 'evaluate on real tasks; consider more capacity'
    WHEN avg_score >= 6e-1 THEN 'check partial answers; target the lowest examples' ELSE 'fill data gaps before training longer; compare with the base model' END
    FROM summary WHERE run_id NOT IN (SELECT run_id FROM weak))
"""


@query("eval_report", REPORT_SQL + "SELECT run_id, section, rank, key, md5(value) AS value FROM report")
def _(spark, sf):
    rows = report.eval_report(materialize(results(spark, sf), "results"))
    return rows.withColumn("value", F.md5("value"))


@query("next_steps", REPORT_SQL + "SELECT * FROM report WHERE section = 'next'")
def _(spark, sf):
    res = scores_only(spark, sf)
    return report.next_steps(agg.run_summary(res), agg.tag_breakdown(res))


@query("prompt_baseline_report", REPORT_SQL + f"""SELECT run_id, 'overall' AS section, CAST(i AS DOUBLE) AS rank, ['average', 'EXCELLENT', 'GOOD', 'PARTIAL', 'POOR'][i + 1] AS key,
    CASE WHEN i = 0 THEN {q.three_digits('avg_score')} ELSE [0, excellent, good, partial, poor][i + 1] || '/' || total END AS value FROM summary, range(5) t(i)
  UNION ALL SELECT run_id, 'tags', avg, convention, {q.three_digits('avg')} || ' | ' || n FROM breakdown""")
def _(spark, sf):
    return report.prompt_baseline_report(scores_only(spark, sf))


def bar(x: str) -> str:
    return f"'[' || repeat('█', CAST(floor({x} * 30) AS INT)) || repeat('·', 30 - CAST(floor({x} * 30) AS INT)) || '] ' || {q.two_digits(x)}"


CYCLE_SQL = REPORT_SQL + f""",
pair AS (SELECT f.run_id, f.avg_score AS f, b.avg_score AS b, p.avg_score AS p FROM summary f, summary b, summary p
  WHERE f.run_id = '{NEW_RUN}' AND b.run_id = '{BASE_RUN}' AND p.run_id = '{OLD_RUN}'),
prev AS (SELECT id, arg_max(score, ord) AS prev_score FROM results WHERE run_id = '{OLD_RUN}' GROUP BY id),
moves AS (SELECT id, label, score, prev_score, score - prev_score AS d FROM results JOIN prev USING (id) WHERE run_id = '{NEW_RUN}')
SELECT run_id, 'summary' AS section, CAST(i AS DOUBLE) AS rank, ['tuned', 'base', 'delta', 'verdict', 'previous', 'trend', 'diagnosis', 'strong'][i + 1] AS key,
  [{bar('f')}, {bar('b')}, {q.two_digits('f - b')}, CASE WHEN f - b > 5e-2 THEN 'helping' WHEN f - b < -5e-2 THEN 'hurting' ELSE 'minimal effect' END,
   {q.two_digits('p')}, CASE WHEN f - p > 0 THEN '▲' WHEN f - p < 0 THEN '▼' ELSE '─' END || {q.two_digits('abs(f - p)')},
   CASE WHEN f < b - 5e-2 THEN 'hurting' WHEN f - b < 5e-2 THEN 'no effect' WHEN f < 35e-2 THEN 'undertrained' WHEN f < 6e-1 THEN 'working' ELSE 'good' END,
   CAST(f >= 8e-1 AS VARCHAR)][i + 1] AS value FROM pair, range(8) t(i)
UNION ALL SELECT run_id, CASE run_id WHEN '{NEW_RUN}' THEN 'tuned bands' ELSE 'base bands' END, CAST(i AS DOUBLE), ['EXCELLENT', 'GOOD', 'PARTIAL', 'POOR', 'ERROR'][i + 1],
  CAST([excellent, good, partial, poor, error][i + 1] AS VARCHAR) FROM summary, range(5) t(i) WHERE run_id IN ('{NEW_RUN}', '{BASE_RUN}')
UNION ALL SELECT run_id, 'tags', avg, convention, {q.two_digits('avg')} FROM breakdown WHERE run_id = '{NEW_RUN}'
UNION ALL SELECT run_id, 'targets', CAST(rank AS DOUBLE), convention, {q.two_digits('avg')} FROM weak WHERE run_id = '{NEW_RUN}' AND rank <= 5
UNION ALL SELECT c.run_id, 'tag changes', -abs(c.avg - p.avg), c.convention, CASE WHEN abs(c.avg - p.avg) < 5e-3 THEN '→' WHEN c.avg > p.avg THEN '▲' ELSE '▼' END || {q.two_digits('abs(c.avg - p.avg)')}
    || ' | ' || {q.two_digits('p.avg')} || ' → ' || {q.two_digits('c.avg')} || ' | ' || c.n || CASE WHEN c.avg < 6e-1 THEN ' | weak' ELSE '' END
  FROM breakdown c JOIN breakdown p ON c.convention = p.convention AND c.run_id = '{NEW_RUN}' AND p.run_id = '{OLD_RUN}'
UNION ALL SELECT '{NEW_RUN}', 'example changes', CASE WHEN d > 0 THEN -d ELSE 2e0 + d END, id, CASE WHEN d > 0 THEN 'improvement ' ELSE 'regression ' END || {q.two_digits('d')}
    || ' | ' || label || ' | ' || {q.two_digits('prev_score')} || ' | ' || {q.two_digits('score')}
  FROM moves WHERE d <= -5e-2 OR d >= 5e-2
UNION ALL SELECT '{NEW_RUN}', 'example changes', 0e0, 'none', 'no meaningful change' FROM pair WHERE NOT EXISTS (SELECT 1 FROM moves WHERE d <= -5e-2 OR d >= 5e-2)"""


@query("cycle_report", CYCLE_SQL)
def _(spark, sf):
    res = scores_only(spark, sf)
    tuned, base, prev = (res.filter(F.col("run_id") == r) for r in (NEW_RUN, BASE_RUN, OLD_RUN))
    return report.cycle_report(tuned, base, prev)
