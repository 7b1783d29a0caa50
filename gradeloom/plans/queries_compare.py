"""Run history, comparison and rule queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradeloom.functions import names, rules
from gradeloom.functions.text import trend
from gradeloom.operators import aggregate as agg
from gradeloom.operators import compare, runs
from gradeloom.plans import sqltext as q
from gradeloom.plans.registry import query
from gradeloom.plans.skew import materialize
from gradeloom.plans.standins import (
    BASE_RUN, BREAKDOWN_SQL, HISTORY_SQL, NEW_RUN, OLD_RUN, RESULTS_SQL, SUMMARY_SQL, history, results, results_of, table,
)

B = q.ctes(RESULTS_SQL, BREAKDOWN_SQL)
S = q.ctes(RESULTS_SQL, SUMMARY_SQL)

CHANGES = q.ctes(RESULTS_SQL, f"""prev AS (SELECT id, arg_max(score, ord) AS prev_score FROM results WHERE run_id = '{OLD_RUN}' GROUP BY id)""",
    f"""moved AS (SELECT r.id, r.label, r.ord, r.score AS curr_score, p.prev_score, r.score - p.prev_score AS delta
  FROM results r JOIN prev p ON r.id = p.id WHERE r.run_id = '{NEW_RUN}')""",
    """changes AS (SELECT *, CASE WHEN delta <= -5e-2 THEN 'regression' ELSE 'improvement' END AS change FROM moved WHERE delta <= -5e-2 OR delta >= 5e-2)""")


def changes(spark, sf):
    res = materialize(results_of(spark, sf, NEW_RUN, OLD_RUN).select("run_id", "id", "label", "ord", "score"), "scores")
    return compare.compare_runs(res.filter(F.col("run_id") == NEW_RUN), res.filter(F.col("run_id") == OLD_RUN))


@query("compare_runs", CHANGES + "SELECT * FROM changes")
def _(spark, sf):
    return changes(spark, sf)


@query("order_changes", CHANGES + "SELECT id, ord, change, delta FROM changes")
def _(spark, sf):
    return compare.order_changes(changes(spark, sf)).select("id", "ord", "change", "delta")


TAG_MOVES = q.ctes(RESULTS_SQL, BREAKDOWN_SQL, f"""moves AS (SELECT c.convention, c.avg AS curr_avg, p.avg AS prev_avg, c.avg - p.avg AS delta
  FROM breakdown c JOIN breakdown p ON c.convention = p.convention AND c.run_id = '{NEW_RUN}' AND p.run_id = '{OLD_RUN}')""") + """
SELECT *, CASE WHEN abs(delta) < 5e-3 THEN '→' WHEN delta > 0 THEN '▲' ELSE '▼' END AS arrow FROM moves"""


def tag_moves(spark, sf):
    tags = agg.tag_breakdown(results(spark, sf))
    return compare.compare_tags(tags.filter(F.col("run_id") == NEW_RUN), tags.filter(F.col("run_id") == OLD_RUN))


@query("compare_tags", TAG_MOVES)
def _(spark, sf):
    return tag_moves(spark, sf)


@query("order_tag_deltas", TAG_MOVES + " ORDER BY abs(delta) DESC, convention")
def _(spark, sf):
    return compare.order_tag_deltas(tag_moves(spark, sf))


@query("shared_tags", q.ctes(RESULTS_SQL) + f"""SELECT DISTINCT unnest(tags) AS tag FROM results WHERE run_id = '{NEW_RUN}'
INTERSECT SELECT DISTINCT unnest(tags) AS tag FROM results WHERE run_id = '{OLD_RUN}'""")
def _(spark, sf):
    tags = agg.tag_breakdown(results(spark, sf))
    new, old = (tags.filter(F.col("run_id") == r).select(F.col("convention").alias("tag")) for r in (NEW_RUN, OLD_RUN))
    return compare.shared_tags(new, old)


@query("last_wins", "SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1")
def _(spark, sf):
    return compare.last_wins(table(spark, sf, "events").select("user_id", "event_id", "value"), "user_id", "event_id")


@query("base_run_asof", "WITH " + HISTORY_SQL + """,
firsts AS (SELECT r.base_model, r.run_id, arg_min(b.run_id, b.mtime) FILTER (b.ts >= r.ts) AS first_after, arg_max(b.run_id, b.mtime) AS latest
  FROM runs r JOIN runs b ON b.base_model = r.base_model AND b.is_base WHERE NOT r.is_base GROUP BY r.base_model, r.run_id)
SELECT r.base_model, r.run_id, r.ts, coalesce(f.first_after, f.latest) AS base_run, f.first_after IS NOT NULL AS at_or_after
FROM runs r LEFT JOIN firsts f ON f.base_model = r.base_model AND f.run_id = r.run_id WHERE NOT r.is_base""")
def _(spark, sf):
    runs_of_all = history(spark, sf)
    return compare.base_run_asof(runs_of_all.filter("NOT is_base"), runs_of_all.filter("is_base"))


@query("previous_run", "WITH " + HISTORY_SQL + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY mtime DESC, run_id DESC) AS rn FROM runs)
SELECT r.model, r.run_id, CASE WHEN r.rn = 1 THEN s.run_id ELSE t.run_id END AS previous_run
FROM ranked r LEFT JOIN ranked t ON t.model = r.model AND t.rn = 1 LEFT JOIN ranked s ON s.model = r.model AND s.rn = 2""")
def _(spark, sf):
    return compare.previous_run(history(spark, sf))


@query("second_latest_run", "WITH " + HISTORY_SQL + """
SELECT model, run_id AS previous_run FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY mtime DESC, run_id DESC) AS rn FROM runs) WHERE rn = 2""")
def _(spark, sf):
    return compare.previous_run(history(spark, sf), "second_latest")


@query("nth_latest_run", "WITH " + HISTORY_SQL + """
SELECT model, run_id, ts, mtime FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY mtime DESC, run_id DESC) AS rn FROM runs) WHERE rn = 1""")
def _(spark, sf):
    return runs.nth_latest_run(history(spark, sf)).drop("base_model", "is_base")


BASED = q.ctes(RESULTS_SQL, SUMMARY_SQL, f"""pairs AS (SELECT t.run_id, t.avg_score, b.avg_score AS base_avg, t.avg_score - b.avg_score AS delta
  FROM summary t JOIN summary b ON b.run_id = '{BASE_RUN}' WHERE t.run_id <> '{BASE_RUN}')""")


@query("compare_to_base", BASED + """SELECT *, CASE WHEN delta > 5e-2 THEN 'helping' WHEN delta < -5e-2 THEN 'hurting' ELSE 'minimal effect' END AS verdict,
  CASE WHEN avg_score < base_avg - 5e-2 THEN 'hurting' WHEN delta < 5e-2 THEN 'no effect' WHEN avg_score < 35e-2 THEN 'undertrained'
    WHEN avg_score < 6e-1 THEN 'working' ELSE 'good' END AS diagnosis, avg_score >= 8e-1 AS strong FROM pairs""")
def _(spark, sf):
    avgs = agg.run_average(results(spark, sf)).withColumn("base_model", F.lit("base"))
    tuned = avgs.filter(F.col("run_id") != BASE_RUN).drop("n_scored")
    return compare.compare_to_base(tuned, avgs.filter(F.col("run_id") == BASE_RUN)).drop("base_model")


# Checkpoints of each model, one per event, scored by event values; some evaluations fail.
def checkpoints(spark, sf):
    step = F.pmod("event_id", F.lit(900))
    return table(spark, sf, "events").select(
        F.concat(F.lit("m"), "user_id").alias("adapter"),
        F.when(F.pmod("event_id", F.lit(10)) == 9, F.lit("checkpoint-best")).otherwise(F.concat(F.lit("checkpoint-"), step)).alias("name"),
        F.when(F.pmod("event_id", F.lit(4)) != 0, F.floor("value") / 1000).alias("avg_score"),
        "event_id",
    )


CKPT_SQL = """names AS (SELECT event_id, 'm' || user_id AS adapter, CASE WHEN event_id % 10 = 9 THEN 'checkpoint-best' ELSE 'checkpoint-' || (event_id % 900) END AS name,
    CASE WHEN event_id % 4 <> 0 THEN floor(value) / 1000e0 END AS avg_score FROM events),
steps AS (SELECT *, TRY_CAST(string_split(name, '-')[2] AS INT) AS step FROM names),
ckpts AS (SELECT *, adapter || '-ckpt' || step AS candidate FROM steps WHERE step > 0)"""


@query("parse_checkpoint", "WITH " + CKPT_SQL + " SELECT event_id, name, step, candidate FROM ckpts ORDER BY step")
def _(spark, sf):
    return runs.checkpoint_candidates(checkpoints(spark, sf)).select("event_id", "name", "step", "candidate")


def all_candidates(spark, sf):
    ckpts = runs.checkpoint_rows(checkpoints(spark, sf)).select("adapter", "candidate", "step", "avg_score")
    final = (
        table(spark, sf, "events")
        .groupBy(F.concat(F.lit("m"), "user_id").alias("adapter"))
        .agg((F.floor(F.max("value") / 2) / 1000).alias("avg_score"))
        .withColumns({"candidate": F.col("adapter"), "step": F.lit(None).cast("int")})
    )
    return runs.candidates(final, ckpts)


CAND_SQL = CKPT_SQL + """,
cands AS (SELECT adapter, candidate, step, avg_score, false AS is_final, step AS ord FROM ckpts
  UNION ALL SELECT 'm' || user_id, 'm' || user_id, NULL, floor(max(value) / 2) / 1000e0, true, 0 FROM events GROUP BY user_id)"""


@query("candidates", "WITH " + CAND_SQL + " SELECT * FROM cands")
def _(spark, sf):
    return all_candidates(spark, sf)


@query("best_checkpoint", "WITH " + CAND_SQL + """,
usable AS (SELECT *, row_number() OVER (PARTITION BY adapter ORDER BY avg_score DESC, ord) AS rn, count(*) OVER (PARTITION BY adapter) AS n_scored,
  max(avg_score) FILTER (is_final) OVER (PARTITION BY adapter) AS final_score FROM cands WHERE avg_score IS NOT NULL)
SELECT adapter, candidate, step, avg_score, final_score, n_scored, avg_score - final_score AS lead FROM usable WHERE rn = 1""")
def _(spark, sf):
    return runs.best_checkpoint(all_candidates(spark, sf))


@query("parse_run_name", """SELECT event_id, strftime(ts, '%Y-%m-%d_%H%M') AS timestamp, 'org_' || event_type || '_v' || user_id AS model,
  date_trunc('minute', ts) AS ts FROM events""")
def _(spark, sf):
    model = F.concat(F.lit("org/"), "event_type", F.lit("_v"), "user_id")
    name = F.concat(F.date_format("ts", "yyyy-MM-dd_HHmm"), F.lit("_"), names.safe_model(model))
    parsed = table(spark, sf, "events").select("event_id", names.parse_run_name(name).alias("p")).select("event_id", "p.*")
    return parsed.withColumn("ts", names.run_time(F.col("timestamp")).cast("timestamp_ntz"))


@query("run_meta", """SELECT page_id, regexp_extract(url, '([^/]+?)(\\.[^./]*)?$', 1) AS eval_set, CASE WHEN page_id % 2 = 0 THEN '/lora/final' END AS lora_path FROM pages""")
def _(spark, sf):
    model = F.when(F.col("page_id") % 2 == 0, "adapter").otherwise("base")
    meta = names.run_meta(model, F.lit("adapter"), F.col("url"), F.lit("/lora/final"))
    return table(spark, sf, "pages").select("page_id", meta.alias("m")).select("page_id", "m.*")


# ---------------------------------------------------------------- rules over event values

def verdicts(spark, sf, rule):
    """Rules over two scores in [0, 1) and a count made from each event."""
    ev = table(spark, sf, "events").select(
        "event_id", (F.pmod("event_id", F.lit(100)) / 100).alias("a"), (F.floor("value") % 100 / 100).alias("b"),
        F.pmod("user_id", F.lit(20)).alias("n"),
    )
    columns = rule(F.col("a"), F.col("b"), F.col("n"))
    return ev.select("event_id", *[c.alias(name) for name, c in columns.items()])


V = "WITH v AS (SELECT event_id, (event_id % 100) / 1e2 AS a, (CAST(floor(value) AS BIGINT) % 100) / 1e2 AS b, user_id % 20 AS n FROM events) "


@query("boost_priority", V + """SELECT event_id, CASE WHEN n >= 10 AND a < 5e-1 THEN 'critical' WHEN a < 3e-1 THEN 'high' WHEN a < 5e-1 THEN 'medium' ELSE 'low' END AS priority FROM v""")
def _(spark, sf):
    return verdicts(spark, sf, lambda a, b, n: {"priority": rules.boost_priority(a, n)})


@query("skip_reason", V + "SELECT event_id, CASE WHEN a >= 8e-1 THEN 'EXCELLENT' ELSE 'GOOD' END AS reason FROM v")
def _(spark, sf):
    return verdicts(spark, sf, lambda a, b, n: {"reason": rules.skip_reason(a)})


@query("next_action", V + "SELECT event_id, CASE WHEN n > 5 THEN 'GENERATE_DATA' WHEN a < 6e-1 THEN 'TRAIN' WHEN a >= 8e-1 THEN 'DONE' ELSE 'EVAL' END AS action FROM v")
def _(spark, sf):
    return verdicts(spark, sf, lambda a, b, n: {"action": rules.next_action(F.when(n > 5, n).otherwise(0), a)})


@query("delta_verdict", V + "SELECT event_id, CASE WHEN a - b > 5e-2 THEN 'helping' WHEN a - b < -5e-2 THEN 'hurting' ELSE 'minimal effect' END AS verdict FROM v")
def _(spark, sf):
    return verdicts(spark, sf, lambda a, b, n: {"verdict": rules.delta_verdict(a, b)})


@query("diagnosis", V + """SELECT event_id, CASE WHEN a < b - 5e-2 THEN 'hurting' WHEN a - b < 5e-2 THEN 'no effect' WHEN a < 35e-2 THEN 'undertrained' WHEN a < 6e-1 THEN 'working' ELSE 'good' END AS both,
  CASE WHEN a < 35e-2 THEN 'undertrained' WHEN a < 6e-1 THEN 'working' ELSE 'good' END AS alone FROM v""")
def _(spark, sf):
    return verdicts(spark, sf, lambda a, b, n: {"both": rules.diagnosis(a, b), "alone": rules.diagnosis(a)})


@query("is_strong", V + "SELECT event_id, a >= 8e-1 AS strong FROM v")
def _(spark, sf):
    return verdicts(spark, sf, lambda a, b, n: {"strong": rules.is_strong(a)})


@query("trend", V + """SELECT event_id, CASE WHEN a > b THEN '▲' WHEN a < b THEN '▼' ELSE '─' END AS arrow,
  CASE WHEN abs(a - b) < 5e-3 THEN '→' WHEN a > b THEN '▲' ELSE '▼' END AS tag_arrow FROM v""")
def _(spark, sf):
    return verdicts(spark, sf, lambda a, b, n: {"arrow": trend(a - b), "tag_arrow": trend(a - b, compare.TAG_DEAD_ZONE)})


@query("loss_health", "SELECT event_id, CASE WHEN value / 100 > 1 THEN 'not converged' WHEN value / 100 < 15e-2 THEN 'overfit' ELSE 'ok' END AS health FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", rules.loss_health(F.col("value") / 100).alias("health"))


STEPS = """WITH s AS (SELECT user_id, count(*) AS n, 8 * (user_id % 3 + 1) AS eff FROM events GROUP BY user_id),
t AS (SELECT *, greatest(1, 4 * greatest(1, n // eff)) AS auto_steps FROM s) """


def users(spark, sf):
    per = table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return per.withColumn("eff", (F.pmod("user_id", F.lit(3)) + 1) * 8)


@query("auto_steps", STEPS + "SELECT user_id, auto_steps FROM t")
def _(spark, sf):
    return users(spark, sf).select("user_id", rules.auto_steps(F.col("n"), F.col("eff")).alias("auto_steps"))


@query("resolve_steps", STEPS + """, p AS (SELECT *, CASE user_id % 5 WHEN 0 THEN 'canary' WHEN 1 THEN 'steps' WHEN 2 THEN 'manifest' WHEN 3 THEN 'auto' ELSE 'default' END AS step_source FROM t),
r AS (SELECT *, CASE step_source WHEN 'canary' THEN 300 WHEN 'steps' THEN 700 WHEN 'manifest' THEN 650 WHEN 'auto' THEN auto_steps ELSE 2000 END AS steps FROM p)
SELECT user_id, CAST(steps AS BIGINT) AS steps, step_source, steps / CAST(greatest(1, n // eff) AS DOUBLE) AS epochs FROM r""")
def _(spark, sf):
    rule = F.pmod("user_id", F.lit(5))
    resolved = rules.resolve_steps(
        F.when(rule <= 1, 700), rule == 0, F.when(rule <= 2, 650),
        F.when(rule <= 3, rules.auto_steps(F.col("n"), F.col("eff"))), F.lit(2000),
    )
    out = users(spark, sf).withColumn("r", resolved)
    return out.select("user_id", "r.*", rules.epochs_of(F.col("r.steps"), F.col("n"), F.col("eff")).alias("epochs"))
