"""Training-log queries in batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradeloom.functions.logs import parse_log_line
from gradeloom.operators import trainlog
from gradeloom.plans.registry import query
from gradeloom.plans.standins import LOG_LINES_SQL, POINTS_SQL, log_lines

GAP, WALL = 6 * 3600, 7 * 24 * 3600
P = "WITH " + POINTS_SQL + "\n"


def points(spark, sf):
    return trainlog.loss_points(log_lines(spark, sf))


@query("parse_loss", P + "SELECT run, ord, epoch, loss FROM points")
def _(spark, sf):
    return points(spark, sf)


@query("parse_log_line", "WITH " + LOG_LINES_SQL + " SELECT ord, date_trunc('second', ts) AS ts, upper(event_type) AS level, '  ' || line AS msg FROM log_lines")
def _(spark, sf):
    return log_lines(spark, sf).select("ord", parse_log_line(F.col("value")).alias("p")).select("ord", "p.*")


SUMMARY = P.rstrip() + """, loss_summary AS (SELECT run, arg_min(loss, ord) AS first_loss, arg_max(loss, ord) AS final_loss, arg_max(epoch, ord) AS final_epoch, count(*) AS n_points
  FROM points GROUP BY run)"""


@query("loss_summary", SUMMARY + "SELECT *, CASE WHEN final_loss > 1 THEN 'not converged' WHEN final_loss < 15e-2 THEN 'overfit' ELSE 'ok' END AS health FROM loss_summary")
def _(spark, sf):
    return trainlog.loss_summary(points(spark, sf))


@query("step_estimate", SUMMARY + """, est AS (SELECT *, CASE WHEN run % 4 <> 0 THEN 300 + run END AS steps FROM loss_summary),
rated AS (SELECT *, (first_loss - final_loss) / steps AS r, first_loss > final_loss AND final_loss > 6e-1 AS more, steps IS NOT NULL AND n_points >= 3 AS usable FROM est),
extra AS (SELECT *, CASE WHEN usable AND more THEN CAST(trunc((final_loss - 6e-1) / r) AS BIGINT) END AS extra_steps FROM rated)
SELECT run, steps, CASE WHEN NOT usable THEN NULL WHEN more THEN 'estimate' WHEN first_loss > final_loss THEN 'may be sufficient' ELSE 'did not decrease' END AS verdict,
  CASE WHEN usable AND more THEN r END AS rate, extra_steps, steps + extra_steps AS total_steps,
  CAST(trunc((steps + extra_steps) * 12e-1 / 100e0 + 1) AS BIGINT) * 100 AS suggested_steps FROM extra""")
def _(spark, sf):
    summary = trainlog.loss_summary(points(spark, sf)).withColumn("steps", F.when(F.col("run") % 4 != 0, F.col("run") + 300))
    return trainlog.with_step_estimate(summary).select(
        "run", "steps", "verdict", "rate", "extra_steps", "total_steps", "suggested_steps"
    )


@query("early_warning", P + """SELECT run, ord, epoch, loss FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY ord) AS rn
  FROM points WHERE epoch > 2e-1 AND loss > 15e-1) WHERE rn = 1""")
def _(spark, sf):
    return trainlog.early_warning(points(spark, sf))


@query("silence_gaps", f"""SELECT user_id AS run, ts, prev_ts, (epoch_us(ts) - epoch_us(prev_ts)) / 1e6 AS gap_seconds
FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts FROM events)
WHERE epoch_us(ts) - epoch_us(prev_ts) > {GAP * 1000000}""")
def _(spark, sf):
    return trainlog.silence_gaps(log_lines(spark, sf), GAP)


@query("wall_overruns", f"""SELECT run, ord, ts, start_ts, (epoch_us(ts) - epoch_us(start_ts)) / 1e6 AS elapsed_seconds
FROM (SELECT user_id AS run, event_id AS ord, ts, min(ts) OVER (PARTITION BY user_id) AS start_ts FROM events)
WHERE epoch_us(ts) - epoch_us(start_ts) > {WALL * 1000000}""")
def _(spark, sf):
    return trainlog.wall_overruns(log_lines(spark, sf), WALL)
