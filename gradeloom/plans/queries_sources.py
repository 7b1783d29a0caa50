"""Source and sink queries: derived tables written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradeloom.operators import prepare, status, validate
from gradeloom.operators.aggregate import run_summary
from gradeloom.operators.judge import judge_summary
from gradeloom.plans import sqltext as q
from gradeloom.plans.queries_judge import JUDGE_SUMMARY, PARSED_SQL, judged
from gradeloom.plans.queries_prepare import E, PROMPT, SPLIT, ids_sql, split_examples
from gradeloom.plans.queries_status import B, BOOST, CODED, status_inputs
from gradeloom.plans.registry import query
from gradeloom.plans.skew import materialize
from gradeloom.plans.standins import (
    BREAKDOWN_SQL, EXAMPLE_BLOCK_SQL, EXAMPLE_TAGS_SQL, EXAMPLES_SQL, LOG_LINES_SQL, RESULTS_SQL, SUMMARY_SQL,
    RUN_IDS, examples, log_lines, results, table,
)
from gradeloom.session import scratch_path
from gradeloom.sources import readers, sinks


@query("read_examples", E + "SELECT endpoint, question, md5(api_call) AS api_call FROM examples")
def _(spark, sf):
    """JSONL per endpoint, with blank lines between the records."""
    path = scratch_path(spark, "examples")
    ex = examples(spark, sf)
    line = F.concat(F.lit('{"question": "'), "question", F.lit('", "api_call": '), "api_call", F.lit("}"))
    blank = F.when(F.pmod("key", F.lit(5)) == 0, F.array(line, F.lit("  "))).otherwise(F.array(line))
    ex.select("endpoint", F.explode(blank).alias("value")).write.partitionBy("endpoint").text(path)
    back = readers.read_examples(spark, path, glob="endpoint=*/part-*")
    return back.select("endpoint", "question", F.md5(_spaced(F.col("api_call"))).alias("api_call"))


def _spaced(call):
    """The reader hands on compact JSON; the examples are written with spaces."""
    return F.regexp_replace(F.regexp_replace(call, '":', '": '), ',"', ', "')


@query("read_examples_quarantine", "SELECT event_id % 3 = 0 AS malformed, count(*) AS n FROM events GROUP BY 1")
def _(spark, sf):
    path = scratch_path(spark, "quarantine")
    line = F.when(F.pmod("key", F.lit(3)) == 0, F.concat(F.lit("{"), "question")).otherwise(
        F.concat(F.lit('{"question": "'), "question", F.lit('", "api_call": '), "api_call", F.lit("}"))
    )
    examples(spark, sf).select("endpoint", line.alias("value")).write.partitionBy("endpoint").text(path)
    back = readers.read_examples(spark, path, mode="quarantine", glob="endpoint=*/part-*")
    return back.groupBy(F.col("malformed").isNotNull().alias("malformed")).agg(F.count(F.lit(1)).alias("n"))


@query("write_sharegpt", E + f"SELECT '{PROMPT}' AS system, question AS human, {EXAMPLE_BLOCK_SQL} AS gpt FROM examples")
def _(spark, sf):
    path = scratch_path(spark, "sharegpt")
    sinks.write_sharegpt(prepare.to_sharegpt(examples(spark, sf), PROMPT), path)
    c = F.col("conversations")
    return readers.read_sharegpt(spark, path).select(
        c[0]["value"].alias("system"), c[1]["value"].alias("human"), c[2]["value"].alias("gpt")
    )


@query("write_holdout", q.ctes(EXAMPLES_SQL, SPLIT, ids_sql("(SELECT * FROM split WHERE split = 'holdout')")) + f"""
SELECT id, question AS label, {EXAMPLE_TAGS_SQL} AS tags, {EXAMPLE_BLOCK_SQL} AS assistant FROM ids""")
def _(spark, sf):
    path = scratch_path(spark, "holdout")
    sinks.write_holdout(prepare.to_holdout(split_examples(spark, sf).filter("split = 'holdout'"), PROMPT), path)
    return readers.read_holdout(spark, path).select(
        "id", "label", F.array_join("conventions_tested", ",").alias("tags"), F.col("messages")[2]["content"].alias("assistant")
    )


@query("write_partitioned", q.ctes(EXAMPLES_SQL, SPLIT) + "SELECT endpoint, split, count(*) AS n FROM split GROUP BY endpoint, split")
def _(spark, sf):
    path = scratch_path(spark, "partitioned")
    rows = split_examples(spark, sf)
    sinks.write_partitioned(rows, path)
    back = spark.read.schema(rows.schema).json(path)
    return back.groupBy("endpoint", "split").agg(F.count(F.lit(1)).alias("n"))


@query("sync_endpoints", E + "SELECT endpoint, key, question FROM examples WHERE endpoint <> 'error'")
def _(spark, sf):
    """Four endpoints synced, two of them twice; the rows of the second sync replace the first."""
    path = scratch_path(spark, "sync")
    ex = examples(spark, sf)
    stale = ex.withColumn("question", F.lit("stale"))
    sinks.sync_endpoints(stale, path, ["view", "click"])
    sinks.sync_endpoints(ex, path, ["click", "purchase", "signup", "view"])
    return spark.read.schema(ex.schema).parquet(path).select("endpoint", "key", "question")


@query("write_run", q.ctes(RESULTS_SQL, BREAKDOWN_SQL, SUMMARY_SQL) + """
SELECT r.run_id, r.rec_id, r.id, r.label, r.score, r.band, r.error, md5(r.generated) AS generated, s.avg_score, s.total, s.run_id || '.yaml' AS manifest FROM results r JOIN summary s ON r.run_id = s.run_id
UNION ALL SELECT run_id, NULL, convention, NULL, avg, NULL, NULL, NULL, NULL, n, NULL FROM breakdown""")
def _(spark, sf):
    path = scratch_path(spark, "runs")
    res = materialize(_with_model(results(spark, sf)), "results")
    meta = res.select("run_id", "model").distinct().withColumn("manifest", F.concat("run_id", F.lit(".yaml")))
    sinks.write_run(res, run_summary(res), path, meta)
    back = readers.read_run_tables(spark, path)
    rows = back["run_results"].join(back["runs"].select("run_id", "avg_score", "total", "manifest"), "run_id")
    nothing = F.lit(None)
    tags = back["run_tags"].select(
        "run_id", nothing.cast("bigint").alias("rec_id"), F.col("convention").alias("id"), nothing.cast("string").alias("label"), F.col("avg").alias("score"),
        *[nothing.cast("string").alias(c) for c in ("band", "error", "generated")], nothing.cast("double").alias("avg_score"), F.col("n").alias("total"), nothing.cast("string").alias("manifest"),
    )
    rows = rows.select("run_id", "rec_id", "id", "label", "score", "band", "error", F.md5("generated").alias("generated"), "avg_score", "total", "manifest")
    return rows.unionByName(tags)


def _with_model(res):
    return res.withColumn("model", F.element_at(F.split("run_id", "_"), -1))


@query("read_runs", q.ctes(RESULTS_SQL, BREAKDOWN_SQL, SUMMARY_SQL) + f"""
SELECT s.run_id, split_part(s.run_id, '_', 3) AS model, s.avg_score, s.excellent, s.total AS n_records, (SELECT count(*) FROM breakdown b WHERE b.run_id = s.run_id) AS n_tags,
  (SELECT CAST(sum(n) AS BIGINT) FROM breakdown b WHERE b.run_id = s.run_id) AS tag_scores, (SELECT count(*) FROM breakdown b WHERE b.run_id = s.run_id AND avg < 6e-1) AS n_weak,
  (SELECT CAST(sum(length(generated)) AS BIGINT) FROM results r WHERE r.run_id = s.run_id) AS answer_chars FROM summary s""")
def _(spark, sf):
    """Nested documents of all runs by name, written one file per run and read back into rows."""
    path = scratch_path(spark, "documents")
    res = materialize(_with_model(results(spark, sf)), "results")
    runs = res.select("run_id", "model").distinct().withColumn("base_model", F.lit("base"))
    sinks.write_documents(sinks.run_documents(res, runs, RUN_IDS), path)
    docs = readers.read_runs(spark, path, on_error="fail", glob=readers.RUN_FOLDER_GLOB)
    run_table, tags, rows = readers.run_rows(docs)
    per_tag = tags.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_tags"), F.sum(F.size("scores")).alias("tag_scores"), F.count_if(F.col("avg") < 0.6).alias("n_weak")
    )
    chars = rows.groupBy("run_id").agg(F.sum(F.length("generated")).alias("answer_chars"))
    return run_table.select(
        "run_id", "model", "avg_score", F.coalesce(F.col("band_counts")["EXCELLENT"], F.lit(0)).alias("excellent"),
        F.col("n_records").cast("bigint").alias("n_records"),
    ).join(per_tag, "run_id").join(chars, "run_id")


@query("read_results", q.ctes(RESULTS_SQL) + "SELECT run_id, rec_id, score, band FROM results WHERE model = 'adapter'")
def _(spark, sf):
    path = scratch_path(spark, "stored")
    res = results(spark, sf).withColumn("model", F.element_at(F.split("run_id", "_"), -1))
    sinks.write_tables(path, ["model", "run_id"], run_results=res)
    return readers.read_results(spark, path, model="adapter").select("run_id", "rec_id", "score", "band")


@query("cluster_runs", q.ctes(RESULTS_SQL, BREAKDOWN_SQL) + """SELECT r.run_id, r.rec_id, r.score, r.band, n.n_tags FROM results r
JOIN (SELECT run_id, count(*) AS n_tags FROM breakdown GROUP BY run_id) n ON n.run_id = r.run_id""")
def _(spark, sf):
    path = scratch_path(spark, "clustered")
    res = materialize(_with_model(results(spark, sf)), "results")
    sinks.write_run(res, run_summary(res), f"{path}/by-run")
    sinks.cluster_runs(spark, f"{path}/by-run", f"{path}/by-model")
    tags = readers.read_run_tables(spark, f"{path}/by-model")["run_tags"].groupBy("run_id").agg(F.count(F.lit(1)).alias("n_tags"))
    return readers.read_results(spark, f"{path}/by-model").select("run_id", "rec_id", "score", "band").join(tags, "run_id")


@query("write_judged", q.ctes(RESULTS_SQL, PARSED_SQL, JUDGE_SUMMARY) + "SELECT * FROM judge_summary")
def _(spark, sf):
    path = scratch_path(spark, "judged")
    rows = _with_model(judged(spark, sf))
    sinks.write_judged(rows, path)
    back = readers.read_run_tables(spark, path, "judged_")
    return judge_summary(back["run_results"])


@query("write_status", B + ",\n" + ",\n".join([BOOST, CODED]) + """
SELECT r.run_id, (SELECT count(*) FROM boost b WHERE b.run_id = r.run_id) AS n_boost,
  (SELECT count(*) FROM breakdown b WHERE b.run_id = r.run_id AND avg >= 6e-1) AS n_skip,
  (SELECT count(*) FROM flagged b WHERE b.run_id = r.run_id AND boilerplate) AS n_boilerplate,
  (SELECT count(*) FROM boost b WHERE b.run_id = r.run_id AND priority IN ('critical', 'high')) AS n_seed_tags,
  (SELECT arg_min(name, (CASE priority WHEN 'critical' THEN 0 WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END, avg_score, name)) FROM boost b WHERE b.run_id = r.run_id) AS first_boost
FROM (SELECT DISTINCT run_id FROM results) r""")
def _(spark, sf):
    """Nested status documents written and read back."""
    path = scratch_path(spark, "status")
    res, runs, tags, cycle = status_inputs(spark, sf)
    parts = status.status_parts(res, runs, tags, cycle)
    docs = sinks.status_documents(parts, RUN_IDS)
    sinks.write_documents(docs, path)
    back = spark.read.schema(docs.schema).json(path)
    return back.select(
        "run_id",
        F.size("boost_conventions").cast("bigint").alias("n_boost"),
        F.size("skip_conventions").cast("bigint").alias("n_skip"),
        F.size("format_health.boilerplate_cases").cast("bigint").alias("n_boilerplate"),
        F.size(F.map_keys("seed_candidates")).cast("bigint").alias("n_seed_tags"),
        F.get(F.col("boost_conventions"), F.lit(0))["name"].alias("first_boost"),
    )


@query("read_log", "WITH " + LOG_LINES_SQL + " SELECT date_trunc('second', ts) AS ts, upper(event_type) AS level, md5('  ' || line) AS msg FROM log_lines")
def _(spark, sf):
    path = scratch_path(spark, "log")
    log_lines(spark, sf).select("value").write.text(path)
    return readers.read_log(spark, path).select("ts", "level", F.md5("msg").alias("msg"))


@query("read_manifest", """SELECT source AS part, count(*) AS n, count(*) FILTER (doc_id % 3 <> 1) AS with_steps, count(*) FILTER (doc_id % 3 = 1) AS ignored,
  CAST(sum(doc_id) FILTER (doc_id % 3 <> 1) AS BIGINT) AS steps FROM documents GROUP BY source""")
def _(spark, sf):
    """One manifest per document, its step count an integer, text that is none, or an integer as text."""
    path = scratch_path(spark, "manifest")
    rule = F.pmod("doc_id", F.lit(3))
    steps = F.when(rule == 0, F.col("doc_id").cast("string")).when(rule == 1, '"many"').otherwise(
        F.concat(F.lit('"'), "doc_id", F.lit('"'))
    )
    doc = F.concat(F.lit('{"meta": {"cycle": 3, "max_steps": '), steps, F.lit('}, "patterns": [{"tags": ["'), "source", F.lit('"]}]}'))
    docs = table(spark, sf, "documents").select(doc.alias("value"))
    docs.write.text(path)
    back = readers.read_manifest(spark, path, multi_line=False)
    return back.groupBy(F.col("patterns")[0]["tags"][0].alias("part")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("max_steps").alias("with_steps"),
        F.count("max_steps_ignored").alias("ignored"),
        F.sum("max_steps").alias("steps"),
    )


@query("resolve_dataset", q.ctes(EXAMPLES_SQL) + "SELECT key, question FROM examples WHERE key % 2 = 1")
def _(spark, sf):
    """Two data versions side by side; only the asked-for one is read."""
    path = scratch_path(spark, "versions")
    rows = examples(spark, sf).select("key", "question")
    for version, rest in (("20260101", 0), ("20260201", 1)):
        train, _ = readers.resolve_dataset(path, version)
        rows.filter(F.pmod("key", F.lit(2)) == rest).write.json(train)
    train, _ = readers.resolve_dataset(path, "20260201")
    return spark.read.schema(rows.schema).json(train)


@query("with_ordinal", """SELECT count(*) FILTER (event_id % 4 <> 0) AS records, count(*) FILTER (event_id % 4 <> 0) AS places, true AS gapless, true AS ordered FROM events""")
def _(spark, sf):
    """Ordinals over written lines, a quarter of them blank: per file they run from 1 without gaps."""
    path = scratch_path(spark, "lines")
    value = F.when(F.pmod("event_id", F.lit(4)) != 0, F.col("event_id").cast("string")).otherwise("  ")
    table(spark, sf, "events").select(value.alias("value")).repartition(3).write.text(path)
    rows = validate.with_ordinal(readers.read_lines(spark, path))
    per_file = rows.groupBy("path").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("record_no").alias("places"),
        F.max("record_no").alias("last"),
        F.bool_and(F.col("line_no") >= F.col("record_no")).alias("ordered"),
    )
    return per_file.agg(
        F.sum("n").alias("records"),
        F.sum("places").alias("places"),
        F.bool_and(F.col("n") == F.col("last")).alias("gapless"),
        F.bool_and("ordered").alias("ordered"),
    )
