import json

import pytest
from pyspark.sql import functions as F

from conftest import FAILED
from gradeloom.operators import aggregate as agg
from gradeloom.operators import compare, judge, report, runs, scoring, status
from gradeloom.functions.names import parse_run_name, run_meta
from gradeloom.sources import readers, sinks


def msgs(*pairs):
    return [{"role": r, "content": c} for r, c in pairs]


HOLDOUT = [
    (0, "h0", "first", msgs(("system", "s"), ("user", "p"), ("assistant", "abcd"), ("assistant", "zz")), ["a"], "f.go"),
    (1, None, None, msgs(("user", "p"), ("assistant", "abcd")), None, None),
    (2, "h2", None, msgs(("user", "p")), ["a"], None),
    (3, "h3", None, msgs(("assistant", "abcd")), ["b"], None),
    (4, "h4", None, msgs(("user", "p"), ("assistant", "abcd")), ["b"], None),
    (5, "h5", None, msgs(("user", "p"), ("assistant", "abcd")), ["a", "b"], None),
]
PREDICTIONS = [(0, "abcd", None), (1, None, None), (2, "x", None), (3, "x", None), (4, None, "timeout")]


def scored(spark):
    holdout = spark.createDataFrame(
        HOLDOUT,
        "rec_id bigint, id string, label string, messages array<struct<role string, content string>>, conventions_tested array<string>, source_file string",
    )
    full = scoring.with_reference(scoring.with_defaults(holdout, "rec_id")).withColumn("ord", F.col("rec_id"))
    answers = spark.createDataFrame(PREDICTIONS, "rec_id bigint, generated string, error string")
    return scoring.score_results(scoring.attach_predictions(full, answers)).withColumn("run_id", F.lit("r"))


def test_result_rows(spark):
    rows = {r.rec_id: r for r in scored(spark).collect()}
    assert (rows[0].score, rows[0].band, rows[0].source_file, rows[0].error) == (1.0, "EXCELLENT", "f.go", None)
    assert (rows[1].id, rows[1].label, rows[1].conventions_tested, rows[1].score, rows[1].band) == ("1", "1", [], 0.0, "POOR")
    errors = {i: rows[i].error for i in (2, 3, 4, 5)}
    assert errors == {2: "no assistant turn", 3: "no user turn", 4: "timeout", 5: "no prediction"}
    for i in errors:
        r = rows[i]
        assert (r.score, r.band, r.prompt, r.expected, r.generated, r.length_ratio, r.source_file) == (0.0, "ERROR", "", "", "", 0.0, None)


def test_averages_treat_errors_differently(spark):
    res = scored(spark)
    assert agg.run_average(res).first().avg_score == 0.5
    tags = {r.convention: (r.avg, r.n) for r in agg.tag_breakdown(res).collect()}
    assert tags == {"a": (0.333, 3), "b": (0.0, 3)}
    row = agg.band_counts(res).first()
    assert (row.excellent, row.good, row.partial, row.poor, row.error) == (1, 0, 0, 1, 4)


def test_all_failed_run_averages_zero(spark):
    res = scored(spark).filter("band = 'ERROR'")
    assert agg.run_average(res).first().avg_score == 0.0


def scores(spark, rows):
    return spark.createDataFrame(rows, "id string, label string, ord bigint, score double")


def test_compare_runs_boundaries(spark):
    prev = scores(spark, [("a", "a", 0, 0.5), ("b", "b", 1, 0.5), ("c", "c", 2, 0.5), ("d", "d", 3, 0.1), ("d", "d", 4, 0.9), ("x", "x", 5, 0.9)])
    curr = scores(spark, [("a", "a", 0, 0.55), ("b", "b", 1, 0.45), ("c", "c", 2, 0.5499), ("d", "d", 3, 0.9), ("y", "y", 4, 0.1)])
    expected = {}
    for cid, now, before in (("a", 0.55, 0.5), ("b", 0.45, 0.5)):
        d = now - before
        if d <= -0.05 or d >= 0.05:
            expected[cid] = "improvement" if d > 0 else "regression"
    assert {r.id: r.change for r in compare.compare_runs(curr, prev).collect()} == expected


def minute(hhmm):
    return f"2026-01-02_{hhmm}"


@pytest.mark.parametrize(
    "bases,match,after", [(["0900", "1100"], "1100", True), (["1000"], "1000", True), (["0800", "0900"], "0900", False)]
)
def test_base_run_asof(spark, bases, match, after):
    kind = "base_model string, run_id string, ts timestamp, mtime bigint"
    ts = F.to_timestamp("run_id", "yyyy-MM-dd_HHmm")

    def frame(times):
        return spark.createDataFrame([("m", minute(t), None, i) for i, t in enumerate(times)], kind).withColumn("ts", ts)

    row = compare.base_run_asof(frame(["1000"]), frame(bases)).first()
    assert (row.base_run, row.at_or_after) == (minute(match), after)


def test_base_run_asof_without_base(spark):
    kind = "base_model string, run_id string, ts timestamp, mtime bigint"
    runs_df = spark.createDataFrame([("m", "r", None, 0)], kind).withColumn("ts", F.lit("2026-01-02 10:00:00").cast("timestamp"))
    assert compare.base_run_asof(runs_df, runs_df.filter("false")).first().base_run is None


def test_best_checkpoint_tie_goes_to_the_earliest(spark):
    kind = "adapter string, candidate string, step int, avg_score double"
    final = spark.createDataFrame([("a", "a", None, 0.7)], kind)
    ckpts = spark.createDataFrame([("a", "a-ckpt100", 100, 0.7), ("a", "a-ckpt200", 200, None), ("a", "a-ckpt300", 300, 0.6)], kind)
    row = runs.best_checkpoint(runs.candidates(final, ckpts)).first()
    assert (row.candidate, row.n_scored, row.lead) == ("a", 3, 0.0)
    row = runs.best_checkpoint(runs.candidates(final.withColumn("avg_score", F.lit(0.5)), ckpts)).first()
    assert row.candidate == "a-ckpt100" and row.lead == pytest.approx(0.2)


def test_checkpoint_names(spark):
    df = spark.createDataFrame([(n, "a") for n in ("checkpoint-20", "checkpoint-3", "checkpoint-0", "checkpoint-x", "other-5")], "name string, adapter string")
    assert [(r.step, r.candidate) for r in runs.checkpoint_candidates(df).collect()] == [(3, "a-ckpt3"), (20, "a-ckpt20")]


def test_run_names(spark):
    row = spark.createDataFrame([("2026-01-02_1000_org_model_v1",)], "n string").select(parse_run_name(F.col("n")).alias("p")).first().p
    assert (row.timestamp, row.model) == ("2026-01-02_1000", "org_model_v1")
    meta = spark.range(1).select(run_meta(F.lit("m"), F.lit("m"), F.lit("/d/holdout.v2.jsonl"), F.lit("/l")).alias("m")).first().m
    assert (meta.eval_set, meta.lora_path) == ("holdout.v2", "/l")


RESPONSES = [
    ('{"score": 0.8, "reason": "ok"}', None, 0.8, "ok"),
    ('```json\n{"score": 0.8, "reason": "ok"}\n```', None, 0.8, "ok"),
    ('{"score": "0.8"}', None, 0.8, ""),
    ('{"reason": "x"}', None, 0.0, 'parse_error: {"reason": "x"}'),
    ("not json", None, 0.0, "parse_error: not json"),
    ('{"score": "high"}', None, 0.0, 'parse_error: {"score": "high"}'),
    ('{"score": [1]}', None, 0.0, 'parse_error: {"score": [1]}'),
    ("[1]", None, 0.0, "parse_error: [1]"),
    ('{"score": 1.7, "reason": "not clamped"}', None, 1.7, "not clamped"),
    ('{"score": true}', None, 1.0, ""),
    ("x" * 100, None, 0.0, "parse_error: " + "x" * 80),
    (None, "Timeout", 0.0, "api_error: Timeout"),
    ('{"score": 1}', None, 1.0, ""),
]


def test_parse_judgement(spark):
    df = spark.createDataFrame([(i, r, f) for i, (r, f, *_) in enumerate(RESPONSES)], "i int, r string, f string")
    got = df.select("i", judge.parse_judgement(F.col("r"), F.col("f")).alias("j")).orderBy("i").collect()
    assert [(g.j.judge_raw, g.j.judge_reason) for g in got] == [(s, r) for *_, s, r in RESPONSES]


def test_empty_and_failed_rows_are_not_judged(spark):
    res = scored(spark)
    assert [r.rec_id for r in judge.judge_requests(res).collect()] == [0]
    verdicts = spark.createDataFrame([("r", 0, 0.65, "fine")], "run_id string, rec_id bigint, judge_raw double, judge_reason string")
    out = judge.attach_judgements(res, verdicts)
    rows = {r.rec_id: r for r in out.collect()}
    assert (rows[0].judge_score, rows[0].judge_band) == (0.65, "GOOD")
    assert {rows[i].judge_reason for i in range(1, 6)} == {"error_or_empty"}
    # Failed rows count in the judge average, unlike in the similarity average.
    assert judge.judge_summary(out).first().judge_avg == 0.1083


def test_boost_priorities(spark):
    tags = spark.createDataFrame(
        [("r", "c", 0.49, 10), ("r", "h", 0.29, 9), ("r", "m", 0.49, 9), ("r", "l", 0.55, 50), ("r", "g", 0.6, 5), ("r", "e", 0.8, 5)],
        "run_id string, convention string, avg double, n bigint",
    )
    boost = status.order_boost(status.boost_tags(tags)).collect()
    assert [(b.name, b.priority) for b in boost] == [("c", "critical"), ("h", "high"), ("m", "medium"), ("l", "low")]
    assert {(s.name, s.reason) for s in status.skip_tags(tags).collect()} == {("g", "GOOD"), ("e", "EXCELLENT")}


def status_inputs(spark):
    res = scored(spark)
    link = spark.createDataFrame(
        [("r", "/d/holdout.jsonl", "m", None, None)], "run_id string, holdout_file string, manifest string, previous_run string, base_run string"
    )
    tags = spark.createDataFrame([("m", "a"), ("m", "z"), ("other", "q")], "manifest string, tag string")
    meta = spark.createDataFrame([("m", 7)], "manifest string, cycle int")
    return res, link, tags, meta


def test_status_document(spark, tmp_path):
    parts = status.status_parts(*status_inputs(spark))
    sinks.write_status(parts, str(tmp_path), "2026-01-02T10:00:00Z")
    sinks.write_documents(sinks.status_documents(parts, ["r"], "2026-01-02T10:00:00Z"), str(tmp_path / "documents"))
    (path,) = (tmp_path / "documents").glob("run_id=r/*.json")
    doc = json.loads(path.read_text())
    assert doc["meta"] == {"generated_at": "2026-01-02T10:00:00Z", "eval_set": "holdout", "cycle": 7, "action": "GENERATE_DATA", "source_eval": "r.json"}
    assert doc["scores"] == {"avg_similarity": 0.5, "excellent": 1, "good": 0, "partial": 0, "poor": 1, "total": 6}
    assert [b["name"] for b in doc["boost_conventions"]] == ["b", "a"]
    assert doc["uncovered_conventions"] == [{"name": "z"}]
    assert doc["skip_conventions"] == [] and doc["format_health"]["boilerplate_cases"] == []
    # Tag b is high but only failed rows carry it, and still has its (empty) list.
    assert doc["seed_candidates"] == {"b": []}
    sections = {json.loads(x)["section"] for f in (tmp_path / "rows").glob("*.json") for x in f.read_text().splitlines()}
    assert sections == {"summary", "boost", "seed", "uncovered"}
    assert [r.asDict() for r in spark.read.json(str(tmp_path / "meta")).collect()] == [{"run_id": "r", **doc["meta"]}]


def test_large_runs_come_back_whole(spark, tmp_path):
    n = 20_000
    one = scored(spark).filter("ord = 0").drop("ord", "rec_id").withColumn("model", F.lit("m"))
    res = one.crossJoin(spark.range(n).select(F.col("id").alias("rec_id"), F.col("id").alias("ord"))).select(*scored(spark).columns, "model")
    meta = spark.createDataFrame([("r", "m", "http://host", "/d/h.jsonl", "lora")], "run_id string, model string, base_url string, holdout_file string, lora_path string")
    sinks.write_run(res, agg.run_summary(res), str(tmp_path), meta)
    back = readers.read_run_tables(spark, str(tmp_path))
    assert back["run_results"].count() == n == back["run_tag_scores"].filter("convention = 'a'").count()
    row = back["runs"].first()
    assert (row.base_url, row.holdout_file, row.lora_path, row.total) == ("http://host", "/d/h.jsonl", "lora", n)
    assert {(r.convention, r.n) for r in back["run_tags"].collect()} >= {("a", n)}


def test_run_documents_round_trip(spark, tmp_path):
    res = scored(spark).withColumn("model", F.lit("m"))
    meta = spark.createDataFrame([("r", "m", "b", "/d/h.jsonl")], "run_id string, model string, base_model string, holdout_file string")
    sinks.write_documents(sinks.run_documents(res, meta, ["r"]), str(tmp_path / "documents"))
    docs = readers.read_runs(spark, str(tmp_path / "documents"), "fail", readers.RUN_FOLDER_GLOB)
    row = docs.first()
    assert row.run_id == "r" and row.meta.model == "m" and row.meta.n_records == 6
    assert row.summary.band_counts == {"EXCELLENT": 1, "POOR": 1, "ERROR": 4}
    assert [(t.convention, t.scores) for t in row.summary.convention_breakdown] == [("b", [0.0] * 3), ("a", [1.0, 0.0, 0.0])]
    assert [r.error for r in row.results] == [None, None, "no assistant turn", "no user turn", "timeout", "no prediction"]
    assert sinks.run_documents(res, meta, ["other"]).count() == 0


def test_judged_documents(spark, tmp_path):
    res = scored(spark).withColumn("model", F.lit("m"))
    verdicts = spark.createDataFrame([("r", 0, 0.65, "fine")], "run_id string, rec_id bigint, judge_raw double, judge_reason string")
    meta = spark.createDataFrame([("r", "m", "j")], "run_id string, model string, judge_model string")
    judged = judge.attach_judgements(res, verdicts)
    sinks.write_judged(judged, str(tmp_path / "tables"), meta)
    back = readers.read_run_tables(spark, str(tmp_path / "tables"), "judged_")
    assert back["runs"].first().judge_model == "j" and back["run_results"].count() == 6
    sinks.write_documents(sinks.judged_documents(judged, meta, ["r"]), str(tmp_path / "documents"))
    row = readers.read_runs(spark, str(tmp_path / "documents"), "fail", readers.RUN_FOLDER_GLOB).first()
    assert row.run_kind == "judged"
    assert (row.summary.avg_score, row.similarity_summary.avg_score) == (0.1083, 0.5)
    assert row.summary.band_counts == {"GOOD": 1, "POOR": 5}
    assert row.results[0].judge_reason == "fine" and row.results[0].score == 1.0


def test_read_runs_unreadable(spark, tmp_path):
    (tmp_path / "2026-01-02_1000_m.json").write_text(json.dumps({"meta": {"model": "m"}, "summary": {"avg_score": 0.5}, "results": []}, indent=2))
    (tmp_path / "2026-01-02_1100_m.json").write_text("{broken")
    assert [r.run_id for r in readers.read_runs(spark, str(tmp_path)).collect()] == ["2026-01-02_1000_m"]
    with pytest.raises(FAILED):
        readers.read_runs(spark, str(tmp_path), on_error="fail").collect()


def test_manifest(spark, tmp_path):
    doc = {
        "meta": {"cycle": 3, "max_steps": "soon"},
        "patterns": [{"tags": ["a"]}, {"tags": None}],
        "training": {"contrast_patterns": [{"tags": ["b", "a"]}], "patterns": [{"tags": ["c"]}]},
    }
    (tmp_path / "manifest.json").write_text(json.dumps(doc, indent=1))
    df = readers.read_manifest(spark, str(tmp_path / "manifest.json"))
    row = df.first()
    assert (row.cycle, row.max_steps, row.max_steps_ignored) == (3, None, "soon")
    assert {r.tag for r in status.manifest_tags(df).collect()} == {"a", "b", "c"}
    missing = readers.read_manifest(spark, str(tmp_path / "none.json"))
    assert missing.count() == 0 and status.manifest_tags(missing).count() == 0


def test_cycle_report_without_base_or_previous(spark):
    res = scored(spark)
    none = res.filter("false")
    rows = {(r.section, r.key): r.value for r in report.cycle_report(res, none, none).collect()}
    assert rows["summary", "diagnosis"] == "working" and ("summary", "verdict") not in rows
