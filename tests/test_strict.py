from pathlib import Path

import pytest
from conftest import FAILED
from pyspark.sql import functions as F

from gradeloom.functions.jsontext import whole_json
from gradeloom.operators import judge, prepare, validate
from gradeloom.operators.validate import with_ordinal
from gradeloom.plans import skew
from gradeloom.session import scratch_path, scratch_scope
from gradeloom.sources import readers
from gradeloom.sources.readers import read_lines
from gradeloom.streaming import alerts


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ('{"a": 1}', "OBJECT"), ("[1, 2]", "ARRAY"), ("3", "BIGINT"), ('"x"', "STRING"), ("null", "VOID"), (' {"a": 1} ', "OBJECT"),
        ('{"a": 1} trailing', None), ('{"a": 1}{"a": 2}', None), ('{"a": 1} {"a": 2}', None), ('{"a": 1},{"a": 2}', None), ('{"a": 1}] junk', None),
        ("", None), ("{", None), ("prose", None), (None, None),
    ],
)
def test_whole_json(spark, text, kind):
    df = spark.createDataFrame([(text,)], "t string").select(F.schema_of_variant(whole_json(F.col("t"))).alias("k"))
    found = df.first().k
    assert (found is None) == (kind is None) and (kind is None or found.startswith(kind))


def test_judge_response_with_prose_is_not_parsed(spark):
    texts = ['{"score": 0.8, "reason": "ok"}', '{"score": 0.8, "reason": "ok"} trailing prose', '{"score": 0.1}{"score": 0.9}']
    df = spark.createDataFrame([(t,) for t in texts], "response string")
    got = [r.j.judge_raw for r in df.select(judge.parse_judgement(F.col("response")).alias("j")).collect()]
    assert got == [0.8, 0.0, 0.0]


def test_validation_sees_text_after_the_record(spark):
    good = '{"conversations": [{"from": "human", "value": "x"}]}'
    lines = spark.createDataFrame([(good, 1, 1), (good + " junk", 2, 2), (good + good, 3, 3)], "value string, line_no bigint, record_no bigint")
    assert sorted((r.line_no, r.reason) for r in validate.validate_sharegpt(lines).collect()) == [(2, "not valid JSON"), (3, "not valid JSON")]


BAD_EXAMPLES = ['{"question": "q", "api_call": {}} junk', "[1]", '{"question": "q"}', '{"api_call": {}}', '{"question": "q", "api_call": {}}{"question": "r", "api_call": {}}']


@pytest.mark.parametrize("bad", BAD_EXAMPLES)
def test_examples(spark, tmp_path, bad):
    (tmp_path / "items").mkdir()
    (tmp_path / "items" / "training.jsonl").write_text('{"question": "a", "api_call": {"endpoint": "GET /x"}}\n\n' + bad + "\n")
    with pytest.raises(FAILED):
        readers.read_examples(spark, str(tmp_path)).collect()
    rows = readers.read_examples(spark, str(tmp_path), mode="quarantine").collect()
    assert sorted((r.question or "", r.malformed or "") for r in rows) == sorted([("a", ""), ("", bad)])
    good = readers.read_examples(spark, str(tmp_path), mode="quarantine").filter("malformed IS NULL")
    turns = prepare.to_sharegpt(good, "system").first().conversations
    assert all(t["value"] is not None for t in turns)


def test_other_readers_reject_trailing_text(spark, tmp_path):
    for name, line, reader in (
        ("chat", '{"conversations": []}', readers.read_sharegpt), ("holdout", '{"messages": []}', readers.read_holdout),
        ("answers", '{"run_id": "r", "rec_id": 1, "generated": "x"}', readers.read_predictions),
        ("judge", '{"run_id": "r", "rec_id": 1, "response": "{}"}', readers.read_judge_responses),
    ):
        path = tmp_path / f"{name}.jsonl"
        path.write_text(line + "\n")
        assert reader(spark, str(path)).count() == 1
        path = tmp_path / f"{name}-bad.jsonl"
        path.write_text(line + " more\n")
        with pytest.raises(FAILED):
            reader(spark, str(path)).collect()


def test_predictions_carry_their_run(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"run_id": "runA", "rec_id": 4, "generated": null, "error": "timeout"}\n')
    row = readers.read_predictions(spark, str(tmp_path / "p.jsonl")).first()
    assert (row.run_id, row.rec_id, row.generated, row.error) == ("runA", 4, None, "timeout")


def test_alerts_take_text_run_ids(spark, tmp_path):
    schema = "run string, ord bigint, epoch double, loss double"
    spark.createDataFrame([("runA", 1, 0.1, 9.0), ("runA", 2, 0.5, 1.6), ("runB", 1, 0.5, 1.0)], schema).write.parquet(str(tmp_path / "points"))
    points = spark.readStream.schema(schema).parquet(str(tmp_path / "points"))
    query = alerts.early_warning_stream(points).writeStream.format("memory").queryName("text_runs").trigger(availableNow=True)
    query.option("checkpointLocation", str(tmp_path / "state")).start().awaitTermination(120)
    assert [tuple(r) for r in spark.table("text_runs").collect()] == [("runA", 2, 0.5, 1.6)]
    assert dict(alerts.timer_alerts(points.select("run", "ord"), silence=1).dtypes)["run"] == "string"


def test_stored_tables_go_with_their_scope(spark):
    folder = lambda path: Path(path.removeprefix("file:"))
    with scratch_scope(spark) as outer:
        skew.materialize(spark.range(3), "kept")
        with scratch_scope(spark) as inner:
            table = skew.materialize(spark.range(5), "inner")
            assert table.count() == 5 and inner.startswith(outer) and list(folder(inner).iterdir())
        assert not folder(inner).exists() and len(list(folder(outer).iterdir())) == 1
    assert not folder(outer).exists() and "scope" not in scratch_path(spark, "after")


def test_numbers_do_not_follow_the_settings(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text("".join(f"line {i}\n\n" for i in range(3_000)))
    before = dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.files.minPartitionNum", None)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        numbered = with_ordinal(read_lines(spark, str(tmp_path / "t.jsonl")))
        # Between the two passes the cut of the file changes.
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        rows = numbered.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len({r.block_start for r in rows}) > 5
    assert sorted((r.value, r.line_no, r.record_no) for r in rows) == sorted((f"line {i}", 2 * i + 1, i + 1) for i in range(3_000))
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) == before[1]
