import sys
from pathlib import Path

import pytest
from conftest import SF

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import check_oracle
import duckdb

import __spark_entry__ as entry_point
from gradeloom.plans import catalog

QUICK = (
    "weak_tags", "score_results", "stratified_split", "to_sharegpt", "base_run_asof", "previous_run", "silence_gaps",
    "best_checkpoint", "validate_sharegpt", "parse_judgement", "early_warning_stream", "format_health",
)
ROWS_ONLY = {"similarity_turns"}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in check_oracle.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_its_sql():
    # Those of the optional subpackage are checked by its own tests.
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == ROWS_ONLY
    assert set(catalog.QUERIES) <= set(entry_point.queries()) and set(catalog.ORACLES) <= set(entry_point.oracle_sql())


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["run_id", "convention", "avg", "n", "band"] and df.count() > 0


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, con, name):
    ok, note = check_oracle.compare(spark, con, name, entry_point.queries()[name], entry_point.oracle_sql()[name], SF)
    assert ok, note


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_on_a_score_does_not_score_twice(spark):
    assert plan(entry_point.queries()["failing_examples"](spark, SF)).count("ArrowEvalPython") == 1


def test_filter_on_a_verdict_does_not_parse_twice(spark):
    assert plan(entry_point.queries()["validate_sharegpt"](spark, SF)).count("parseJson") == 1


@pytest.mark.parametrize("name", ["read_examples", "write_sharegpt"])
def test_readers_parse_once(spark, name):
    assert plan(entry_point.queries()[name](spark, SF)).count("parseJson") == 1


def test_ranks_are_limited_before_the_shuffle(spark):
    text = plan(entry_point.queries()["last_wins"](spark, SF))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_scans_read_only_what_they_need(spark):
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan(
        entry_point.queries()["wall_overruns"](spark, SF)
    )


@pytest.mark.parametrize("name", ["cycle_report", "compare_to_base", "uncovered_tags", "base_run_asof", "examples_for_tags"])
def test_no_cross_joins(spark, name):
    text = plan(entry_point.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_no_sort_below_an_aggregate(spark):
    assert "rangepartitioning" not in plan(entry_point.queries()["best_checkpoint"](spark, SF))


@pytest.mark.parametrize("name", ["next_steps", "prompt_baseline_report", "cycle_report", "examples_for_tags"])
def test_stored_scores_carry_no_texts(spark, name):
    assert "generated" not in plan(entry_point.queries()[name](spark, SF))
