from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gradeloom.functions import metrics
from gradeloom.operators import scoring

TEXT = st.text(alphabet="ab é∎\t", max_size=12)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def ratio(a, b, least):
    a, b = a.strip(), b.strip()
    longer = max(len(a), len(b))
    got = 1.0 if longer == 0 else 1 - distance(a, b) / longer
    return got if got >= least - 1e-12 else 0.0


def dice(a, b):
    a, b = Counter(a.split()), Counter(b.split())
    total = sum(a.values()) + sum(b.values())
    return 1.0 if total == 0 else 2 * sum((a & b).values()) / total


@pytest.mark.parametrize("least", [0.0, 0.4, 0.75, 1.0])
@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs=st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=60))
def test_edit_ratio_equals_brute_force(spark, least, pairs):
    pairs = [*pairs, ("", ""), (" ", ""), ("", "x"), ("ab", "ba"), ("tide", "diet"), ("éé", "e")]
    df = spark.createDataFrame(list(enumerate(pairs)), "k long, p struct<a:string,b:string>")
    got = df.select("k", metrics.levenshtein_ratio(F.col("p.a"), F.col("p.b"), least).alias("r")).collect()
    assert all(abs(r.r - ratio(*pairs[r.k], least)) < 1e-12 for r in got) and len(got) == len(pairs)


def test_edit_ratio_of_null(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None)], "a string, b string")
    assert [r.r for r in df.select(metrics.levenshtein_ratio(F.col("a"), F.col("b")).alias("r")).collect()] == [None, None]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs=st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=60))
def test_dice_equals_brute_force(spark, pairs):
    pairs = [*pairs, ("", ""), ("a a b", "a b b"), ("", "x"), ("x", " ")]
    rows = [("r", i, a, b) for i, (a, b) in enumerate(pairs)] + [("r", 10_000, None, "x"), ("r", 10_001, "x", None)]
    df = spark.createDataFrame(rows, "run_id string, rec_id long, expected string, generated string")
    got = {r.rec_id: r.raw for r in metrics.token_bag_dice(df, ["run_id", "rec_id"]).collect()}
    assert set(got) == set(range(len(pairs)))
    assert all(abs(got[i] - dice(*p)) < 1e-12 for i, p in enumerate(pairs))


def test_dice_runs_in_the_jvm(spark):
    df = spark.createDataFrame([("r", 1, "a", "b")], "run_id string, rec_id long, expected string, generated string")
    text = metrics.token_bag_dice(df, ["run_id", "rec_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and text.index("Exchange") < text.index("partial_count_if" if "partial_count_if" in text else "partial")


def test_scoring_by_any_metric(spark):
    rows = [("r", 1, "c d", "c d", None), ("r", 2, "c d", "c x", None), ("r", 3, "c", "", "timeout")]
    df = spark.createDataFrame(rows, "run_id string, rec_id long, expected string, generated string, error string")
    df = df.withColumns({"prompt": F.lit("p"), "source_file": F.lit("s")})
    metrics.register_metric("same_length", lambda a, b: (F.length(a) == F.length(b)).cast("double"))
    for by, want in (("token_bag_dice", [1.0, 0.5, 0.0]), ("levenshtein_ratio", [1.0, 0.6667, 0.0]), ("same_length", [1.0, 1.0, 0.0])):
        got = scoring.score_results(df, by=by).orderBy("rec_id").collect()
        assert [r.score for r in got] == want and got[2].band == "ERROR"
