import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gradeloom.operators import compare
from gradeloom.plans import suffix


@pytest.mark.parametrize(("bits", "n", "width"), [(12, 200, 10**6), (2, 200, 10**6), (1, 60, 40), (3, 0, 5)])
def test_suffix_minimum_equals_brute_force(spark, bits, n, width):
    rnd = random.Random(n)
    points = {(rnd.choice("ab"), rnd.randrange(-width, width)): rnd.choice([None, rnd.randrange(100)]) for _ in range(n)}
    df = spark.createDataFrame([(g, a, v, "kept") for (g, a), v in points.items()], "g string, t bigint, v int, node string")
    rows = suffix.suffix_minimum(df, "g", "t", F.col("v"), "least", bits).collect()
    assert len(rows) == len(points) and all(r.node == "kept" for r in rows)
    for r in rows:
        rest = [v for (g, a), v in points.items() if g == r.g and a >= r.t and v is not None]
        assert r.least == min(rest, default=None)


def asof(runs, bases):
    out = {}
    for model, run, ts, _ in runs:
        mine = [b for b in bases if b[0] == model and model is not None]
        later = [b for b in mine if ts is not None and b[2] is not None and b[2] >= ts]
        pick = min(later, key=lambda b: (b[3], b[1])) if later else max(mine, key=lambda b: (b[3], b[1])) if mine else None
        out[run] = (pick and pick[1], bool(later))
    return out


@pytest.mark.parametrize("seconds", [3, 10_000])
def test_base_runs_equal_brute_force(spark, monkeypatch, seconds):
    monkeypatch.setattr(suffix.suffix_minimum, "__defaults__", (2,))
    rnd = random.Random(seconds)
    at = lambda: rnd.choice([None, *[datetime(2026, 1, 2) + timedelta(seconds=rnd.randrange(seconds)) for _ in range(9)]])
    rows = [(rnd.choice(["m", "n", "lone", None]), f"r{i}", at(), rnd.randrange(50)) for i in range(300)]
    runs, bases = rows[:200], [r for r in rows[200:] if r[0] != "lone"]
    schema = "base_model string, run_id string, ts timestamp_ntz, mtime bigint"
    got = compare.base_run_asof(spark.createDataFrame(runs, schema), spark.createDataFrame(bases, schema)).collect()
    assert {r.run_id: (r.base_run, r.at_or_after) for r in got} == asof(runs, bases) and len(got) == len(runs)


def test_windows_hold_a_node_at_most(spark):
    """A hot hour: 60,000 times of one model, some with many runs."""
    base = spark.range(60_000).select(
        F.lit("m").alias("base_model"), F.col("id").alias("run_id"), F.timestamp_micros(F.lit(1_767_348_000_000_000) + F.col("id") * 59_999).alias("ts"), F.col("id").alias("mtime")
    )
    runs = base.unionByName(base.filter("run_id < 2000").withColumns({"ts": F.timestamp_micros(F.lit(1_767_348_000_000_007)), "run_id": F.col("run_id") + 100_000}))
    rows = compare.base_run_asof(runs, base)
    wrong = rows.filter(F.when(F.col("run_id") < 100_000, F.col("base_run") != F.col("run_id")).otherwise(F.col("base_run") != 1))
    assert rows.count() == 62_000 and wrong.count() == 0 and rows.filter("NOT at_or_after").count() == 0
