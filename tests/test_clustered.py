from pathlib import Path

from pyspark.sql import functions as F

from gradeloom import schemas
from gradeloom.operators.aggregate import run_summary
from gradeloom.sources import readers, sinks


def files(path):
    return list(Path(path).rglob("*.parquet"))


def test_many_runs_lie_in_few_files(spark, tmp_path):
    rows = spark.range(600).select(
        F.concat(F.lit("run"), F.floor(F.col("id") / 10).cast("string")).alias("run_id"), F.concat(F.lit("m"), (F.floor(F.col("id") / 10) % 2).cast("string")).alias("model"),
        (F.col("id") % 10).alias("rec_id"), (F.col("id") % 10).alias("ord"), F.lit(5_000).cast("bigint").alias("score_bp"), F.lit(0.5).alias("score"), F.lit("PARTIAL").alias("band"),
        F.array(F.lit("t")).alias("conventions_tested"),
    )
    rest = [f for f in schemas.RUN_RESULTS.fields if f.name not in rows.columns]
    rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in rest})
    by_run, by_model = f"{tmp_path}/a", f"{tmp_path}/b"
    sinks.write_run(rows, run_summary(rows), by_run, rows.select("run_id", "model").distinct())
    sinks.cluster_runs(spark, by_run, by_model)
    assert len(files(f"{by_run}/run_results")) >= 60 and len(files(f"{by_model}/run_results")) <= 20
    for name, table in readers.read_run_tables(spark, by_run).items():
        again = readers.read_run_tables(spark, by_model)[name]
        assert sorted(map(str, again.select(*table.columns).collect())) == sorted(map(str, table.collect()))
    one = readers.read_results(spark, by_model, model="m1", run_id="run7")
    assert one.count() == 10 and {r.run_id for r in one.collect()} == {"run7"}
    text = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(run_id,run7)" in text and "PartitionFilters: [isnotnull(model" in text
    assert one.select("_metadata.file_path").distinct().count() == 1
