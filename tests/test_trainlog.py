import time

import pytest
from pyspark.sql import functions as F

from gradeloom.functions import rules
from gradeloom.functions.logs import parse_log_line, parse_loss
from gradeloom.operators import trainlog
from gradeloom.sources import readers
from gradeloom.streaming import alerts, losses
from gradeloom.streaming.sinks import drain

LINES = {
    "{'loss': 0.4231, 'grad_norm': 1.234, 'epoch': 0.45}": (0.45, 0.4231),
    "{'loss': '0.42', 'epoch': '1.0'}": (1.0, 0.42),
    "{'train_loss': 0.4}": None,
    "{'train_loss': 0.4, 'epoch': 1}": None,
    "{'loss': 0.4}": None,
    "{'loss': 1.2.3, 'epoch': 1}": None,
    "{'loss': 1e-3, 'epoch': 2}": (2.0, 0.001),
}


def test_loss_lines(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(LINES)], "i int, x string")
    got = [r.p and (r.p.epoch, r.p.loss) for r in df.select("i", parse_loss(F.col("x")).alias("p")).orderBy("i").collect()]
    assert got == list(LINES.values())


def test_log_line(spark):
    df = spark.createDataFrame([("[2026-01-02 10:00:00] [TRAIN]   {'loss': 0.42}",), ("other",)], "x string")
    rows = df.select(parse_log_line(F.col("x")).alias("p")).collect()
    assert (str(rows[0].p.ts), rows[0].p.level, rows[0].p.msg) == ("2026-01-02 10:00:00", "TRAIN", "  {'loss': 0.42}")
    assert rows[1].p is None


def points(spark, rows):
    return spark.createDataFrame([(1, i, e, x) for i, (e, x) in enumerate(rows)], "run bigint, ord bigint, epoch double, loss double")


def test_early_warning_is_strict_and_once(spark):
    df = points(spark, [(0.2, 9.0), (0.21, 1.5), (0.21, 1.51), (0.3, 5.0)])
    assert [(r.ord, r.loss) for r in trainlog.early_warning(df).collect()] == [(2, 1.51)]


def estimate(spark, first, last, n, steps):
    df = spark.createDataFrame([(first, last, n, steps)], "f double, l double, n bigint, s bigint")
    return df.select(rules.step_estimate(F.col("f"), F.col("l"), F.col("n"), F.col("s")).alias("e")).first().e


def test_step_estimate(spark):
    e = estimate(spark, 1.821, 0.934, 5, 300)
    assert (e.verdict, e.extra_steps, e.total_steps, e.suggested_steps) == ("estimate", 112, 412, 500)
    assert estimate(spark, 1.0, 0.6, 3, 300).verdict == "may be sufficient"
    assert estimate(spark, 0.5, 0.6, 3, 300).verdict == "did not decrease"
    assert estimate(spark, 1.0, 0.9, 2, 300) is None and estimate(spark, 1.0, 0.9, 3, None) is None


def test_loss_health_and_steps(spark):
    df = spark.createDataFrame([(1.01,), (1.0,), (0.15,), (0.14,)], "x double")
    assert [r.h for r in df.select(rules.loss_health(F.col("x")).alias("h")).collect()] == ["not converged", "ok", "ok", "overfit"]
    n = spark.createDataFrame([(2000, 8), (5, 8)], "n bigint, b bigint")
    assert [r.s for r in n.select(rules.auto_steps(F.col("n"), F.col("b")).alias("s")).collect()] == [1000, 4]
    row = spark.range(1).select(
        rules.resolve_steps(F.lit(700), F.lit(True), F.lit(650), F.lit(None).cast("int"), F.lit(2000)).alias("r")
    ).first().r
    assert (row.steps, row.step_source) == (300, "canary")


def test_silence_is_strict(spark):
    df = spark.createDataFrame(
        [(1, 0, "2026-01-01 00:00:00"), (1, 1, "2026-01-01 00:00:10"), (1, 2, "2026-01-01 00:00:20.5"), (1, 3, "2026-01-01 00:01:00"), (2, 4, "2026-01-01 05:00:00")],
        "run bigint, ord bigint, t string",
    ).withColumn("ts", F.col("t").cast("timestamp_ntz"))
    assert [(str(r.ts), r.gap_seconds) for r in trainlog.silence_gaps(df, 10).orderBy("ts").collect()] == [
        ("2026-01-01 00:00:20.500000", 10.5), ("2026-01-01 00:01:00", 39.5)
    ]
    assert [r.ord for r in trainlog.wall_overruns(df, 20).orderBy("ord").collect()] == [2, 3]


def write_batches(spark, tmp_path):
    """Five files of log lines in order; run 1 warns in the second file, run 2 in the fourth."""
    root = tmp_path / "log"
    root.mkdir()
    ord_ = 0
    for f in range(5):
        rows = []
        for i in range(20):
            run = 1 + i % 3
            loss = 2.0 if (run, f) in ((1, 1), (1, 3), (2, 3)) else 1.0
            rows.append(f"{run}|{ord_}|[2026-01-01 0{f}:00:{i:02d}] [TRAIN]   {{'loss': {loss}, 'epoch': 0.{3 + f}}}")
            ord_ += 1
        path = root / f"part-{f}.txt"
        path.write_text("\n".join(rows) + "\n")
        time.sleep(0.02)
    return str(root)


def split_line(df):
    parts = F.split("value", "\\|", 3)
    parsed = df.select(parts[0].cast("bigint").alias("run"), parts[1].cast("bigint").alias("ord"), parse_log_line(parts[2]).alias("p"))
    return parsed.select("run", "ord", "p.ts", F.col("p.msg").alias("line"))


def test_streams_equal_their_batch_twins(spark, tmp_path):
    root = write_batches(spark, tmp_path)
    stream = split_line(spark.readStream.option("maxFilesPerTrigger", 1).text(root))
    batch = split_line(spark.read.text(root))

    def rows(df):
        cols = sorted(df.columns)
        return sorted(tuple(r) for r in df.select(*cols).collect())

    assert rows(drain(losses.loss_stream(stream), "t1")) == rows(trainlog.loss_points(batch))
    warned = drain(alerts.early_warning_stream(losses.loss_stream(stream)), "t2")
    expected = rows(trainlog.early_warning(trainlog.loss_points(batch)))
    assert rows(warned) == expected and len(expected) == 2
    running = drain(losses.loss_summary_stream(losses.loss_stream(stream)), "t5", "update")
    assert rows(running) == rows(trainlog.loss_summary(trainlog.loss_points(batch)))
    over = drain(alerts.wall_overrun_runs(stream, 3600), "t4", "update")
    assert rows(over) == rows(alerts.wall_overrun_runs(batch, 3600)) and over.count() == 3
    closed = rows(drain(alerts.silence_sessions(stream, 600), "t3"))
    every = rows(alerts.silence_sessions(batch, 600))
    assert set(closed) < set(every) and len(closed) == 12 and len(every) == 15


def test_timer_alerts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("1|0\n1|1\n")
    parts = F.split("value", "\\|")
    lines = spark.readStream.text(str(tmp_path / "in")).select(parts[0].cast("bigint").alias("run"), parts[1].cast("bigint").alias("ord"))
    handle = (
        alerts.timer_alerts(lines, silence=2, wall=4).writeStream.outputMode("append").format("memory").queryName("timers")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="1 second").start()
    )
    try:
        for _ in range(60):
            time.sleep(0.5)
            kinds = {r.kind for r in spark.table("timers").collect()}
            if kinds == {"silence", "wall"}:
                break
    finally:
        handle.stop()
    rows = spark.table("timers").collect()
    assert sorted(r.kind for r in rows) == ["silence", "wall"]
    assert all(r.seconds > (2 if r.kind == "silence" else 4) for r in rows)


def test_read_log_stream_and_batch(spark, tmp_path):
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "run.log").write_text("[2026-01-02 10:00:00] [INFO] start\nplain\n")
    batch = sorted((str(r.ts), r.level, r.msg) for r in readers.read_log(spark, str(tmp_path / "l")).collect())
    stream = drain(readers.read_log(spark, str(tmp_path / "l"), streaming=True), "log")
    assert sorted((str(r.ts), r.level, r.msg) for r in stream.collect()) == batch
    assert batch == [("2026-01-02 10:00:00", "INFO", "start"), ("None", None, "plain")]
