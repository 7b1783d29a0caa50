import os
import random
import subprocess
import sys
import time
from datetime import datetime, timedelta

import pytest
from conftest import FAILED
from pyspark import cloudpickle
from pyspark.sql import functions as F

from gradeloom.operators import trainlog
from gradeloom.plans import queries_streaming
from gradeloom.plans.catalog import QUERIES
from gradeloom.plans.queries_trainlog import WALL
from gradeloom.sources import readers
from gradeloom.streaming import ingest, losses, watch
from gradeloom.streaming.sinks import ROCKSDB, STATE_STORE, drain, rocksdb_state

START = datetime(2026, 1, 2, 10)


def ms(seconds):
    return int((START + timedelta(seconds=seconds) - datetime(1970, 1, 1)).total_seconds() * 1000)


def history(spark, folder, batches):
    """A stream with one file per batch of ``(run, seconds, event)``."""
    for i, rows in enumerate(batches):
        data = [(r, START + timedelta(seconds=s), e) for r, s, e in rows]
        spark.createDataFrame(data, "run string, ts timestamp_ntz, event string").coalesce(1).write.parquet(f"{folder}/{i}")
        time.sleep(0.01)
    schema = "run string, ts timestamp_ntz, event string"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def brute_force(rows, silence, wall, launches=()):
    """Alerts of a replay whose clock ends with the newest line."""
    end = max(s for _, s, _ in rows)
    out = []
    for run in {r for r, *_ in rows} | {r for r, _ in launches}:
        spells, spell = [], [s for r, s in launches if r == run]
        for _, s, e in sorted((x for x in rows if x[0] == run), key=lambda x: (x[1], x[2] == "end")):
            spell.append(s)
            if e == "end":
                spells.append((spell, s))
                spell = []
        spells.append((spell, end))
        for times, until in spells:
            if not times:
                continue
            times = sorted(times)
            if wall and until - times[0] > wall:
                out.append((run, "wall", ms(times[0] + wall)))
            if silence:
                out += [(run, "silence", ms(a + silence)) for a, b in zip(times, [*times[1:], until], strict=True) if b - a > silence]
    return sorted(out)


@pytest.mark.parametrize("files", [1, 4])
def test_replays_equal_brute_force(spark, tmp_path, files):
    rnd = random.Random(files)
    rows = [(f"r{rnd.randrange(6)}", rnd.randrange(0, 3_000), "line") for _ in range(60)]
    rows += [("late launch", 900, "launch"), ("ended", 5, "launch"), ("ended", 40, "line"), ("ended", 50, "end"), ("again", 10, "line"), ("again", 60, "end"), ("again", 2_000, "launch")]
    rows.sort(key=lambda r: r[1])
    size = -(-len(rows) // files)
    stream = history(spark, str(tmp_path / "in"), [rows[i : i + size] for i in range(0, len(rows), size)] + [[("clock", 3_500, "line")]])
    launches = [("never wrote", 100), ("r1", 20)]
    table = spark.createDataFrame([(r, START + timedelta(seconds=s)) for r, s in launches], "run string, ts timestamp_ntz")
    out = drain(watch.watch_runs(stream, silence=200, wall=1_500, launches=table, event_time=True), "replay")
    got = sorted(tuple(r) for r in out.collect())
    want = brute_force([*rows, ("clock", 3_500, "line")], 200, 1_500, launches)
    assert got == want
    assert ("never wrote", "silence", ms(300)) in got and ("late launch", "silence", ms(1_100)) in got and not any(r[0] == "ended" for r in got)


def states(query):
    return query.lastProgress["stateOperators"][0]


def test_ended_and_forgotten_runs_hold_no_state(spark, tmp_path):
    batches = [[(f"r{i}", i, "line") for i in range(40)], [(f"r{i}", 100, "end") for i in range(20)], [("clock", 9_000, "line")], [("clock", 9_001, "line")]]
    stream = history(spark, str(tmp_path / "in"), batches)
    writer = watch.watch_runs(stream, silence=30, event_time=True, keep_hours=1).writeStream.format("parquet")
    query = writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"))
    query.awaitTermination()
    rows = [s["stateOperators"][0]["customMetrics"] for s in query.recentProgress if s["stateOperators"]]
    assert rows
    left = spark.read.format("statestore").option("stateVarName", "run").load(str(tmp_path / "cp")).collect()
    assert [r.key.run for r in left] == ["clock"]


def test_a_warned_run_is_forgotten(spark, tmp_path):
    def add(i):
        spark.createDataFrame([("r", i, 0.5, 2.0 + i)], "run string, ord bigint, epoch double, loss double").write.parquet(str(tmp_path / "in" / str(i)))

    def run(name, keep_hours):
        points = spark.readStream.schema("run string, ord bigint, epoch double, loss double").parquet(f"{tmp_path}/in/*")
        writer = watch.early_warnings(points, keep_hours=keep_hours).writeStream.format("parquet")
        writer.option("checkpointLocation", f"{tmp_path}/{name}-cp").trigger(once=True).start(f"{tmp_path}/{name}").awaitTermination()
        return sorted(r.ord for r in spark.read.parquet(f"{tmp_path}/{name}").collect())

    add(0)
    assert run("short", 1 / 3_600) == [0] and run("long", 10) == [0]
    add(1)
    time.sleep(1.5)
    assert run("short", 1 / 3_600) == [0, 1] and run("long", 10) == [0]


def test_silence_on_the_clock_of_the_service(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = history(spark, str(tmp_path / "in"), [[("writes", 0, "line")]])
    launched = spark.createDataFrame([("never wrote", START)], "run string, ts timestamp_ntz")
    writer = watch.watch_runs(stream, silence=2, launches=launched).writeStream.format("parquet")
    query = writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="1 second").start(str(tmp_path / "out"))
    runs = set()
    try:
        for _ in range(60):
            time.sleep(0.5)
            if (tmp_path / "out" / "_spark_metadata").exists():
                runs = {r.run for r in spark.read.schema("run string, kind string, at_ms bigint").parquet(str(tmp_path / "out")).collect()}
            if len(runs) == 2:
                break
    finally:
        query.stop()
    assert runs == {"writes", "never wrote"}


HDFS_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


@pytest.mark.parametrize("name", ["early_warnings", "silence_timers", "wall_timers", "silence_from_launch"])
def test_timers_run_whatever_state_store_the_session_names(spark, tmp_path, name):
    at = [datetime(2024, 1, 1) + timedelta(days=3 * i) for i in range(4)]
    events = [(i, t, 7, "click", 5.0, "{}") for i, t in enumerate(at, 21)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(9,)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    named = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, HDFS_STORE)
    try:
        got = sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).collect()))
        assert spark.conf.get(STATE_STORE) == HDFS_STORE
    finally:
        spark.conf.set(STATE_STORE, named)
    epoch, six = datetime(1970, 1, 1), 6 * 3_600_000
    day = [int((t - epoch).total_seconds() * 1000) for t in at]
    launched = day[0] - 43_200_000
    silent = [(7, "silence", d + six) for d in day[:-1]]
    assert got == sorted({
        "early_warnings": [(7, 21, 0.21, 5.0)],
        "silence_timers": silent,
        "wall_timers": [(7, "wall", day[0] + WALL * 1000)],
        "silence_from_launch": [*silent, (9, "silence", launched + six)],
    }[name])


LONG = 2**53 + 1


def write_events(spark, folder, rows):
    """The events and customer tables of ``(event_id, ts, user_id)``; every event is a late point."""
    data = [(i, t, run, "click", 5.0, "{}") for i, t, run in rows]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/events.parquet")
    spark.createDataFrame([(9,), (None,)], "c_custkey long").coalesce(1).write.parquet(f"{folder}/customer.parquet")


@pytest.mark.parametrize("name", ["early_warnings", "early_warning_stream"])
def test_long_run_ids_are_whole_beside_a_run_without_one(spark, tmp_path, name):
    write_events(spark, tmp_path, [(122, START, LONG), (121, START, LONG), (123, START, None), (124, START, None)])
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        got = {tuple(r) for r in QUERIES[name](spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert got == {(LONG, 121, 0.21, 5.0), (None, 123, 0.23, 5.0)}


@pytest.mark.parametrize("first", [START, datetime(1969, 11, 3, 4, 0, 0, 500)])
def test_replays_have_lines_without_a_run_and_of_any_year(spark, tmp_path, first):
    at = [first + timedelta(days=d) for d in (0, 1, 9, 20)]
    write_events(spark, tmp_path, [(1, at[0], LONG), (2, at[1], None), (3, at[2], LONG), (4, at[3], None)])
    a, b, c, _ = (int((t - datetime(1970, 1, 1)) / timedelta(milliseconds=1)) for t in at)
    six = 6 * 3_600_000
    silent = {(LONG, "silence", a + six), (LONG, "silence", c + six), (None, "silence", b + six)}
    assert {tuple(r) for r in QUERIES["silence_timers"](spark, str(tmp_path)).collect()} == silent
    assert {tuple(r) for r in QUERIES["wall_timers"](spark, str(tmp_path)).collect()} == {(LONG, "wall", a + WALL * 1000), (None, "wall", b + WALL * 1000)}


def test_runs_launched_without_an_id_are_one_run(spark, tmp_path):
    day = datetime(2024, 1, 1)
    write_events(spark, tmp_path, [(1, day, 7), (2, day + timedelta(days=1), 7)])
    launched, lines = (int((t - datetime(1970, 1, 1)) / timedelta(milliseconds=1)) for t in (datetime(2023, 12, 31, 12), day))
    six = 6 * 3_600_000
    want = {(7, "silence", lines + six), (9, "silence", launched + six), (None, "silence", launched + six)}
    assert {tuple(r) for r in QUERIES["silence_from_launch"](spark, str(tmp_path)).collect()} == want


def test_the_state_store_stays_while_another_query_needs_it(spark):
    named = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, HDFS_STORE)
    try:
        first, second = rocksdb_state(spark), rocksdb_state(spark)
        first.__enter__()
        second.__enter__()
        first.__exit__(None, None, None)
        assert spark.conf.get(STATE_STORE) == ROCKSDB
        second.__exit__(None, None, None)
        assert spark.conf.get(STATE_STORE) == HDFS_STORE
    finally:
        spark.conf.set(STATE_STORE, named)


def test_processors_load_where_the_package_is_missing(tmp_path):
    for processor in (watch._Watch(1, 2, 3, True), watch._WarnOnce(1)):
        (tmp_path / "processor").write_bytes(cloudpickle.dumps(processor))
        load = "import sys, pyspark.cloudpickle as c; print(type(c.loads(open('processor', 'rb').read())).__name__)"
        env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        done = subprocess.run([sys.executable, "-c", load], cwd=tmp_path, env=env, capture_output=True, text=True)
        assert done.stdout.strip() == type(processor).__name__, done.stderr


def log_text(run, n, seed):
    rnd = random.Random(seed)
    lines = []
    for i in range(n):
        at = f"2026-01-02 10:{i // 60 % 60:02d}:{i % 60:02d}"
        kind = rnd.randrange(5)
        if kind == 0:
            lines.append("")
        elif kind == 1:
            lines.append(f"plain line {i} of {run} é")
        else:
            lines.append(f"[{at}] [TRAIN]   {{'loss': {rnd.randrange(1, 300) / 100}, 'grad_norm': 1.5, 'epoch': {i / n:.3f}}}")
    return "\n".join(lines) + "\n"


def write_logs(root):
    """Rotated files, a folder of parts, and single files; the blocks of a test are much smaller than a file."""
    files = {
        "a.log": ("a", 0, 120), "a.log.1": ("a", 1, 70), "b.2.log": ("b", 2, 90), "b.10.log": ("b", 10, 50),
        "2026-01-02_1000_x-7.log": ("2026-01-02_1000_x-7", 0, 40), "run=c/part-00000-u.txt": ("c", 0, 60), "run=c/part-00001-u.txt": ("c", 1, 60),
    }
    want = {}
    for i, (name, (run, number, n)) in enumerate(files.items()):
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        text = log_text(run, n, i)
        path.write_text(text)
        for no, line in enumerate(text.split("\n")[:-1], 1):
            if line.strip():
                want[run, number * readers.FILE_LINES + no] = line
    return want


@pytest.mark.parametrize("block_bytes", ["300", "1700", "64m"])
def test_logs_are_ordered_alike_in_batch_and_stream(spark, tmp_path, block_bytes):
    want = write_logs(tmp_path / "logs")
    paths = [f"{tmp_path}/logs/*log*", f"{tmp_path}/logs/run=c"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", block_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        batch = [readers.read_run_log(spark, p) for p in paths]
        lines = batch[0].unionByName(batch[1])
        rows = lines.collect()
        assert {(r.run, r.ord): (r.line if r.ts is None else None) for r in rows} == {k: (v if v[0] != "[" else None) for k, v in want.items()}
        assert len(rows) == len(want)
        for i, p in enumerate(paths):
            ingest.ingest_logs(spark, p, f"{tmp_path}/lines{i}", f"{tmp_path}/cp{i}").trigger(availableNow=True).start().awaitTermination()
        stored = ingest.stored_lines(spark, f"{tmp_path}/lines0").unionByName(ingest.stored_lines(spark, f"{tmp_path}/lines1"))
        assert sorted(map(str, stored.collect())) == sorted(map(str, rows))
        summary = sorted(map(str, trainlog.loss_summary(trainlog.loss_points(lines)).collect()))
        assert sorted(map(str, trainlog.loss_summary(trainlog.loss_points(stored)).collect())) == summary and len(summary) == 4
        stream = ingest.stored_lines(spark, f"{tmp_path}/lines0", streaming=True)
        running = drain(losses.loss_stream(stream), "points")
        assert sorted(map(str, running.collect())) == sorted(map(str, trainlog.loss_points(batch[0]).collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("block_bytes", ["300", "64m"])
def test_archives_give_what_single_logs_give(spark, tmp_path, block_bytes):
    texts = {f"r{i}": log_text(f"r{i}", 12 * i + 1, i) for i in range(9)}
    want = {(run, (i % 2) * readers.FILE_LINES + no): line for i, (run, text) in enumerate(texts.items()) for no, line in enumerate(text.split("\n")[:-1], 1) if line.strip()}
    (tmp_path / "logs").mkdir()
    for part in (0, 1):
        lines = [f"{run}\t{line}\n" for i, (run, text) in enumerate(texts.items()) if i % 2 == part for line in text.split("\n")[:-1]]
        (tmp_path / "logs" / f"part-0000{part}-u.txt").write_text("".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", block_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = readers.read_run_log(spark, f"{tmp_path}/logs", archive=True).collect()
        assert len(rows) == len(want) and {(r.run, r.ord) for r in rows} == set(want)
        assert all(r.line == want[r.run, r.ord] if r.ts is None else want[r.run, r.ord].endswith(r.line) for r in rows)
        ingest.ingest_logs(spark, f"{tmp_path}/logs", f"{tmp_path}/lines", f"{tmp_path}/cp", archive=True).trigger(availableNow=True).start().awaitTermination()
        assert sorted(map(str, ingest.stored_lines(spark, f"{tmp_path}/lines").collect())) == sorted(map(str, rows))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize(("text", "message"), [("a\t1\nb\t1\na\t2\n", "lie apart"), ("a\t1\nno run here\n", "without a run")])
def test_broken_archives_raise(spark, tmp_path, text, message):
    (tmp_path / "part-00000").write_text(text)
    with pytest.raises(FAILED, match=message):
        readers.read_run_log(spark, str(tmp_path / "part-00000"), archive=True).collect()


def test_logs_of_many_runs_are_few_files(spark, tmp_path):
    rows = [(i, START + timedelta(seconds=i), i % 300 if i % 7 else None, "a\nb" if i % 5 == 0 else "click", 0.5, "{}") for i in range(900)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    path = queries_streaming.log_files(spark, str(tmp_path))
    assert spark.read.text(path).select("_metadata.file_path").distinct().count() <= 8
    got = readers.read_run_log(spark, path, archive=True).groupBy("run").agg(F.count("*").alias("n"), (F.max("ord") % readers.FILE_LINES).alias("last")).collect()
    want = {}
    for _, _, run, kind, _, _ in rows:
        name = queries_streaming.NO_RUN if run is None else str(run)
        want[name] = want.get(name, 0) + 1 + kind.count("\n")
    assert {r.run: r.n for r in got} == want and all(r.n == r.last for r in got)
