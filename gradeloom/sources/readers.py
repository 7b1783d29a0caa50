"""Readers. Schemas are explicit; malformed input raises or is put aside, as asked."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gradeloom import schemas
from gradeloom.functions.jsontext import has_keys, whole_json
from gradeloom.functions.logs import parse_log_line
from gradeloom.functions.names import file_stem, parse_run_name
from gradeloom.functions.text import py_strip
from gradeloom.operators.validate import with_ordinal
from gradeloom.plans.once import compute_once
from gradeloom.plans.skew import lookup_join
from gradeloom.sources.sinks import run_folders

log = logging.getLogger(__name__)

EXAMPLE_GLOB = "*/training.jsonl"
SHOWN_CHARS = 80
SHOWN_NAMES = 20
# ``<endpoint>/training.jsonl``, the file being one file or a folder of parts; or ``endpoint=<endpoint>/``.
ENDPOINT_OF_PATH = r"([^/=]+)/(?:training\.jsonl(?:/[^/]*)?|part-[^/]*)$"

# Run documents of our own lie one per folder ``run_id=<run>``.
RUN_FOLDER = r"/run_id=([^/]+)/[^/]*$"
RUN_FOLDER_GLOB = "run_id=*/*.json"

# A run's log: all files of a folder ``run=<run>``, or ``<run>.log`` and its numbered parts.
LOG_FOLDER = r"/run=([^/]+)/[^/]*$"
LOG_NAME = r"^(.*?)(?:\.(\d+))?\.[A-Za-z]+(?:\.(\d+))?$"
FILE_LINES = 1 << 40


def _plus(schema: StructType, name: str, kind: str) -> StructType:
    """The schema with one more field; ``StructType.add`` would change it in place."""
    return StructType(schema.fields).add(name, kind)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines with the file and block they come from."""
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block_start")
    )


def _parsed(lines: DataFrame, schema, mode: str, required: tuple[str, ...] = ()) -> DataFrame:
    """``record`` from each line; malformed lines raise, or stay with a null record.

    A line is malformed if it is not one JSON object with the required keys and nothing else.
    """
    checked = compute_once(lines, {"_json": whole_json(F.col("value"))})
    checked = compute_once(checked, {"_good": has_keys(F.col("_json"), *required)}).drop("_json")
    record = F.from_json("value", schema, {"mode": "PERMISSIVE"})
    if mode == "failfast":
        at = F.concat(F.lit("malformed record in "), F.col("path"), F.lit(": "), F.left("value", F.lit(SHOWN_CHARS)))
        record = F.when(F.col("_good"), record).otherwise(F.raise_error(at).cast(schema))
    else:
        record = F.when(F.col("_good"), record)
    return checked.withColumn("record", record).drop("_good")


def read_examples(
    spark: SparkSession, root: str, mode: str = "failfast", glob: str = EXAMPLE_GLOB, ordinal: bool = False
) -> DataFrame:
    """API examples of all endpoints below ``root``; blank lines are skipped.

    ``mode='quarantine'`` keeps malformed lines, with their text in ``malformed``. With
    ``ordinal`` the line number in the file is added; with the path it tells copies apart.
    """
    lines = read_lines(spark, f"{root.rstrip('/')}/{glob}")
    lines = with_ordinal(lines) if ordinal else lines.filter(F.length(py_strip(F.col("value"))) > 0)
    parsed = _parsed(lines, schemas.API_EXAMPLE, mode, ("question", "api_call"))
    endpoint = F.regexp_extract("path", ENDPOINT_OF_PATH, 1)
    columns = ["path", endpoint.alias("endpoint"), "record.question", "record.api_call"]
    if ordinal:
        columns.append("line_no")
    if mode == "failfast":
        return parsed.select(*columns)
    return parsed.select(*columns, F.when(F.col("record").isNull(), F.col("value")).alias("malformed"))


def read_sharegpt(spark: SparkSession, path: str) -> DataFrame:
    """Training conversations; blank lines are skipped, malformed ones raise."""
    lines = _records(spark, path)
    return _parsed(lines, schemas.SHAREGPT, "failfast", ("conversations",)).select("record.conversations")


def _records(spark: SparkSession, path: str) -> DataFrame:
    lines = read_lines(spark, path)
    return lines.filter(F.length(py_strip(F.col("value"))) > 0)


def read_holdout(spark: SparkSession, path: str, ordinal: bool = False) -> DataFrame:
    """Holdout records. Every line must parse; a blank line raises too (the JSON reader drops it).

    With ``ordinal`` the zero-based record index of each file is added as ``ord``.
    """
    lines = read_lines(spark, path)
    blank = F.length(py_strip(F.col("value"))) == 0
    text = F.when(blank, F.raise_error(F.concat(F.lit("blank line in "), F.col("path"))).cast("string")).otherwise(F.col("value"))
    lines = lines.withColumn("value", text)
    added = []
    if ordinal:
        lines = with_ordinal(lines)
        added = [(F.col("line_no") - 1).alias("ord")]
    return _parsed(lines, schemas.HOLDOUT, "failfast", ("messages",)).select("record.*", "path", *added)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Generated answers ``(run_id, model, rec_id, id, generated, error)``; malformed lines raise."""
    return _parsed(_records(spark, path), schemas.PREDICTION, "failfast", ("rec_id",)).select("record.*")


def read_judge_responses(spark: SparkSession, path: str) -> DataFrame:
    """A judge's raw responses ``(run_id, rec_id, response, failure)``; malformed lines raise, odd responses do not."""
    return _parsed(_records(spark, path), schemas.JUDGE_RESPONSE, "failfast", ("run_id", "rec_id")).select("record.*")


def read_runs(spark: SparkSession, folder: str, on_error: str = "skip", glob: str = "*.json") -> DataFrame:
    """Run documents of a folder, one row each, with name, modification time and kind.

    ``on_error='skip'`` leaves out unreadable documents, ``'fail'`` raises. Only direct
    children are read, so runs filed in subfolders stay apart.
    """
    strict = on_error == "fail"
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    schema = schemas.RUN if strict else _plus(schemas.RUN, "_corrupt_record", "string")
    docs = reader.schema(schema).json(f"{folder.rstrip('/')}/{glob}")
    path = F.col("_metadata.file_path")
    in_folder = F.regexp_extract(path, RUN_FOLDER, 1)
    name = F.when(in_folder != "", in_folder).otherwise(file_stem(path))
    docs = docs.select("*", name.alias("run_id"), F.col("_metadata.file_modification_time").alias("mtime"))
    if not strict:
        broken = [r.run_id for r in docs.filter(F.col("_corrupt_record").isNotNull() & F.col("meta").isNull()).select("run_id").limit(SHOWN_NAMES + 1).collect()]
        if broken:
            log.warning("unreadable run documents left out: %s%s", ", ".join(broken[:SHOWN_NAMES]), " ..." * (len(broken) > SHOWN_NAMES))
        docs = docs.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    return docs.withColumn("name_parts", parse_run_name(F.col("run_id"))).withColumn(
        "run_kind", F.when(F.col("meta.system_prompt_source").isNotNull(), "prompt_baseline")
        .when(F.col("meta.judge_model").isNotNull(), "judged").otherwise("eval")
    )


def run_rows(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Run documents as the three tables ``runs``, ``run_tags`` and ``run_results``."""
    runs = docs.select("run_id", "mtime", "run_kind", "meta.*", "summary.avg_score", "summary.band_counts")
    tags = docs.select("run_id", F.explode("summary.convention_breakdown").alias("t")).select(
        "run_id", "t.convention", "t.avg", "t.n", "t.scores"
    )
    results = docs.select("run_id", F.posexplode("results").alias("ord", "r")).select(
        "run_id", F.col("ord").cast("bigint").alias("rec_id"), F.col("ord").cast("bigint").alias("ord"), "r.*"
    )
    return runs, tags, results


def read_run_tables(spark: SparkSession, root: str, prefix: str = "") -> dict[str, DataFrame]:
    """The tables ``runs``, ``run_tags``, ``run_tag_scores`` and ``run_results`` that the run sink wrote.

    ``prefix='judged_'`` reads those of judged runs. Columns of ``runs`` are those it was written with. Documents made
    elsewhere are read with :func:`read_runs` and taken apart with :func:`run_rows`.
    """
    return {name: spark.read.parquet(f"{root.rstrip('/')}/{folder}") for name, folder in run_folders(prefix).items()}


def read_results(spark: SparkSession, root: str, model: str | None = None, run_id: str | None = None) -> DataFrame:
    """Stored result rows, of one model or run if given; other folders are not read."""
    rows = spark.read.schema(schemas.RUN_RESULTS).parquet(f"{root.rstrip('/')}/run_results")
    for name, value in (("model", model), ("run_id", run_id)):
        if value is not None:
            rows = rows.filter(F.col(name) == value)
    return rows


def read_manifest(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Manifest in its JSON form, or with ``multi_line=False`` one per line; no rows when missing.

    ``max_steps`` is null unless it is an integer; ``max_steps_ignored`` then holds its text.
    """
    wanted = F.col("meta.max_steps").try_cast("int")
    reader = spark.read.schema(schemas.MANIFEST).option("multiLine", multi_line).option("mode", "FAILFAST")
    try:
        docs = reader.json(path).withColumn("manifest", file_stem(F.col("_metadata.file_path")))
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no manifest at %s", path)
        docs = spark.createDataFrame([], _plus(schemas.MANIFEST, "manifest", "string"))
    return docs.select(
        "manifest",
        F.col("meta.cycle").alias("cycle"),
        wanted.alias("max_steps"),
        F.when(wanted.isNull(), F.col("meta.max_steps")).alias("max_steps_ignored"),
        "patterns",
        "training",
    )


def read_log(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Run-log lines ``(ts, level, msg, path)``; lines of another form keep a null ``ts``."""
    source = spark.readStream.format("text") if streaming else spark.read.format("text")
    lines = source.load(path).select("value", F.col("_metadata.file_path").alias("path"))
    parsed = lines.withColumn("p", parse_log_line(F.col("value")))
    return parsed.select(
        "p.ts", "p.level", F.when(F.col("p").isNull(), F.col("value")).otherwise(F.col("p.msg")).alias("msg"), "path"
    )


def log_source(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Raw log lines with file and block, as a table or a stream of files; see :func:`ordered_log`."""
    source = spark.readStream.format("text") if streaming else spark.read.format("text")
    return source.load(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block_start"))


def ordered_log(lines: DataFrame, archive: bool = False) -> DataFrame:
    """Log lines as ``(run, ord, ts, level, line)``, in the order in which each run wrote them.

    ``lines`` are whole files of :func:`log_source`. The run is the folder ``run=<run>`` or the name of the file without its
    ending and number; ``ord`` counts a run's lines, blank ones included: the number of the file (``<run>.3.log``,
    ``<run>.log.3``, ``part-3...`` in a folder; 0 if it has none) times ``FILE_LINES`` plus the number of the line in it. It
    depends on names and contents alone, not on blocks or on which files are read together, so a stream gives the same as
    a batch. Blank lines are left out.

    Many runs with few lines each are better kept in an ``archive``: every line of its files is a run, a tab and a line of
    the run's log, and the lines of a run lie together (else it raises). Runs are taken from the lines then, and lines are
    counted from the first one of their run in the file.
    """
    name = F.regexp_extract("path", r"[^/]*$", 0)
    folder = F.regexp_extract("path", LOG_FOLDER, 1)
    run = F.when(folder != "", folder).otherwise(F.regexp_extract(name, LOG_NAME, 1))
    rotated = F.concat(F.regexp_extract(name, LOG_NAME, 2), F.regexp_extract(name, LOG_NAME, 3))
    in_parts = F.lit(True) if archive else folder != ""
    number = F.when(in_parts, F.regexp_extract(name, r"^part-(\d+)", 1)).otherwise(rotated)
    ord_ = F.coalesce(number.try_cast("bigint"), F.lit(0).cast("bigint")) * F.lit(FILE_LINES) + F.col("line_no")
    numbered = _archived(with_ordinal(lines)) if archive else with_ordinal(lines).withColumn("run", run)
    parsed = numbered.withColumn("p", parse_log_line(F.col("value")))
    message = F.when(F.col("p").isNull(), F.col("value")).otherwise(F.col("p.msg"))
    return parsed.select("run", ord_.alias("ord"), "p.ts", "p.level", message.alias("line"))


def _archived(lines: DataFrame) -> DataFrame:
    """Numbered lines ``(path, value, line_no)`` of an archive as those of its logs ``(path, run, value, line_no)``."""
    tab = F.instr("value", "\t")
    no_run = F.raise_error(F.concat(F.lit("a line without a run in "), F.col("path"))).cast("string")
    entries = lines.select(
        "path", F.when(tab > 0, F.substring_index("value", "\t", 1)).otherwise(no_run).alias("run"),
        F.substr("value", tab + 1).alias("value"), "line_no",
    )
    lo, hi, n = F.min("line_no"), F.max("line_no"), F.count(F.lit(1))
    apart = F.raise_error(F.concat(F.lit("lines of a run lie apart in "), F.col("path"), F.lit(": "), F.col("run"))).cast("bigint")
    starts = entries.groupBy("path", "run").agg(lo.alias("_lo"), hi.alias("_hi"), n.alias("_n"))
    starts = starts.select("path", "run", F.when(F.col("_hi") - F.col("_lo") + 1 == F.col("_n"), F.col("_lo")).otherwise(apart).alias("_start"))
    logged = entries.filter(F.length(py_strip(F.col("value"))) > 0)
    placed = lookup_join(logged, starts, ["path", "run"], ["line_no"], label="log-starts")
    return placed.select("path", "run", "value", (F.col("line_no") - F.col("_start") + 1).alias("line_no"))


def read_run_log(spark: SparkSession, path: str, archive: bool = False) -> DataFrame:
    """:func:`ordered_log` of the files at ``path``: what loss points, warnings and pauses are taken from."""
    return ordered_log(log_source(spark, path), archive)


def resolve_dataset(
    data_dir: str, version: str | None = None, holdout: str | None = None,
    default_train: str = "training.jsonl", default_holdout: str = "holdout.jsonl",
) -> tuple[str, str]:
    """Training and holdout paths of a data version; an explicit holdout path wins."""
    root = data_dir.rstrip("/")
    train = f"{root}/training_{version}.jsonl" if version else f"{root}/{default_train}"
    test = f"{root}/holdout_{version}.jsonl" if version else f"{root}/{default_holdout}"
    return train, holdout or test
