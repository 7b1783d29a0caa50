"""Writers. All of them write from the tasks that hold the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.functions.rules import priority_rank
from gradeloom.functions.text import ALL_BANDS, WEAK_SCORE
from gradeloom.operators.aggregate import run_summary, tag_breakdown, tag_scores
from gradeloom.operators.judge import judge_summary
from gradeloom.operators.status import SEED_FIELDS, build_status


def write_sharegpt(df: DataFrame, path: str) -> None:
    df.select("conversations").write.mode("overwrite").json(path)


def write_holdout(df: DataFrame, path: str) -> None:
    fields = [c for c in ("id", "label", "messages", "conventions_tested", "source_file") if c in df.columns]
    df.select(*fields).write.mode("overwrite").json(path)


def write_partitioned(df: DataFrame, path: str, by: str = "endpoint", fmt: str = "json") -> None:
    """One folder per endpoint; large endpoints get several files, small ones few."""
    df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).format(fmt).save(path)


def sync_endpoints(df: DataFrame, path: str, endpoints: list[str] | None = None, by: str = "endpoint") -> None:
    """Replace the stored source rows of the given endpoints, leaving others as they are.

    Safe to repeat. A requested endpoint without source rows raises.
    """
    if endpoints is not None:
        df = df.filter(F.col(by).isin(*endpoints))
        found = {r[0] for r in df.select(by).distinct().collect()}  # at most len(endpoints) names
        missing = sorted(set(endpoints) - found)
        if missing:
            raise FileNotFoundError(f"no source data for: {', '.join(missing)}")
    writer = df.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(by).parquet(path)


def write_tables(path: str, partition_by: list[str], **tables: DataFrame) -> None:
    for name, df in tables.items():
        keys = [k for k in partition_by if k in df.columns]
        even = df.hint("rebalance", *keys) if keys else df
        writer = even.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        (writer.partitionBy(*keys) if keys else writer).parquet(f"{path.rstrip('/')}/{name}")


RESULT_FIELDS = (
    "id", "label", "source_file", "conventions_tested", "score", "band", "prompt", "expected", "generated", "error",
    "length_ratio",
)
JUDGE_FIELDS = ("judge_score", "judge_band", "judge_reason")


def _items(entries: Column, fields: Sequence[str]) -> Column:
    """Collected structs in order, cut down to the named fields."""
    return F.transform(F.array_sort(entries), lambda e: F.struct(*[e[f].alias(f) for f in fields]))


def _summary_struct(rows: DataFrame, averages: DataFrame, score_col: str, weak: bool) -> DataFrame:
    """``(run_id, summary)``: average, band counts, tag breakdown with score lists, weak tags."""
    scores = tag_scores(rows, score_col).groupBy("run_id", "convention").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ord", "score"))), lambda r: r["score"]).alias("scores")
    )
    entry = F.struct("avg", "convention", "n", "scores")
    tags = (
        tag_breakdown(rows, score_col)
        .join(scores, ["run_id", "convention"])
        .groupBy("run_id")
        .agg(_items(F.collect_list(entry), ("convention", "avg", "n", "scores")).alias("_tags"))
    )
    bands = [b.lower() for b in ALL_BANDS if b.lower() in averages.columns]
    counts = F.map_from_arrays(F.array(*[F.lit(b.upper()) for b in bands]), F.array(*bands))
    breakdown = F.coalesce(F.col("_tags"), F.array().cast(tags.schema["_tags"].dataType))
    fields = [
        "avg_score",
        F.map_filter(counts, lambda _, n: n > 0).alias("band_counts"),
        breakdown.alias("convention_breakdown"),
    ]
    if weak:
        fields.append(F.filter(breakdown, lambda t: t["avg"] < WEAK_SCORE).alias("weak_conventions"))
    return averages.join(tags, "run_id", "left").select("run_id", "total", F.struct(*fields).alias("summary"))


def run_documents(results: DataFrame, runs: DataFrame, names: Sequence[str], weak: bool = True) -> DataFrame:
    """Nested documents ``(run_id, meta, summary, results)`` of the named runs.

    A document holds all of its run's rows in one value, so it is made only for runs that are asked for by name; the row
    tables of :func:`write_run` hold every run of any size. Prompt-only runs carry no weak tags (``weak=False``).
    """
    rows, runs = (df.filter(F.col("run_id").isin(*names)) for df in (results, runs))
    fields = [*RESULT_FIELDS, *[c for c in JUDGE_FIELDS if c in rows.columns]]
    listed = rows.groupBy("run_id").agg(_items(F.collect_list(F.struct("ord", *fields)), fields).alias("results"))
    meta = [c for c in runs.columns if c != "run_id"]
    return (
        runs.join(listed, "run_id")
        .join(_summary_struct(rows, run_summary(rows), "score", weak), "run_id")
        .select("run_id", F.struct(*meta, F.col("total").alias("n_records")).alias("meta"), "summary", "results")
    )


def judged_documents(judged: DataFrame, runs: DataFrame, names: Sequence[str]) -> DataFrame:
    """:func:`run_documents` of judged runs: the judge's summary, the other one beside it."""
    rows = judged.filter(F.col("run_id").isin(*names))
    averages = judge_summary(rows).withColumnRenamed("judge_avg", "avg_score")
    by_judge = _summary_struct(rows, averages, "judge_score", weak=False).select("run_id", "summary")
    docs = run_documents(judged, runs, names).withColumnRenamed("summary", "similarity_summary")
    return docs.join(by_judge, "run_id").select("run_id", "meta", "similarity_summary", "summary", "results")


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON file per run, in a folder named after it."""
    documents.repartition("run_id").write.mode("overwrite").partitionBy("run_id").json(path)


def _run_tables(results: DataFrame, summary: DataFrame, runs: DataFrame | None, score_col: str) -> dict[str, DataFrame]:
    """``runs`` (all metadata, averages, band counts), ``run_tags`` and ``run_tag_scores`` of result rows."""
    known = summary if runs is None else runs.join(summary, "run_id", "left")
    return {
        "runs": known, "run_tags": tag_breakdown(results, score_col),
        "run_tag_scores": tag_scores(results, score_col).select("run_id", "convention", "ord", "score"),
    }


def write_run(results: DataFrame, summary: DataFrame, path: str, runs: DataFrame | None = None) -> None:
    """Every run of any size as Parquet tables: ``run_results``, ``runs``, ``run_tags``, ``run_tag_scores``.

    ``runs (run_id, ...)`` holds what else is known of each run; all its columns are stored.
    """
    write_tables(path, ["model", "run_id"], run_results=results, **_run_tables(results, summary, runs, "score"))


def write_judged(df: DataFrame, path: str, runs: DataFrame | None = None) -> None:
    """Judged runs as Parquet tables: ``judged_results``, and the judge's ``judged_runs``, ``judged_run_tags``, ``judged_run_tag_scores``."""
    tables = _run_tables(df, judge_summary(df), runs, "judge_score")
    write_tables(path, ["model", "run_id"], judged_results=df, **{f"judged_{name}": t for name, t in tables.items()})


def cluster_runs(spark: SparkSession, path: str, target: str, prefix: str = "") -> None:
    """Tables of :func:`write_run` (``prefix='judged_'``: of :func:`write_judged`) stored again for many runs.

    A folder per run lets one run be replaced by itself, but makes a small file for each; here the rows of a model lie in files
    sorted by run, so a run is found by the files' statistics. Ranges take in the rows' order, so that a very large run is
    divided too. :func:`gradeloom.sources.readers.read_results` and ``read_run_tables`` read either form.
    """
    for name, folder in run_folders(prefix).items():
        rows = spark.read.parquet(f"{path.rstrip('/')}/{folder}")
        keys = [c for c in ("model", "run_id") if c in rows.columns]
        rows = rows.withColumns({c: F.col(c).cast("string") for c in keys})
        order = [*keys, *[c for c in ("convention", "ord", "rec_id") if c in rows.columns]]
        sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        writer = sorted_rows.write.mode("overwrite")
        (writer.partitionBy("model") if "model" in keys else writer).parquet(f"{target.rstrip('/')}/{folder}")


def run_folders(prefix: str = "") -> dict[str, str]:
    """Folders of the tables of stored runs, by name of the table."""
    names = {"runs": "runs", "run_tags": "run_tags", "run_tag_scores": "run_tag_scores", "run_results": "results" if prefix else "run_results"}
    return {name: f"{prefix}{folder}" for name, folder in names.items()}


def _generated(at: str | None) -> Column:
    """When a status was made: as given, or now, in UTC."""
    now = F.date_format(F.to_utc_timestamp(F.now(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.lit(at) if at else now


def status_meta(parts: dict[str, DataFrame], generated_at: str | None = None) -> DataFrame:
    """One row per run: when its status was made, on which set and cycle, from which run, and the action."""
    source = F.concat("run_id", F.lit(".json")).alias("source_eval")
    return parts["summary"].select("run_id", _generated(generated_at).alias("generated_at"), "eval_set", "cycle", "action", source)


def status_documents(parts: dict[str, DataFrame], names: Sequence[str], generated_at: str | None = None) -> DataFrame:
    """One nested status for each of the named runs, from :func:`gradeloom.operators.status.status_parts`.

    Its lists are single values, so it is made only for runs asked for by name; the rows of :func:`write_status` hold every
    run of any size. ``generated_at`` defaults to the time of the query, in UTC.
    """
    lists = {k: v.filter(F.col("run_id").isin(*names)) for k, v in parts.items() if k != "summary"}
    doc = parts["summary"].filter(F.col("run_id").isin(*names))

    def listed(name: str, order: list, fields: list) -> DataFrame:
        entry = F.struct(F.struct(*order).alias("_order"), F.struct(*fields).alias("_item"))
        return lists[name].groupBy("run_id").agg(
            F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["_item"]).alias(f"_{name}")
        )

    boost = listed(
        "boost", [priority_rank(F.col("priority")).alias("p"), "avg_score", "name"],
        ["name", "avg_score", "n_holdout_examples", "priority"],
    )
    skip = listed("skip", ["avg_score", "name"], ["name", "avg_score", "reason"])
    cases = listed("boilerplate", ["ord"], ["func", "score", "length_ratio"])
    per_tag = lists["seed"].groupBy("run_id", "name").agg(
        F.array_sort(F.collect_list(F.when(F.col("rank").isNotNull(), F.struct("rank", *SEED_FIELDS)))).alias("e")
    )
    seed_map = per_tag.groupBy("run_id").agg(
        F.map_from_entries(
            F.array_sort(
                F.collect_list(
                    F.struct("name", F.transform("e", lambda r: F.struct(*[r[f].alias(f) for f in SEED_FIELDS])).alias("examples"))
                )
            )
        ).alias("_seed")
    )
    tables = [boost, skip, cases, seed_map]
    if "uncovered" in lists:
        tables.append(listed("uncovered", ["name"], ["name"]))
    for df in tables:
        doc = doc.join(df, "run_id", "left")

    def or_empty(column: str, empty) -> Column:
        return F.coalesce(F.col(column), empty.cast(doc.schema[column].dataType))

    nothing = F.array()
    uncovered = or_empty("_uncovered", nothing) if "uncovered" in lists else F.array().cast("array<struct<name:string>>")
    return doc.select(
        "run_id",
        F.struct(_generated(generated_at).alias("generated_at"), "eval_set", "cycle", "action", F.concat("run_id", F.lit(".json")).alias("source_eval")).alias("meta"),
        F.struct("avg_similarity", "previous_avg", "base_model_avg", "excellent", "good", "partial", "poor", "total").alias("scores"),
        or_empty("_boost", nothing).alias("boost_conventions"),
        or_empty("_skip", nothing).alias("skip_conventions"),
        uncovered.alias("uncovered_conventions"),
        F.struct("func_start_pct", "boilerplate_detected", or_empty("_boilerplate", nothing).alias("boilerplate_cases")).alias("format_health"),
        F.coalesce(F.col("_seed"), F.create_map().cast(doc.schema["_seed"].dataType)).alias("seed_candidates"),
    )


def write_status(parts: dict[str, DataFrame], path: str, generated_at: str | None = None) -> None:
    """The status of every run of any size: ``rows`` by section and place, and ``meta``, one row per run."""
    root = path.rstrip("/")
    rows = build_status(parts)
    rows.repartitionByRange("run_id", "section", "rank", "name").sortWithinPartitions("run_id", "section", "rank", "name").write.mode("overwrite").json(f"{root}/rows")
    status_meta(parts, generated_at).write.mode("overwrite").json(f"{root}/meta")
