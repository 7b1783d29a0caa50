"""Training-data validation and record ordinals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.functions.jsontext import whole_json
from gradeloom.functions.rules import grade_records
from gradeloom.functions.text import py_strip
from gradeloom.plans.once import compute_once, fresh
from gradeloom.plans.skew import lookup_join


def with_ordinal(lines: DataFrame) -> DataFrame:
    """Number the lines of :func:`gradeloom.sources.readers.read_lines`, per file.

    Adds ``line_no`` (physical, from 1) and, dropping blank lines, ``record_no`` (from 1).
    Lines are numbered where they are read: ids run on within a task, so subtracting the
    first id of a file block gives the position in the block, and a table with one row per
    block gives its offset. Lines are neither sorted nor, while that table fits a
    broadcast, shuffled.
    """
    lines = _same_blocks(lines)
    block = ["path", "block_start"]
    upto = Window.partitionBy("path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    numbered = lines.withColumn("_line", F.monotonically_increasing_id())
    records = numbered.filter(F.length(py_strip(F.col("value"))) > 0).withColumn("_rec", F.monotonically_increasing_id())

    def offsets(df: DataFrame, idx: str, out: str) -> DataFrame:
        per = df.groupBy(*block).agg(F.count(F.lit(1)).alias("_n"), F.min(idx).alias("_first"))
        start = F.coalesce(F.sum("_n").over(upto), F.lit(0)) - F.col("_first") + 1
        return per.select(*block, start.alias(out))

    starts = offsets(numbered, "_line", "_lo").join(offsets(records, "_rec", "_ro"), block)
    placed = lookup_join(records, starts, block, ["_rec"], "left", label="line-offsets")
    lost = F.raise_error(F.concat(F.lit("file blocks changed while reading "), F.col("path"))).cast("bigint")
    return placed.select(
        *lines.columns,
        F.coalesce((F.col("_line") + F.col("_lo")).cast("bigint"), lost).alias("line_no"),
        F.coalesce((F.col("_rec") + F.col("_ro")).cast("bigint"), lost).alias("record_no"),
    )


def _same_blocks(lines: DataFrame) -> DataFrame:
    """The lines with their file blocks fixed, for every pass over them and every recomputation.

    A scan is cut into blocks when it is planned, by the size of the cluster and the settings of that moment, and a second
    pass is planned later. The partitions of an RDD are fixed when it is made.
    """
    spark = lines.sparkSession
    return DataFrame(spark._jsparkSession.createDataFrame(lines._jdf.rdd(), lines._jdf.schema()), spark)


def validate_sharegpt(lines: DataFrame, first_n: int | None = None, value: str = "value") -> DataFrame:
    """Violations of the conversation format: ``(line_no, record_no, reason)``.

    Expects ``value``, ``line_no`` and ``record_no``; other columns (a path, say) are kept.
    ``first_n`` limits the check to the first records of each file; by default all are checked.
    """
    # The line is read behind a barrier: whatever makes it is evaluated once, not again for the blank test.
    line, json = fresh(lines.columns, "_line", "_json")
    records = compute_once(lines, {line: py_strip(F.col(value))}).filter(F.length(line) > 0)
    if first_n is not None:
        records = records.filter(F.col("record_no") <= first_n)
    kept = [c for c in lines.columns if c != value]
    parsed = F.col(json)
    chats = F.try_variant_get(parsed, "$.conversations", "variant")
    first = F.try_variant_get(parsed, "$.conversations[0]", "variant")
    has_keys = (
        F.try_variant_get(parsed, "$.conversations[0].from", "variant").isNotNull()
        & F.try_variant_get(parsed, "$.conversations[0].value", "variant").isNotNull()
    )
    reason = (
        F.when(parsed.isNull(), "not valid JSON")
        .when(~F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT")), "record is not an object")
        .when(chats.isNull(), "no conversations key")
        .when(first.isNull(), "conversations is not a non-empty list")
        .when(~has_keys, "first turn lacks from or value")
    )
    checked = compute_once(compute_once(records, {json: whole_json(F.col(line))}).select(*kept, json), {"reason": reason})
    return checked.select(*kept, "reason").filter(F.col("reason").isNotNull())


def grade_size(df: DataFrame) -> DataFrame:
    """Record count and how far it carries."""
    n = F.count(F.lit(1))
    return df.agg(n.alias("n_records")).withColumn("grade", grade_records(F.col("n_records")))
