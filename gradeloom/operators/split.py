"""Seeded stratified split."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.functions.rules import plan_columns, PLAN_CONSTANTS
from gradeloom.plans.once import fresh
from gradeloom.plans.skew import join_measured, lookup_join, materialize_measured, null_safe, shuffle_hash

# Default share of the holdout and default seed.
HOLDOUT_FRACTION, SEED = 0.10, 42


def stratified_split(
    df: DataFrame,
    stratum: str,
    key: str,
    frac: float = HOLDOUT_FRACTION,
    seed: int = SEED,
    digits: int = 4,
) -> DataFrame:
    """Add ``split`` (``train``/``holdout``): exact shares per stratum from a seeded shuffle.

    ``key`` must be unique. Per stratum the first ``max(1, round_half_even(n * frac))``
    records by hash are the holdout. Two narrow passes over stratum and key find where that
    boundary lies: sizes per hash bucket name the bucket it falls into, and ranking that one
    bucket (``16**-digits`` of a stratum) names the last holdout record. The whole rows are
    then read once and compared with one boundary per stratum, without being shuffled, so a
    hot stratum never meets in one task.
    """
    hashed = df.withColumns({"_h": shuffle_hash(F.col(key), seed), "_s": null_safe(F.col(stratum))})
    narrow = hashed.select("_s", "_h", F.col(key).alias("_k"), F.substring("_h", 1, digits).alias("_bucket"))
    whole = Window.partitionBy("_s")
    running = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = (
        narrow.groupBy("_s", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_through", F.sum("_n").over(running))
        .withColumn("_quota", F.greatest(F.lit(1), F.bround(F.sum("_n").over(whole) * F.lit(frac))).cast("bigint"))
        .filter((F.col("_through") >= F.col("_quota")) & (F.col("_through") - F.col("_n") < F.col("_quota")))
        .select("_s", "_bucket", (F.col("_quota") - F.col("_through") + F.col("_n")).alias("_owed"))
    )
    rank = F.row_number().over(Window.partitionBy("_s").orderBy("_h", "_k"))
    bounds = (
        lookup_join(narrow, cuts, ["_s", "_bucket"], ["_k"], label="split-cuts")
        .withColumn("_rank", rank)
        .filter(F.col("_rank") == F.col("_owed"))
        .select("_s", F.struct("_h", "_k").alias("_last"))
    )
    held = F.struct("_h", F.col(key).alias("_k")) <= F.col("_last")
    placed = lookup_join(hashed, bounds, ["_s"], [key], label="split-bounds")
    return placed.withColumn("split", F.when(held, "holdout").otherwise("train")).select(*df.columns, "split")


def holdout_rows(
    df: DataFrame,
    stratum: str,
    key: str,
    frac: float = HOLDOUT_FRACTION,
    seed: int = SEED,
    digits: int = 4,
    rank: str = "split_rank",
) -> DataFrame:
    """The holdout of :func:`stratified_split`, each record with its zero-based place in its stratum's shuffled order.

    One histogram of stratum and hash prefix gives both the cut and the numbering: a prefix's first place is the count of
    those before it, and only records of prefixes up to the cut are ranked, each prefix by itself and on narrow rows. The
    whole rows are read once. Where the ranked records fit a broadcast no whole row is shuffled, else only those of prefixes
    up to the cut are, by their key.
    """
    last, prefix, held = fresh(df.columns, "_last", "_prefix", "_held")
    hash_ = shuffle_hash(F.col(key), seed)
    narrow = df.select(null_safe(F.col(stratum)).alias("s"), hash_.alias("h"), F.col(key).alias("k")).withColumn("b", F.substring("h", 1, digits))
    whole = Window.partitionBy("s")
    before = whole.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    counts = narrow.groupBy("s", "b").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    counts = counts.withColumn("quota", F.greatest(F.lit(1), F.bround(F.sum("n").over(whole) * F.lit(frac))).cast("bigint"))
    starts, small = materialize_measured(counts.filter("start < quota").select("s", "b", "start", "quota"), "split-starts")
    inside = Window.partitionBy("s", "b").orderBy("h", "k")
    ranked = join_measured(narrow, starts, small, ["s", "b"], ["k"]).withColumn("r", F.col("start") + F.row_number().over(inside) - 1)
    chosen, few = materialize_measured(ranked.filter("r < quota").select(F.col("k").alias(key), F.col("r").alias(rank)), "holdout-places")
    if few:
        return df.join(F.broadcast(chosen), key).select(*df.columns, rank)
    bounds = starts.groupBy(F.col("s").alias(held)).agg(F.max("b").alias(last))
    rows = df.withColumns({held: null_safe(F.col(stratum)), prefix: F.substring(hash_, 1, digits)})
    near = lookup_join(rows, bounds, [held], [key], label="split-cuts").filter(F.col(prefix) <= F.col(last))
    return near.join(chosen, key).select(*df.columns, rank)


def shuffled(df: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """Rows in a seeded order, by range partitioning; a second salt keeps it apart from the split."""
    return df.orderBy(shuffle_hash(F.col(key), seed + 1), key)


def split_counts(split_df: DataFrame, stratum: str = "endpoint") -> DataFrame:
    """Train and holdout records per stratum with the holdout share; nothing is written."""
    return (
        split_df.groupBy(stratum)
        .agg(
            F.count_if(F.col("split") == "train").alias("n_train"),
            F.count_if(F.col("split") == "holdout").alias("n_holdout"),
        )
        .withColumn("holdout_share", F.col("n_holdout") / (F.col("n_train") + F.col("n_holdout")))
    )


def training_plan(counts: DataFrame) -> DataFrame:
    """One row of training settings per stratum of :func:`split_counts`."""
    return counts.withColumns(
        {**plan_columns(F.col("n_train")), **{k: F.lit(v) for k, v in PLAN_CONSTANTS.items()}}
    )


def by_name(df: DataFrame, col: str) -> DataFrame:
    return df.orderBy(col)
