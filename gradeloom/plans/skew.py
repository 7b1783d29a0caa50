"""Joins and rankings that hold when one key carries a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

from gradeloom.session import scratch_path

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024
SALTS = 16
HOT_ROWS = 1_000_000


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a derived table to the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, and gives the planner real sizes.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(rows: int, size: int) -> bool:
    """Whether a table of that many rows and bytes may be copied to every executor."""
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def _row_width(schema: StructType) -> Column:
    """Approximate bytes of a row."""
    varying = (StringType, StructType, ArrayType, MapType)
    sizes = [
        F.octet_length(f.name if isinstance(f.dataType, StringType) else F.to_json(F.struct(f.name)))
        for f in schema
        if isinstance(f.dataType, varying)
    ]
    return sum((F.coalesce(size, F.lit(0)) for size in sizes), F.lit(16 * len(schema)))


def materialize_measured(df: DataFrame, label: str) -> tuple[DataFrame, bool]:
    """:func:`materialize`, and whether the table fits a broadcast; measured while it is written."""
    seen = Observation()
    measured = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(_row_width(df.schema)).alias("size"))
    table = materialize(measured, label)
    return table, fits_broadcast(seen.get["rows"], seen.get["size"] or 0)


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    salt_by: Sequence[str],
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join whose big side spreads each key over several partitions.

    ``salt_by`` names columns that differ between the rows of one key. The salt is a hash of
    them rather than a random number, so a task run again sends its rows to the same place.
    The small side (one row per key) is repeated once per salt.
    """
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)))
    right = small.withColumn("_salt", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(salts)])))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def hot_key_join(big: DataFrame, other: DataFrame, key: str, salt_by: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """:func:`counted_join`, inner, on one key."""
    return counted_join(big, other, [key], salt_by, hot_rows=hot_rows)


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    salt_by: Sequence[str],
    how: str = "inner",
    label: str = "lookup",
) -> DataFrame:
    """Join a derived per-key table: it is stored, and broadcast if its size allows, else salted."""
    table, fits = materialize_measured(small, label)
    return join_measured(big, table, fits, on, salt_by, how)


def join_measured(
    big: DataFrame, table: DataFrame, fits: bool, on: Sequence[str], salt_by: Sequence[str], how: str = "inner"
) -> DataFrame:
    """:func:`lookup_join` with a table of :func:`materialize_measured`."""
    if fits:
        return big.join(F.broadcast(table), list(on), how)
    return counted_join(big, table, on, salt_by, how)


def counted_join(
    big: DataFrame, other: DataFrame, on: Sequence[str], salt_by: Sequence[str], how: str = "inner", hot_rows: int | None = None
) -> DataFrame:
    """Join of two large sides, ``other`` having one row per key, inner or left.

    Keys of ``big`` with more than ``hot_rows`` rows are counted first and divided by a salt into pieces of about that size;
    the row of ``other`` is repeated only for them, once per piece. So the number of pieces follows the counts, and without
    such keys this is a plain join.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    counts = big.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    pieces = F.ceil(F.col("_n") / F.lit(float(hot_rows))).cast("bigint")
    hot, small = materialize_measured(counts.select(*on, pieces.alias("_pieces")), "hot-keys")
    if hot.isEmpty():
        return big.join(other, list(on), how)
    if not small:
        return salted_join(big, other, on, salt_by, how)
    n = F.coalesce(F.col("_pieces"), F.lit(1).cast("bigint"))
    left = big.join(F.broadcast(hot), list(on), "left").withColumn("_salt", F.pmod(F.xxhash64(*salt_by), n))
    right = other.join(F.broadcast(hot), list(on), "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)))
    return left.drop("_pieces").join(right.drop("_pieces"), [*on, "_salt"], how).drop("_salt")


def shuffle_hash(key: Column, seed: int) -> Column:
    """Position of a record in a seeded shuffle: independent of partitioning and of order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def null_safe(key: Column) -> Column:
    """A text key that is never null: a null group is a group too, and joins would lose it."""
    return F.coalesce(key.cast("string"), F.lit("\0"))


def bucketed_rank(df: DataFrame, group: str, hash_col: str, key: str, out: str, bucket_rows: int = 50_000) -> DataFrame:
    """Zero-based rank by ``(hash, key)`` within a group, never sorting a large group in one task.

    Groups above ``bucket_rows`` are divided by leading hash digits into buckets of about
    that size. Rows are ranked inside their bucket; each bucket starts at the count of the
    buckets before it.
    """
    keyed = df.withColumn("_g", null_safe(F.col(group)))
    excess = F.col("_n") / F.lit(float(bucket_rows))
    digits = F.greatest(F.lit(0), F.ceil(F.log(16.0, excess))).cast("int")
    sizes = keyed.groupBy("_g").agg(F.count(F.lit(1)).alias("_n")).select("_g", digits.alias("_digits"))
    divided = lookup_join(keyed, sizes, ["_g"], [key], label="group-sizes")
    bucketed = divided.withColumn("_bucket", F.substring(F.col(hash_col), F.lit(1), F.col("_digits"))).drop("_digits")
    before = Window.partitionBy("_g").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        bucketed.groupBy("_g", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_g", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    placed = lookup_join(bucketed, starts, ["_g", "_bucket"], [key], label="bucket-starts")
    inside = Window.partitionBy("_g", "_bucket").orderBy(hash_col, key)
    return placed.withColumn(out, (F.col("_start") + F.row_number().over(inside) - 1).cast("bigint")).select(*df.columns, out)


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per group.

    A rank with an upper bound is limited before the shuffle as well, so a hot group sends
    at most ``k`` rows per map task.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)
