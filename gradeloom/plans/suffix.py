"""Suffix minima over time without a sort of a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.plans.once import fresh
from gradeloom.plans.skew import materialize

#: Children of a tree node at most: 2 ** BITS places. A group with no more points than that is one node.
BITS = 12


def suffix_minimum(points: DataFrame, group: str, at: str, value: Column, out: str, bits: int = BITS) -> DataFrame:
    """``points`` with ``out``: the least ``value`` among the points of the group at its own place or a later one.

    ``points`` has one row per group and ``at`` (a bigint, not null); null values do not count. Places are the leaves of a
    tree in which a node has the places with the same leading bits. Within a node, minima are taken over its children alone,
    at most ``2 ** bits`` rows; the node's own minimum is then one child of the next node. Levels are added until no group
    has more rows than that, so their number follows the counts: one for small groups, six at most.
    """
    node, low, later, up, above = fresh(points.columns, "node", "low", "later", "up", "above")
    levels = [materialize(points.withColumn(node, F.col(at)).withColumn(low, value), "suffix")]
    while _larger(levels[-1], group, bits):
        parents = levels[-1].groupBy(group, F.shiftright(node, bits).alias(node)).agg(F.min(low).alias(low))
        levels.append(materialize(parents, "suffix"))
    # From the root down: what lies later in the node, or in what follows the node.
    known: DataFrame | None = None
    for level in reversed(levels):
        inside = Window.partitionBy(group, up).orderBy(F.col(node).desc()).rowsBetween(Window.unboundedPreceding, -1)
        rows = level.withColumn(up, F.shiftright(node, bits) if known is not None else F.lit(0).cast("bigint"))
        rows = rows.withColumn(later, F.min(low).over(inside))
        if known is not None:
            after = known.select(F.col(group), F.col(node).alias(up), F.col(later).alias(above))
            rows = rows.join(after, [group, up], "left").withColumn(later, F.least(later, above)).drop(above)
        known = rows
    return known.withColumn(out, F.least(low, later)).select(*points.columns, out)


def _larger(level: DataFrame, group: str, bits: int) -> bool:
    """Whether a group has more rows than a node may have children."""
    return not level.groupBy(group).count().filter(F.col("count") > 2**bits).isEmpty()
