"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gradeloom.plans.skew import materialize


def _stored(edges: DataFrame, files: int | None) -> tuple[DataFrame, tuple]:
    """The edges as a table in the shared folder, and a digest that tells whether they changed."""
    seen = Observation()
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("digest")
    edges = edges.coalesce(files) if files else edges
    table = materialize(edges.observe(seen, F.count(F.lit(1)).alias("rows"), digest), "components")
    return table, (seen.get["rows"], seen.get["digest"])


def connected_components(edges: DataFrame, files: int | None = None) -> DataFrame:
    """``node, component`` for every node of ``edges (a, b)``; the component is its smallest node.

    Rows with a null end, loops and repeated rows say nothing new; a node with loops alone is left out, as are nodes
    without edges. An empty table gives an empty result. Each round is a minimum per node and a join back to the edges,
    neither of which gathers a node's neighbours; rounds grow with the logarithm of the longest path. ``files`` is the
    number of files per round where the edges are known to be few.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    table, state = _stored(pairs.filter("a > b").distinct(), files)
    while state[0]:
        both = table.unionByName(table.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a > b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        ends = F.explode(F.array("a", "b"))
        small = large.join(least, "a").select(ends.alias("node"), "m").select(F.col("node").alias("a"), F.col("m").alias("b"))
        table, now = _stored(small.filter("a > b").distinct(), files)
        inner = table.select(F.col("b").alias("a")).join(table, "a", "left_semi")
        if now == state or inner.isEmpty():  # every node points to a root
            break
        state = now
    roots = table.select(F.col("b").alias("node")).distinct()
    return table.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
