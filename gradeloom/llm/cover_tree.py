"""Exact pairs of near vectors by cover trees traversed in pairs.

Cosine ``c`` of unit vectors is a distance ``sqrt(2 - 2c)``, for which balls can be bounded. The upper levels are Spark
tables: the vectors of a label are divided among their nearest pivots, cells of more than two chunks of ``CHUNK_ROWS`` again among
pivots of their own, and so on, each with its covering radius. Pairs of cells are opened level by level, and dropped when their
centres are further apart than both radii and the threshold. Each pair of chunks of the cells left at the end is one group: a cover tree of each is built (nested levels with halving
radii, every node's first child sharing its centre), and the trees are descended together. A pair of nodes too far
apart is dropped, one that lies wholly within the threshold is counted without looking at its vectors, and only the
rest is opened. Groups return counts and a spanning set of links, never all links.
"""

from __future__ import annotations

from math import sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.components import connected_components
from gradeloom.llm.vectors import is_usable
from gradeloom.plans.skew import hot_key_join, join_measured, materialize, materialize_measured, top_k

CHUNK_ROWS = 2_048
MOST_PIVOTS = 64
#: Levels of cells at most; what is larger than a chunk then is dealt into chunks by hash.
MOST_LEVELS = 8
LEAF = 24
#: Distances closer than this to a bound are not decided by it.
MARGIN = 1e-6


class Tree:
    """Cover tree of the rows of ``unit``; ``nodes[i]`` is (centre row, covering radius, children, rows)."""

    def __init__(self, unit: np.ndarray):
        self.unit = unit
        self.nodes: list[tuple[int, float, np.ndarray, np.ndarray]] = []
        self.centres = np.zeros(0, dtype=np.int64)
        self.radii = np.zeros(0)
        if len(unit):
            rows = np.arange(len(unit))
            self._build(0, rows, self._distances(0, rows))
        self.centres = np.array([n[0] for n in self.nodes], dtype=np.int64)
        self.radii = np.array([n[1] for n in self.nodes])

    def _distances(self, centre: int, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 - 2 * (self.unit[rows] @ self.unit[centre]), 0))

    def _build(self, centre: int, rows: np.ndarray, distance: np.ndarray) -> int:
        """Node of ``rows`` around ``centre``; its children cover it with half its radius."""
        me = len(self.nodes)
        radius = float(distance.max())
        self.nodes.append((centre, radius, np.zeros(0, dtype=np.int64), rows))
        if len(rows) <= LEAF or radius <= MARGIN:
            return me
        children, at = [], centre
        while len(rows):
            near = distance <= radius / 2
            children.append(self._build(at, rows[near], distance[near]))
            rows = rows[~near]
            if len(rows):
                # The row furthest from the last centre starts the next ball.
                at = int(rows[np.argmax(distance[~near])])
                distance = self._distances(at, rows)
        self.nodes[me] = (centre, radius, np.array(children), self.nodes[me][3])
        return me


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number that each of ``n`` nodes reaches over the edges ``(a, b)``."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def spanning(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of a few edges that connect what the links in a matrix connect: one per row and column at most."""
    rows, columns = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    part = linked[np.ix_(rows, columns)]
    none = len(rows)
    label = np.arange(none)
    while True:
        of_column = np.where(part, label[:, None], none).min(axis=0, initial=none)
        new = np.where(part, of_column[None, :], none).min(axis=1, initial=none)
        if (new == label).all():
            break
        label = new
    # A component's hubs: the first of its rows, and a column linked with that one.
    hub = np.argmax(part[label], axis=1) if none else np.zeros(0, dtype=np.int64)
    return np.concatenate([rows, rows[of_column]]), np.concatenate([columns[hub], columns])


def dual_links(left: Tree, right: Tree, same: bool, cosine: float, weight_l: np.ndarray, weight_r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list, list]:
    """Weighted number of links of each left and right row, and edges (left row, right row) that connect the linked ones.

    With ``same``, both trees are one, and a row is not linked with itself.
    """
    reach = sqrt(max(2 - 2 * cosine, 0))
    count_l, count_r = np.zeros(len(left.unit)), np.zeros(len(right.unit))
    ends_l: list[np.ndarray] = []
    ends_r: list[np.ndarray] = []
    todo = [(0, 0)] if left.nodes and right.nodes else []
    while todo:
        p, q = todo.pop()
        _, radius_p, children_p, rows_p = left.nodes[p]
        _, radius_q, children_q, rows_q = right.nodes[q]
        if not len(children_p) and not len(children_q):
            cosines = left.unit[rows_p] @ right.unit[rows_q].T
            linked = cosines >= cosine
            if same:
                linked &= rows_p[:, None] < rows_q[None, :] if p == q else True
            i, j = spanning(linked)
            count_l[rows_p] += linked @ weight_r[rows_q]
            count_r[rows_q] += linked.T @ weight_l[rows_p]
            ends_l.append(rows_p[i])
            ends_r.append(rows_q[j])
            continue
        ps = children_p if len(children_p) and (radius_p >= radius_q or not len(children_q)) else np.array([p])
        qs = children_q if len(children_q) and (radius_q >= radius_p or not len(children_p)) else np.array([q])
        if same and p == q:
            ps = qs = children_p
        apart = np.sqrt(np.maximum(2 - 2 * (left.unit[left.centres[ps]] @ right.unit[right.centres[qs]].T), 0))
        both = left.radii[ps][:, None] + right.radii[qs][None, :]
        open_ = apart - both <= reach + MARGIN
        inside = apart + both <= reach - MARGIN
        if same and p == q:
            upper = np.arange(len(ps))[:, None] <= np.arange(len(qs))[None, :]
            open_, inside = open_ & upper, inside & (np.arange(len(ps))[:, None] < np.arange(len(qs))[None, :])
        for i, j in zip(*np.nonzero(inside), strict=True):
            a, b = left.nodes[ps[i]][3], right.nodes[qs[j]][3]
            count_l[a] += weight_r[b].sum()
            count_r[b] += weight_l[a].sum()
            ends_l += [a, np.full(len(b), a[0])]
            ends_r += [np.full(len(a), b[0]), b]
        i, j = np.nonzero(open_ & ~inside)
        todo += list(zip(ps[i].tolist(), qs[j].tolist(), strict=True))
    return count_l, count_r, ends_l, ends_r


def _group(part: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links between the two chunks of a group, or inside its one chunk."""
    ids, copies = part["rep"].to_numpy(), part["copies"].to_numpy(dtype=np.float64)
    values = np.stack(part["v"].to_numpy()).astype(np.float64)
    # Scaled first, so that no square overflows or vanishes.
    values /= np.abs(values).max(axis=1, keepdims=True)
    unit = values / np.sqrt((values * values).sum(axis=1, keepdims=True))
    first = ~part["second"].to_numpy()
    at_l, at_r = np.flatnonzero(first), np.flatnonzero(~first)
    same = not len(at_r)
    left = Tree(unit[at_l])
    right = left if same else Tree(unit[at_r])
    at_r = at_l if same else at_r
    count_l, count_r, ends_l, ends_r = dual_links(left, right, same, cosine, copies[at_l], copies[at_r])
    links = np.zeros(len(ids))
    np.add.at(links, at_l, count_l)
    np.add.at(links, at_r, count_r)
    a = at_l[np.concatenate(ends_l)] if ends_l else np.zeros(0, dtype=np.int64)
    b = at_r[np.concatenate(ends_r)] if ends_r else np.zeros(0, dtype=np.int64)
    root = roots(len(ids), a, b)
    some = links > 0
    return pd.DataFrame({"rep": ids[some], "links": links[some].astype(np.int64), "root": ids[root[some]]})


def _distance(a: str, b: str):
    """Between two unit vectors."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(F.lit(2.0) - F.lit(2.0) * dot, F.lit(0.0)))


def first_by_hash(classes: DataFrame, group: list[str]) -> DataFrame:
    """The group's columns, ``rep, v_hash, place``: the first ``MOST_PIVOTS`` classes of each group by hash; vectors are not dealt out."""
    narrow = classes.select(*group, "rep", F.xxhash64("v").alias("v_hash"))
    return top_k(narrow, group, [F.xxhash64("rep"), F.col("rep"), F.col("v_hash")], MOST_PIVOTS, "place")


def _divided(rows: DataFrame, group: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with ``cell`` and ``away``, the nearest of their group's pivots and the distance to it; and ``(group, cell, pivot)``.

    A group has a pivot for each chunk it is worth, up to ``MOST_PIVOTS``: vectors of its own, by hash.
    """
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    wanted = sizes.select(*group, F.least(F.ceil(F.col("n") / CHUNK_ROWS), F.lit(MOST_PIVOTS)).cast("int").alias("cells"))
    picked = first_by_hash(rows, group).join(wanted, group).filter(F.col("place") <= F.col("cells"))
    picked, few = materialize_measured(picked.select(*group, "rep", "v_hash", (F.col("place") - 1).alias("cell")), "picked")
    # An id that repeats stands for several classes; the hash of the vector tells them apart.
    pivots = join_measured(rows.withColumn("v_hash", F.xxhash64("v")), picked, few, [*group, "rep", "v_hash"], ["rep"])
    pivots = pivots.dropDuplicates([*group, "cell"])
    size = F.sqrt(F.aggregate("w", F.lit(0.0), lambda s, x: s + x * x))
    scaled = F.transform("v", lambda x: x.cast("double") / F.array_max(F.transform("v", lambda y: F.abs(y.cast("double")))))
    pivots = pivots.withColumn("w", scaled).withColumn("pivot", F.transform("w", lambda x: x / size)).select(*group, "cell", "pivot")
    pivots, few = materialize_measured(pivots, "pivots")
    listed = pivots.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("cell", "pivot"))).alias("pivots"))  # at most MOST_PIVOTS
    placed = join_measured(rows, listed, few, group, ["rep"])
    unit = placed.withColumn("w", scaled).withColumn("u", F.transform("w", lambda x: x / size)).drop("w")
    away = F.transform("pivots", lambda p: F.struct(
        F.sqrt(F.greatest(F.lit(2.0) - F.lit(2.0) * F.aggregate(F.zip_with("u", p["pivot"], lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x), F.lit(0.0))).alias("away"),
        p["cell"].alias("cell"),
    ))
    near = unit.withColumn("near", F.array_min(away))
    return near.select("rep", "copies", *group, "v", F.col("near.cell").alias("cell"), F.col("near.away").alias("away")), pivots


def _upper_levels(classes: DataFrame, label: list[str], reach: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The last cells of all levels: their rows ``(rep, copies, label, v, cell, away)``, ``(label, cell, pivot, n, radius)``, and the
    pairs ``(label, cell_a, cell_b, d)`` of them that may hold links.

    A cell is named by its path. A pair is opened into the pairs of both cells' children; a last cell stands for itself.
    """
    rows, by, leaves, pairs, ended = classes, label, [], None, []
    for level in range(MOST_LEVELS):
        placed, pivots = _divided(rows, by)
        path = F.concat_ws(".", *(["parent"] if level else []), F.col("cell").cast("string")).alias("cell")
        placed = materialize(placed.select("rep", "copies", *by, "v", path, "away"), "cells")
        nodes = placed.groupBy(*by, "cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius"))
        nodes = nodes.join(pivots.select(*by, path, "pivot"), [*by, "cell"]).withColumn("open", F.col("n") > 2 * CHUNK_ROWS)
        nodes, few = materialize_measured(nodes, "nodes")
        # A cell that could not be divided further is a last one as well.
        going_on = level + 1 < MOST_LEVELS and not nodes.filter("open").isEmpty()
        last = ~F.col("open") if going_on else F.lit(True)
        own = nodes.withColumn("last", last)
        marked = join_measured(placed, own.select(*label, "cell", "last"), few, [*label, "cell"], ["rep"])
        leaves.append(marked.filter("last").select("rep", "copies", *label, "v", "cell", "away"))

        here = own if level else own.withColumn("parent", F.lit(""))
        stay = [e.withColumn("parent", F.col("cell")) for e in ended]
        steps = here.select(*label, "parent", "cell", "pivot", "radius")
        for e in stay:
            steps = steps.unionByName(e.select(*label, "parent", "cell", "pivot", "radius"))
        one = steps.select(*label, *[F.col(c).alias(f"{c}_a") for c in ("parent", "cell", "pivot", "radius")])
        two = steps.select(*label, *[F.col(c).alias(f"{c}_b") for c in ("parent", "cell", "pivot", "radius")])
        if pairs is None:
            met = one.join(two, label).filter("cell_a <= cell_b")
        else:
            above = pairs.select(*label, F.col("cell_a").alias("parent_a"), F.col("cell_b").alias("parent_b"))
            met = above.join(one, [*label, "parent_a"]).join(two, [*label, "parent_b"])
            met = met.filter("parent_a <> parent_b OR cell_a <= cell_b")
        met = met.withColumn("d", _distance("pivot_a", "pivot_b")).filter(F.col("d") <= F.col("radius_a") + F.col("radius_b") + reach)
        ordered = [F.least("cell_a", "cell_b").alias("cell_a"), F.greatest("cell_a", "cell_b").alias("cell_b")]
        pairs = materialize(met.select(*label, *ordered, "d"), "cell-pairs")
        ended.append(own.filter("last").select(*label, "cell", "pivot", "n", "radius"))
        if not going_on:
            break
        opened = marked.filter("NOT last")
        rows, by = materialize(opened.select("rep", "copies", *label, F.col("cell").alias("parent"), "v"), "open-cells"), [*label, "parent"]
    celled, cells = leaves[0], ended[0]
    for more in leaves[1:]:
        celled = celled.unionByName(more)
    for more in ended[1:]:
        cells = cells.unionByName(more)
    return materialize(celled, "last-cells"), cells, pairs


def near_vectors(vectors: DataFrame, cosine: float = 0.98, vec: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """One row per row of ``vectors``: ``vec_id, n_links, component_id, kept``.

    Vectors of one label are linked when their cosine is at least ``cosine``, in double precision; ``n_links`` counts the
    other vectors linked directly, ``component_id`` is the smallest id reachable by links.

    A vector that is null, empty, zero, or holds null, infinite or missing numbers, or whose label or id is null, is linked
    with nothing; lengths are not mixed. Equal vectors of one label are compared as one and count each other. Rows that
    repeat an id count as further vectors and share its component. An empty table gives an empty result; other columns are
    not read.
    """
    rows = vectors.select(F.col(vec).cast("bigint").alias("vec_id"), F.col(label).alias("label"), F.col(embedding).alias("v"))
    part = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & is_usable(F.col("v")) & F.exists("v", lambda x: x != 0)
    part = F.coalesce(part, F.lit(False))
    valid = rows.filter(part)
    keyed = valid.select("vec_id", F.struct("label", F.size("v").alias("dim"), "v").alias("key"))
    classes = keyed.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = materialize(classes.select("rep", "copies", "key.*"), "classes")

    group = ["label", "dim"]
    celled, cells, near_cells = _upper_levels(classes, group, sqrt(max(2 - 2 * cosine, 0)) + MARGIN)
    cell = [*group, "cell"]
    cells, few_cells = materialize_measured(cells.withColumn("chunks", F.ceil(F.col("n") / CHUNK_ROWS).cast("int")), "cell-sizes")
    chunked = join_measured(celled, cells.select(*cell, "chunks"), few_cells, cell, ["rep"])
    chunked = chunked.withColumn("chunk", F.pmod(F.xxhash64("rep", F.lit(5)), F.col("chunks")).cast("int")).drop("chunks")
    chunked = materialize(chunked, "chunks")
    chunks = materialize(chunked.groupBy(*cell, "chunk").agg(F.max("away").alias("radius")), "chunk-radii")

    # What is left of the pairs of cells, by their chunks.
    reach = sqrt(max(2 - 2 * cosine, 0)) + MARGIN
    a = chunks.select(*group, F.col("cell").alias("cell_a"), F.col("chunk").alias("chunk_a"), F.col("radius").alias("ra"))
    b = chunks.select(*group, F.col("cell").alias("cell_b"), F.col("chunk").alias("chunk_b"), F.col("radius").alias("rb"))
    pairs = near_cells.join(a, [*group, "cell_a"]).join(b, [*group, "cell_b"])
    pairs = pairs.filter("cell_a < cell_b OR chunk_a <= chunk_b").filter(F.col("d") <= F.col("ra") + F.col("rb") + reach)
    pairs = materialize(pairs.select(*group, "cell_a", "chunk_a", "cell_b", "chunk_b"), "pairs")

    names = ["cell_a", "chunk_a", "cell_b", "chunk_b"]
    sides = []
    for side, second in (("a", False), ("b", True)):
        mine = pairs if not second else pairs.filter("cell_a <> cell_b OR chunk_a <> chunk_b")
        mine = mine.withColumn("cell", F.col(f"cell_{side}")).withColumn("chunk", F.col(f"chunk_{side}"))
        sides.append(chunked.join(mine, [*cell, "chunk"]).select(*group, *names, F.lit(second).alias("second"), "rep", "copies", "v"))
    met = sides[0].unionByName(sides[1]).groupBy(*group, *names)
    found = met.applyInPandas(lambda part: _group(part, cosine), "rep bigint, links bigint, root bigint")
    found = materialize(found, "found")

    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    nodes = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    summed = classes.select("rep", "copies", F.struct("label", "dim", "v").alias("key"))
    summed = summed.join(linked, "rep", "left").join(nodes.withColumnRenamed("node", "rep"), "rep", "left")
    summed = summed.select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    done = hot_key_join(keyed, summed, "key", ["vec_id"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~part).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return done.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

