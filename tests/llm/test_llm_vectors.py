import math
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeloom.llm import cover_tree, fagin

SCHEMA = "vec_id bigint, embedding array<float>, label int, rank string, score string, component_id string"
ODD = [
    (900, None, 1), (920, [1.0, None, 0.0], 1), (940, [1.0, float("nan"), 0.0], 1), (960, [1.0, float("inf"), 0.0], 1),
    (980, [0.0, 0.0, 0.0], 1), (1000, [1.0, 2.0], 1), (1001, [1.0, 2.0], 1), (1020, [0.5, 0.5, 0.5], None), (None, [1.0, 1.0, 1.0], 1),
    (1040, [], 1),
]


def table(spark, data):
    return spark.createDataFrame([(i, v, l, "x", "y", "z") for i, v, l in data], SCHEMA)


def made(n=160, seed=1):
    rnd = np.random.default_rng(seed)
    base = rnd.standard_normal((n // 8, 3))
    values = [base[rnd.integers(len(base))] + rnd.standard_normal(3) * 0.05 for _ in range(n)]
    data = [(i, [float(np.float32(x)) for x in v], int(i % 3 == 0)) for i, v in enumerate(values)]
    return data + [(n + i, data[i][1], data[i][2]) for i in range(20)]


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(fagin, "BLOCK_ROWS", 50)
    monkeypatch.setattr(fagin, "QUERY_ROWS", 4)
    monkeypatch.setattr(fagin, "FIRST_DEPTH", 2)
    data = made() + ODD
    vectors = table(spark, data)
    got = {}
    for r in fagin.top_k(vectors, vectors.filter("vec_id % 20 = 0"), k=7).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    whole = {i: [math.floor(64 * x) for x in v] for i, v, _ in data if i is not None and usable(v)}
    assert set(got) == {q for q in whole if q % 20 == 0 and sum(len(v) == len(whole[q]) for v in whole.values()) > 1}
    for q, found in got.items():
        scores = [(-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q])]
        assert [found[r] for r in sorted(found)] == [(i, -s) for s, i in sorted(scores)[:7]]


def test_search_stops_early_and_is_exact():
    rnd = np.random.default_rng(2)
    rows = rnd.integers(-5, 6, (3000, 3)).astype(float)
    rows[17] = [500, 400, 300]
    rows[99] = [500, 400, 300]
    ids = np.arange(3000)[::-1].copy()
    lists = np.argsort(rows, axis=0, kind="stable").T
    at, score, depth = fagin.threshold_search(lists, rows, ids, np.array([2.0, 1.0, 0.0]), -1, 2)
    assert ids[at].tolist() == [2900, 2982] and score.tolist() == [1400.0, 1400.0] and depth < 100
    for _ in range(30):
        q = rnd.integers(-4, 5, 3).astype(float)
        at, score, _ = fagin.threshold_search(lists, rows, ids, q, 5, 10)
        want = sorted((-s, i) for s, i in zip((rows @ q).tolist(), ids.tolist(), strict=True) if i != 5)[:10]
        assert list(zip((-score).tolist(), ids[at].tolist(), strict=True)) == want


@pytest.mark.parametrize("size", [2.0**20, 2.0**24, 2.0**30, 2.0**60])
def test_large_components_take_part_exactly(spark, size):
    # One row's score is the query's size, another one's larger by 1, which doubles of that size do not show.
    data = [(0, [size, 1 / 64, 0.0]), (1, [size / 2, 1 / 64, 0.0]), (2, [size / 2, 2 / 64, 0.0]), (3, [0.5, 0.0, 0.0]), (4, [-size, 3 / 64, 0.0])]
    vectors = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    whole = {i: [math.floor(64 * x) for x in v] for i, v in data}
    scores = sorted((-sum(a * b for a, b in zip(whole[0], whole[i], strict=True)), i) for i in whole if i)
    found = fagin.top_k(vectors, vectors.filter("vec_id = 0"), k=4)
    # Beyond 64 bits a score counts as the last number that fits.
    cut = sorted((max(min(s, 1 << 63), 1 - (1 << 63)), i) for s, i in scores)
    assert [(r.vec_id, r.score) for r in sorted(found.collect(), key=lambda r: r["rank"])] == [(i, min(-s, (1 << 63) - 1)) for s, i in cut]


def test_one_huge_vector_leaves_the_others_to_the_lists(spark, monkeypatch):
    data = [(i, v) for i, v, _ in made() if usable(v)][:60]
    huge = [(10_000, [1e300, 0.0, 0.0]), (10_001, [-1e308] * 3), (10_002, [0.25, 0.25, 2.0**40])]
    vectors = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in data] + huge, "vec_id bigint, embedding array<double>")
    asked = [i for i, _ in data[:5]] + [10_000]
    got = fagin.top_k(vectors, vectors.filter(F.col("vec_id").isin(*asked)), k=12).collect()
    whole = {i: [math.floor(64 * x) if abs(x) < 1e306 else int(math.copysign(sys.float_info.max, x)) for x in map(float, v)] for i, v in [*data, *huge]}
    for q in asked:
        score = lambda i: max(min(sum(a * b for a, b in zip(whole[q], whole[i], strict=True)), (1 << 63) - 1), -(1 << 63))  # noqa: E731, B023
        want = sorted((-score(i), i) for i in whole if i != q)[:12]
        assert [(r.vec_id, r.score) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == [(i, -s) for s, i in want]


def test_top_k_of_nothing(spark):
    vectors = table(spark, made())
    assert fagin.top_k(vectors.limit(0), vectors).count() == 0 and fagin.top_k(vectors, vectors.limit(0)).count() == 0


def brute_links(data, cosine):
    n = len(data)
    linked = [set() for _ in range(n)]
    for a in range(n):
        for b in range(a):
            (_, u, x), (_, v, y) = data[a], data[b]
            if x is not None and x == y and usable(u) and usable(v) and len(u) == len(v) and any(u) and any(v):
                if np.dot(u, v) / (np.linalg.norm(u) * np.linalg.norm(v)) >= cosine:
                    linked[a].add(b)
                    linked[b].add(a)
    root = list(range(n))
    for start in sorted(range(n), key=lambda i: data[i][0]):
        if root[start] == start and not any(root[j] != j for j in linked[start]):
            todo = [start]
            while todo:
                for j in linked[todo.pop()]:
                    if root[j] == j and j != start:
                        root[j] = start
                        todo.append(j)
    return {data[i][0]: (len(linked[i]), data[root[i]][0]) for i in range(n)}


def test_near_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "CHUNK_ROWS", 20)
    data = [r for r in made() + ODD if r[0] is not None]
    got = {r.vec_id: (r.n_links, r.component_id) for r in cover_tree.near_vectors(table(spark, data), 0.999).collect()}
    assert got == brute_links(data, 0.999) and any(n for n, _ in got.values())


def test_repeated_rows_and_nulls(spark):
    data = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (None, [1.0, 0.0], 0), (3, [1.0, 0.0], 1)]
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in cover_tree.near_vectors(table(spark, data)).collect())
    assert got == [(0, 0, 0, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]
    assert cover_tree.near_vectors(table(spark, data).limit(0)).count() == 0


@pytest.mark.parametrize("spread", [0.0, 1e-9, 0.02, 0.3, 2.0])
def test_dual_traversal(spread):
    rnd = np.random.default_rng(4)
    x = np.array([1.0, 0, 0, 0]) + rnd.standard_normal((150, 4)) * spread
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    weight = rnd.integers(1, 4, 150).astype(float)
    tree = cover_tree.Tree(unit)
    for _, radius, children, rows in tree.nodes:
        assert all(tree.radii[c] <= radius / 2 + 1e-12 for c in children)
        assert not len(children) or sorted(np.concatenate([tree.nodes[c][3] for c in children])) == sorted(rows)
    links = unit @ unit.T >= 0.98
    np.fill_diagonal(links, False)
    left, right, a, b = cover_tree.dual_links(tree, tree, True, 0.98, weight, weight)
    assert (left + right == links @ weight).all()
    edges = (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, int), np.zeros(0, int))
    i, j = np.nonzero(links)
    assert (cover_tree.roots(150, *edges) == cover_tree.roots(150, i, j)).all()
    one, two = cover_tree.Tree(unit[:70]), cover_tree.Tree(unit[70:])
    left, right, _, _ = cover_tree.dual_links(one, two, False, 0.98, weight[:70], weight[70:])
    assert (left == links[:70, 70:] @ weight[70:]).all() and (right == links[70:, :70] @ weight[:70]).all()


def test_pivots_are_cut_before_the_shuffle(spark):
    data = [(i // 2, [float(i), 1.0], i % 3, 2) for i in range(900)]
    classes = spark.createDataFrame(data, "rep bigint, v array<float>, label int, dim int")
    picked = cover_tree.first_by_hash(classes, ["label", "dim"])
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    rows = picked.collect()
    assert len(rows) == 3 * cover_tree.MOST_PIVOTS and len({(r.label, r.place) for r in rows}) == len(rows)


@pytest.mark.parametrize("share", [0.0, 0.02, 0.1, 0.6, 1.0])
def test_few_edges_connect_what_links_connect(share):
    rng = np.random.default_rng(int(share * 100))
    for rows, columns in ((0, 3), (1, 1), (12, 9), (40, 64)):
        linked = rng.random((rows, columns)) < share
        i, j = cover_tree.spanning(linked)
        assert len(i) == len(j) <= rows + columns
        every = cover_tree.roots(rows + columns, np.nonzero(linked)[0], np.nonzero(linked)[1] + rows)
        assert (cover_tree.roots(rows + columns, i, j + rows) == every).all()


@pytest.mark.parametrize(("chunk", "pivots", "levels"), [(8, 3, 8), (8, 3, 2), (4, 2, 3), (16, 64, 1)])
def test_links_do_not_depend_on_levels(spark, monkeypatch, chunk, pivots, levels):
    monkeypatch.setattr(cover_tree, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(cover_tree, "MOST_PIVOTS", pivots)
    monkeypatch.setattr(cover_tree, "MOST_LEVELS", levels)
    data = made(seed=levels) + ODD
    vectors = table(spark, data)
    monkeypatch.setattr(cover_tree, "LEAF", 3)
    got = sorted((r.vec_id or -1, r.n_links, r.component_id or -1) for r in cover_tree.near_vectors(vectors, 0.99).collect())
    monkeypatch.undo()
    assert got == sorted((r.vec_id or -1, r.n_links, r.component_id or -1) for r in cover_tree.near_vectors(vectors, 0.99).collect())
    assert sum(n for _, n, _ in got) > 200


def test_pairs_of_cells_grow_with_the_clusters(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "CHUNK_ROWS", 16)
    monkeypatch.setattr(cover_tree, "MOST_PIVOTS", 8)
    found = []
    for clusters in (16, 64):
        rnd = np.random.default_rng(4)
        centres = rnd.standard_normal((clusters, 24))
        points = np.repeat(centres, 48, axis=0) + rnd.standard_normal((clusters * 48, 24)) * 0.01
        classes = spark.createDataFrame([(i, 1, 0, 24, [float(x) for x in v]) for i, v in enumerate(points)], "rep bigint, copies bigint, label int, dim int, v array<float>")
        rows, cells, pairs = cover_tree._upper_levels(classes, ["label", "dim"], math.sqrt(2 - 2 * 0.98))
        assert rows.count() == clusters * 48 and cells.agg({"n": "max"}).first()[0] <= 32 and cells.agg({"n": "sum"}).first()[0] == clusters * 48
        n = cells.count()
        found.append((n, pairs.count()))
    (few, few_pairs), (many, many_pairs) = found
    # Four times the cells: without pruning the pairs would be sixteen times as many.
    assert many > 3 * few and many_pairs < 8 * few_pairs and many_pairs < many * many / 8
