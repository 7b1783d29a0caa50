"""Exact top-k inner products by the threshold algorithm over sorted lists per dimension.

Candidates are divided by hash into blocks of about ``BLOCK_ROWS``, queries into blocks of about ``QUERY_ROWS``; each pair of
blocks is one task's group, so a group is bounded whatever the table's size. Inside, every dimension has its candidates
in sorted order. A query reads the lists of its non-zero components from their better end, scores what it meets for the
first time, and stops when the sum of what could still come next in every list is below its kth score. The best ``k`` of the
blocks are ranked together.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.vectors import usable

BLOCK_ROWS, QUERY_ROWS = 4_096, 2_048
SCALE = 64
#: Scores below the first are exact in doubles, below the second in 64 bits.
IN_DOUBLES, IN_LONGS = 1 << 53, 1 << 63
FIRST_DEPTH, DEEPER = 32, 4


def threshold_search(lists: np.ndarray, rows: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Positions and scores of the best ``k`` rows (ties to the smaller id), and how deep the lists were read.

    ``lists[i]`` holds the rows by ascending component ``i``. Scores are whole numbers that the type of ``rows`` holds exactly.
    """
    n = len(rows)
    dims = np.flatnonzero(query)
    weight = query[dims]
    if not len(dims):  # every score is 0
        best = np.flatnonzero(ids != own)
        best = best[np.argsort(ids[best], kind="stable")][:k]
        return best, np.zeros(len(best), rows.dtype), n
    rising = weight > 0
    seen = ids == own
    at = np.zeros(0, dtype=np.int64)
    score = np.zeros(0, rows.dtype)
    depth, step = 0, FIRST_DEPTH
    while depth < n:
        stop = min(n, depth + step)
        ahead = np.concatenate([lists[dims[rising], n - stop : n - depth].ravel(), lists[dims[~rising], depth:stop].ravel()])
        new = np.zeros(n, dtype=bool)
        new[ahead] = True
        new = np.flatnonzero(new & ~seen)
        seen[new] = True
        at = np.concatenate([at, new])
        score = np.concatenate([score, (rows @ query)[new] if len(new) * 8 > n else rows[new] @ query])
        if len(at) > k:
            good = np.flatnonzero(score >= np.partition(score, -k)[-k])  # with ties for the last place
            keep = good[np.lexsort((ids[at[good]], -score[good]))[:k]]
            at, score = at[keep], score[keep]
        if seen.all():
            depth = stop
            break
        depth, step = stop, step * DEEPER
        last = np.where(rising, lists[dims, n - depth], lists[dims, depth - 1])
        if len(at) == k and score.min() > weight @ rows[last, dims]:
            break
    order = np.lexsort((ids[at], -score))
    return at[order], score[order], depth


def exact_search(rows: list[list[int]], ids: np.ndarray, query: list[int], own: int, k: int) -> tuple[np.ndarray, list[int]]:
    """Positions and scores of the best ``k`` rows, in integers of any size; scores end where 64 bits do."""
    every = ((i, sum(a * b for a, b in zip(row, query, strict=True))) for i, row in enumerate(rows) if ids[i] != own)
    scores = {i: max(min(score, IN_LONGS - 1), -IN_LONGS) for i, score in every}
    at = sorted(scores, key=lambda i: (-scores[i], ids[i]))[:k]
    return np.array(at, dtype=np.int64), [scores[i] for i in at]


def whole_numbers(rows: np.ndarray) -> list[list[int]]:
    return [[int(x) for x in row] for row in rows.tolist()]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, vec: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` highest inner products (all, if there are fewer).

    Components are ``floor(64 * x)``. Ties go to the smaller id; rows with the query's id are its own and no candidates.
    Scores are exact whatever the size of the components; one that does not fit 64 bits counts as the largest or smallest
    number that does.
    Vectors that are null, or hold null, infinite or missing numbers, take no part, nor do rows without id; vectors are compared with those of their own length. A candidate id that repeats is a candidate each
    time; a query id that repeats is asked once. Empty tables give an empty result; other columns are not read.
    """

    def whole(rows: DataFrame) -> DataFrame:
        rows = usable(rows.select(F.col(vec).cast("bigint").alias("vec_id"), F.col(embedding).alias("v")), "v")
        rows = rows.filter(F.col("vec_id").isNotNull() & (F.size("v") > 0))
        # Whole numbers in doubles, which hold components of any size: rint() of a double stays one, floor() does not.
        scaled = F.transform("v", lambda x: x.cast("double") * SCALE)
        whole = F.transform(scaled, lambda x: F.rint(x) - F.when(F.rint(x) > x, 1.0).otherwise(0.0))
        return rows.select("vec_id", whole.alias("v"), F.size("v").alias("dim"))

    candidates, asked = whole(vectors), whole(queries).dropDuplicates(["vec_id"])
    sizes = candidates.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    asking = asked.groupBy("dim").agg(F.count(F.lit(1)).alias("m"))
    blocks = sizes.join(asking, "dim").select(
        "dim", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("cs"), F.ceil(F.col("m") / QUERY_ROWS).cast("int").alias("qs")
    )
    # One row per vector length that occurs.
    blocks = F.broadcast(blocks)

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("vec_id"), F.col(f"{own}s")).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)).alias(other)
        return rows.join(blocks, "dim").select("dim", mine, "vec_id", "v", every, F.lit(own == "q").alias("asks")).select("dim", "c", "q", "asks", "vec_id", "v")

    def search(part: pd.DataFrame) -> pd.DataFrame:
        asks = part["asks"].to_numpy()
        ids = part["vec_id"].to_numpy()
        values = np.nan_to_num(np.stack(part["v"].to_numpy()).astype(np.float64))  # 64 * x may be too much for a double
        own, rows = ids[~asks], values[~asks]
        found = {"query_id": [], "vec_id": [], "score": []}
        if len(rows):
            # Rows with components so large that a product could leave 64 bits are few and looked at one by one.
            limit = isqrt((IN_LONGS - 1) // rows.shape[1])
            usual = np.abs(rows).max(axis=1) <= limit
            odd, odd_ids = whole_numbers(rows[~usual]), own[~usual]
            rows, own = rows[usual], own[usual]
            lists = np.argsort(rows, axis=0, kind="stable").T
            largest = rows.shape[1] * int(np.abs(rows).max(initial=0))
            longs, every = None, None
            for query_id, query in zip(ids[asks].tolist(), values[asks], strict=True):
                top = int(np.abs(query).max())
                if top > limit:
                    every = whole_numbers(rows) if every is None else every
                    at, score = exact_search(every, own, [int(x) for x in query.tolist()], query_id, k)
                elif largest * top < IN_DOUBLES:
                    at, score, _ = threshold_search(lists, rows, own, query, query_id, k)
                else:
                    longs = rows.astype(np.int64) if longs is None else longs
                    at, score, _ = threshold_search(lists, longs, own, query.astype(np.int64), query_id, k)
                best = list(zip([int(x) for x in score], own[at].tolist(), strict=True))
                if odd:
                    at, score = exact_search(odd, odd_ids, [int(x) for x in query.tolist()], query_id, k)
                    best = sorted([*best, *zip(score, odd_ids[at].tolist(), strict=True)], key=lambda r: (-r[0], r[1]))[:k]
                found["query_id"].append(np.full(len(best), query_id))
                found["vec_id"].append(np.array([r[1] for r in best], dtype=np.int64))
                found["score"].append(np.array([r[0] for r in best], dtype=np.int64))
        return pd.DataFrame({name: np.concatenate(x) if x else np.zeros(0, np.int64) for name, x in found.items()})

    both = dealt(candidates, "c", "q").unionByName(dealt(asked, "q", "c"))
    best = both.groupBy("dim", "c", "q").applyInPandas(search, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
