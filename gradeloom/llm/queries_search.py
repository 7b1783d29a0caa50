"""Query of the exact search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gradeloom.llm import fagin
from gradeloom.llm.registry import query

BEST = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 20
"""


@query("op1_fagin", BEST)
def op1_fagin(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 best inner products of every vector whose id is divisible by 20, among all others."""
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    return fagin.top_k(vectors, vectors.filter("vec_id % 20 = 0"), k=20)
