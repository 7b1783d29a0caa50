"""Queries of the near-duplicate operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gradeloom.llm import cover_tree, minhash
from gradeloom.llm.registry import query


LINKED_TEXTS = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS shingles FROM w
), n AS (SELECT doc_id, len(shingles) AS n FROM s),
x AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM x a JOIN x b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT c.a, c.b FROM c JOIN n p ON p.doc_id = c.a JOIN n q ON q.doc_id = c.b WHERE 100 * shared >= 80 * (p.n + q.n - shared)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT n.doc_id, n.n AS n_shingles, m.component_id, n.doc_id = m.component_id AS kept FROM n JOIN least m ON n.doc_id = m.a
"""


@query("op8_minhash", LINKED_TEXTS)
def op8_minhash(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate groups of all documents: sets of 4-word shingles, similarity 0.8 or more."""
    found = minhash.near_duplicates(spark.read.parquet(f"{sf}/documents.parquet"), width=4, percent=80)
    return found.drop("text_key")


LINKED_VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding AS e, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS d FROM embeddings
), n AS (
  SELECT vec_id, label, d, sqrt(list_sum(list_transform(d, lambda x: x * x))) AS size FROM v
), ok AS (SELECT * FROM n WHERE size > 0 AND isfinite(size) AND label IS NOT NULL),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_sum(list_transform(list_zip(a.d, b.d), lambda z: z[1] * z[2])) / (a.size * b.size) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, m.component_id, e.vec_id = m.component_id AS kept
FROM embeddings e JOIN least m ON e.vec_id = m.a LEFT JOIN counted c ON e.vec_id = c.a
"""


@query("op3_cover_tree", LINKED_VECTORS)
def op3_cover_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate groups of all vectors: equal label, cosine 0.98 or more."""
    return cover_tree.near_vectors(spark.read.parquet(f"{sf}/embeddings.parquet"), cosine=0.98)
