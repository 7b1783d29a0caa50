"""Query of the filter audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gradeloom.llm import filter_audit
from gradeloom.llm.registry import query

ALL_ORDERS = r"""
WITH RECURSIVE said AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), f AS (
  SELECT doc_id, part, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t), regexp_matches(t, '[#$%&*|]'),
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails
  FROM w
), d AS (
  SELECT f.*, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM f LEFT JOIN said USING (doc_id)
), orders(filter_order) AS (
  SELECT '' UNION ALL SELECT filter_order || x FROM orders, unnest(['A', 'B', 'C', 'D', 'E']) AS u(x) WHERE position(x IN filter_order) = 0
), steps AS (
  SELECT filter_order, s AS step, ascii(filter_order[s]) - 64 AS letter, list_transform(string_split(filter_order[:s - 1], ''), lambda c: ascii(c) - 64) AS earlier
  FROM orders, unnest([1, 2, 3, 4, 5]) AS u(s) WHERE length(filter_order) = 5
), cells AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY ALL
), counted AS (
  SELECT part, filter_order, step, letter,
    sum(n) FILTER (WHERE NOT fails[letter] AND NOT gone) AS kept, sum(n) FILTER (WHERE fails[letter] AND NOT gone) AS removed,
    sum(n) FILTER (WHERE fails[letter] AND gone) AS redundant,
    sum(n) FILTER (WHERE fails[letter] AND len(list_filter(fails, lambda x: x)) = 1) AS unique_fails,
    sum(good) FILTER (WHERE fails[letter] AND NOT gone) AS good_lost, sum(toxic) FILTER (WHERE fails[letter] AND NOT gone) AS toxic_lost
  FROM (SELECT *, step > 1 AND len(list_filter(earlier, lambda e: e > 0 AND fails[e])) > 0 AS gone FROM cells, steps) GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""


@query("op12_filter_audit", ALL_ORDERS)
def op12_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Five filters over all documents, per source, in all 120 orders."""
    return filter_audit.audit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
