"""Query of the spelling variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gradeloom.llm import spelling
from gradeloom.llm.registry import query

# The checksum is computed a byte at a time from the usual table of 256 entries, itself made by rule.
VARIANTS = r"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS entries FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i))
), runs AS (
  SELECT doc_id, r, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS r
    FROM documents) GROUP BY ALL
), hashed AS (
  SELECT r, k, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || r, ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [(192 + unicode(x) // 64)::BIGINT, (128 + unicode(x) % 64)::BIGINT] END))),
    lambda c, b: xor(c >> 8, entries[xor(c & 255, b) + 1])), 4294967295::BIGINT) AS h
  FROM runs, crc
), words AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN r[:h % length(r)] || r[h % length(r) + 2:] ELSE r END AS word, k FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5
), cut AS (
  SELECT word, n, i, word[:i] || word[i + 2:] AS key FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.key = b.key AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.key = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.key = b.word
), ranked AS (
  SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place FROM pairs
), formed AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.near_n >= 5 * w.n THEN r.near END AS form, CASE WHEN r.near_n >= 5 * w.n THEN r.near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1
), chain AS (
  SELECT word, word AS root, form FROM formed UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON c.form = f.word
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c ON c.word = f.word AND c.form IS NULL
"""


@query("op11_spelling", VARIANTS)
def op11_spelling(spark: SparkSession, sf: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return spelling.variants(docs, least_ratio=5, least_chars=6, least_count=5, drop_every=199)
