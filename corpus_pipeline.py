"""A corpus pipeline of five operators: quality, near-duplicates, secrets, mixing, byte-level BPE.

Each stage works on all documents that the one before kept. A stage's result is written as Parquet to the shared folder and
read again as the next one's documents, so that a lost executor never takes work back further than one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.llm import byte_bpe, minhash, mixing, quality_mil, secrets
from gradeloom.plans.once import fresh
from gradeloom.plans.skew import materialize, materialize_measured


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    It learns from the labelled documents that are not held out; null ids cannot be labelled and are scored all the same. Of
    rows that repeat an id, those whose text is rejected go.
    """
    models = quality_mil.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _without(docs, quality_mil.score(docs, models).filter("predicted = 0"), "rejected")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 of their 5-word shingles: the one with the smallest id.

    Rows that repeat an id with another text are documents of their own; of rows that repeat both, one stays.
    """
    found = materialize(minhash.near_duplicates(docs, width=5, percent=80), "near-duplicates")
    left = _without(docs, found.filter("NOT kept"), "duplicates")
    if found.groupBy("doc_id", "text_key").count().filter("count > 1").isEmpty():
        return left
    (key,) = fresh(docs.columns, "text_key")
    return left.withColumn(key, _text_key()).dropDuplicates(["doc_id", key]).drop(key)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; ``n_chars`` is counted again."""
    clean = secrets.redact(docs, secrets.scan(docs, path="source"))
    return _counted(clean, docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources, a row per piece of a document in a block; ``n_chars`` is that of the piece."""
    return _counted(mixing.mixed_documents(docs), docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every piece, encoded and decoded again: ``doc_id, n_tokens, ids_sha256, decoded_sha256, n_pieces``."""
    return byte_bpe.round_trip_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("secret_scan", secret_scan), ("source_mix", source_mix),
    ("token_ids", token_ids),
]

#: The classifier, the forest and the encoder are not expressible in SQL; tests/llm compare with brute force.
ORACLE_SQL = None


def _text_key() -> Column:
    """The hash by which operators tell rows of one id apart."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _without(docs: DataFrame, gone: DataFrame, label: str) -> DataFrame:
    """Documents whose id and text are not in ``gone (doc_id, text_key)``; it is broadcast only if measured to be small."""
    id_, key = fresh(docs.columns, "gone_id", "gone_key")
    listed, small = materialize_measured(gone.select(F.col("doc_id").alias(id_), F.col("text_key").alias(key)).distinct(), label)
    listed = F.broadcast(listed) if small else listed
    return docs.join(listed, docs["doc_id"].cast("bigint").eqNullSafe(listed[id_]) & (_text_key() == listed[key]), "left_anti")


def _counted(docs: DataFrame, like: DataFrame) -> DataFrame:
    """With ``n_chars`` counted again, if documents have it."""
    if "n_chars" not in like.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(like.schema["n_chars"].dataType)).select(*like.columns)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
