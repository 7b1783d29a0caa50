"""Queries of the token operators: plane files, BPE, counts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.llm import byte_bpe, plane_files, token_counts
from gradeloom.llm.registry import query
from gradeloom.session import scratch_path


@query("op2_plane_files")
def op2_plane_files(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of all documents written as byte planes, and read back."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    path = scratch_path(spark, "planes")
    plane_files.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    back = plane_files.read(spark, path)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op6_byte_bpe")
def op6_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """All documents encoded by ranks and decoded again."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return byte_bpe.round_trip_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of all documents."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=1024)
