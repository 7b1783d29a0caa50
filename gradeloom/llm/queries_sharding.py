"""Query of the sharding operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gradeloom.llm import hypergeometric
from gradeloom.llm.registry import query


@query("op7_hypergeometric")
def op7_hypergeometric(spark: SparkSession, sf: str) -> DataFrame:
    """All documents shuffled into 16 shards of equal row counts."""
    return hypergeometric.shuffle_into_shards(spark.read.parquet(f"{sf}/documents.parquet"), shards=16)
