"""Query of the mixing operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gradeloom.llm import mixing
from gradeloom.llm.registry import query


@query("op9_mixing")
def op9_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """All documents mixed by source."""
    return mixing.taken_words(spark.read.parquet(f"{sf}/documents.parquet"))
