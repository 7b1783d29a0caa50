"""Query of the quality classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gradeloom.llm import quality_mil
from gradeloom.llm.registry import query


@query("op5_quality_mil")
def op5_quality_mil(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of all documents."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    models = quality_mil.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    scored = quality_mil.score(docs, models)
    return scored.select("doc_id", quality_mil.held_out().alias("held_out"), "score", "predicted")
