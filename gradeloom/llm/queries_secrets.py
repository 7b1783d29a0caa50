"""Query of the secret scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.llm import secrets
from gradeloom.llm.registry import query


@query("op4_secret_forest")
def op4_secret_forest(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates of all documents with the forest's verdict; the candidates themselves are only shown as digests."""
    scanned = secrets.scan(spark.read.parquet(f"{sf}/documents.parquet"), path="source")
    return scanned.select("doc_id", "start", "length", F.sha2("candidate", 256).alias("candidate_sha256"), "label", "score", "is_secret")
