"""Log files as a stream into a table of ordered lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from gradeloom.sources.readers import log_source, ordered_log

LINES = "run string, ord bigint, ts timestamp_ntz, level string, line string"


def ingest_logs(spark: SparkSession, path: str, target: str, checkpoint: str, archive: bool = False) -> DataStreamWriter:
    """Writer that appends the lines of new log files to the table ``target``; start it with the trigger of your choice.

    A file arrives whole in one batch, which is numbered as a table would be. Each batch replaces a folder of its own, so
    one that is run again leaves no duplicates.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        ordered_log(batch, archive).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    lines = log_source(spark, path, streaming=True)
    return lines.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)


def stored_lines(spark: SparkSession, target: str, streaming: bool = False) -> DataFrame:
    """``(run, ord, ts, level, line)`` of a table of :func:`ingest_logs`, as a table or as a stream for losses and alerts."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(LINES).parquet(f"{target}/batch=*")
