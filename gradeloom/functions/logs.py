"""Log-line parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The trainer's metric line and the run log line.
LOSS_LINE = r"'loss':\s*'?([0-9.eE+-]+)'?.*?'epoch':\s*'?([0-9.eE+-]+)'?"
LOSS_KEY = "'loss':"
LOG_LINE = r"(?s)\A\[(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})\] \[([^\]]*)\] (.*)\z"


def parse_loss(line: Column) -> Column:
    """``struct<epoch, loss>`` of a trainer line; null when it has none that parse."""
    loss = F.regexp_extract(line, LOSS_LINE, 1).try_cast("double")
    epoch = F.regexp_extract(line, LOSS_LINE, 2).try_cast("double")
    return F.when(loss.isNotNull() & epoch.isNotNull(), F.struct(epoch.alias("epoch"), loss.alias("loss")))


def parse_log_line(line: Column) -> Column:
    """``struct<ts, level, msg>`` of a run-log line; null when it does not match."""
    ts = F.try_to_timestamp(F.regexp_extract(line, LOG_LINE, 1), F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.when(
        ts.isNotNull(),
        F.struct(
            ts.cast("timestamp_ntz").alias("ts"),
            F.regexp_extract(line, LOG_LINE, 2).alias("level"),
            F.regexp_extract(line, LOG_LINE, 3).alias("msg"),
        ),
    )
