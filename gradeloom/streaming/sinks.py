"""Stream output as a table in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gradeloom.session import scratch_path

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# Per session how many are inside rocksdb_state, and the state store that it named before the first of them.
_inside: WeakKeyDictionary[SparkSession, tuple[int, str | None]] = WeakKeyDictionary()
_lock = Lock()


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which stateful processors need, whatever the session's default is.

    Threads may be inside side by side: the session's own state store comes back when the last has left.
    """
    with _lock:
        users, named = _inside.get(spark, (0, None))
        if not users:
            named = spark.conf.get(STATE_STORE, None)
            spark.conf.set(STATE_STORE, ROCKSDB)
        _inside[spark] = users + 1, named
    try:
        yield
    finally:
        with _lock:
            users, named = _inside.pop(spark)
            if users > 1:
                _inside[spark] = users - 1, named
            elif named is None:
                spark.conf.unset(STATE_STORE)
            else:
                spark.conf.set(STATE_STORE, named)


def drain(stream: DataFrame, label: str, mode: str = "append", key: str = "run", once: bool = False) -> DataFrame:
    """Process all input that is there, and return the result table.

    Append output goes through the file sink. In update mode each micro-batch replaces its
    own folder, so a batch run again leaves no duplicates, and the table holds the newest
    row per ``key``. ``once`` takes everything in a single batch: a stream on the processing-time
    clock would otherwise go on as long as a timer could still come. Of stateful processors, drain
    inside :func:`rocksdb_state`.
    """
    spark = stream.sparkSession
    root = scratch_path(spark, label)
    writer = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(**({"once": True} if once else {"availableNow": True}))
    )
    if mode == "append":
        writer.format("parquet").start(f"{root}/data").awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{root}/data")

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/data/batch={batch_id}")

    writer.foreachBatch(store).start().awaitTermination()
    stored = spark.read.schema(StructType(stream.schema.fields).add("batch", "long")).parquet(f"{root}/data")
    newest = Window.partitionBy(key).orderBy(F.col("batch").desc())
    return stored.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n", "batch")
