"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # State of long streams belongs on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.driver.memory": "8g",
    # Scoring is bound by CPU, not by bytes: let small inputs keep all local cores busy.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}


def build_session(app: str = "gradeloom", cpus: int | str = 8, **conf: str) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the session you are given."""
    builder = SparkSession.builder.appName(app).master(f"local[{cpus}]")
    for key, value in {**LOCAL_DEFAULTS, "spark.sql.shuffle.partitions": str(cpus), **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    A folder of our own is made only where the session names none, as in local tests.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gradeloom-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


_scope: ContextVar[str | None] = ContextVar("scratch scope", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, inside that of the innermost :func:`scratch_scope`."""
    return f"{_scope.get() or shared_dir(spark) + '/gradeloom'}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession, label: str = "scope") -> Iterator[str]:
    """Tables that operators store inside go to a folder of their own, which is dropped at the end.

    Results are lazy and read these tables, so write or collect them inside.
    """
    folder = scratch_path(spark, label)
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
