"""Session settings, and scratch tables shared by every operator."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# A key with more rows than this is split over many tasks (see operators/ordering.py).
HOT_KEY_ROWS = 1_000_000
# Rows per chunk when the number of rows is known.
CHUNK_ROWS = 5_000_000

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A micro-batch uploads its changes, and whole snapshots only now and then.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # One store a partition for both sides of a stream join, not four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on; returns the same session."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for materialised stages.

    The cluster names it in ``spark.checkpoint.dir``. A temporary folder is made only for
    local masters, where driver and executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="clickwarden-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


_stored: list[str] = []
_scopes = threading.local()


@contextmanager
def stages(spark: SparkSession):
    """Tables stored with ``spill`` inside this block are deleted when it ends.

    For jobs and micro-batches whose results are written within the block.
    """
    outer = getattr(_scopes, "paths", None)
    _scopes.paths = mine = []
    try:
        yield
    finally:
        _scopes.paths = outer
        _delete(spark, mine)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_shuffles(spark: SparkSession):
    """Shuffle files of queries that begin in this block are deleted when their query ends, not when
    the driver's memory is cleared. A stream that starts here keeps to that in all its micro-batches."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def spill(df: DataFrame, name: str = "stage", codec: str = "zstd") -> DataFrame:
    """Write ``df`` to a scratch Parquet table and read it back.

    Cuts lineage, fixes values that depend on the physical layout, and survives the loss
    of executors because the files live in the shared folder.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    with short_shuffles(spark):
        df.write.option("compression", codec).parquet(path)
    track(path)
    return spark.read.schema(df.schema).parquet(path)


def track(path: str) -> None:
    """Let ``path`` be deleted with the stored stages."""
    scope = getattr(_scopes, "paths", None)
    (_stored if scope is None else scope).append(path)


def release(spark: SparkSession) -> int:
    """Delete the tables this process stored with ``spill``; returns how many there were.

    Call it when a job's results are written: results that still read a stored stage can
    no longer be computed afterwards.
    """
    count = len(_stored)
    _delete(spark, _stored)
    return count


def _delete(spark: SparkSession, paths: list[str]) -> None:
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(conf).delete(path, True)


def hot_key_rows(spark: SparkSession) -> int:
    return int(spark.conf.get("clickwarden.hotKeyRows", str(HOT_KEY_ROWS)))
