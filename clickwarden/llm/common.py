"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwarden import runtime
from clickwarden.runtime import scratch_root

__all__ = ["column_batches", "crc_of_id", "fresh_folder", "held_out", "memo_of", "read_table", "scratch_root", "spill"]


def spill(df: DataFrame, name: str = "stage") -> DataFrame:
    """A stored stage in the codec that costs least time."""
    return runtime.spill(df, name, "snappy")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_of_id(column: str = "doc_id") -> Column:
    """crc32 of the id written as decimal text; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def held_out(column: str = "doc_id", folds: int = 5) -> Column:
    """Rows whose labels no model may learn from. A null id is never held out."""
    return F.coalesce(crc_of_id(column) % folds == 0, F.lit(False))


def fresh_folder(spark: SparkSession, name: str, *key: object) -> str:
    """A new folder below the shared scratch folder."""
    import uuid

    salt = hashlib.sha1(repr((key, uuid.uuid4().hex)).encode()).hexdigest()[:16]
    return f"{scratch_root(spark)}/{name}-{salt}"


_memos: dict[str, Callable[[], None]] = {}


def memo_of(operator: str, forget: Callable[[], None] | None = None) -> None:
    """Called where a task of an operator begins. A Python worker serves the stages of a job one after
    the other; what it remembers for other operators is forgotten, so that memos do not add up."""
    for other in [name for name in _memos if name != operator]:
        _memos.pop(other)()
        pa.default_memory_pool().release_unused()
    if forget is not None:
        _memos[operator] = forget


def column_batches(batches, rows: int = 1000):
    """Arrow batches cut into pieces of at most ``rows`` rows, so Python objects stay few."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def batch_of(columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[field.name], field.type) for field in schema], schema=schema)
