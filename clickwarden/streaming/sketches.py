"""Quantiles and distinct counts of a stream, from sketches that merge.

Every micro-batch leaves one row per time bucket and group: exact count, sum, least and
largest value, a quantile sketch of a value and a distinct-count sketch of a key. Rows merge in
any order and over any span, so a report over a year reads sketches and no events.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RANK_ERROR = 0.0133  # of a quantile sketch with k = 200, at 99 % confidence
QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def sketch(
    df: DataFrame, value: str = "latency_ms", key: str = "ip", time: str = "timestamp",
    every: str = "10 minutes", by: list[str] = (), k: int = 200, lg_k: int = 12,
) -> DataFrame:
    """One row per bucket of ``every`` and group. Null values and keys are left out of the sketches
    and of the count ``n`` of values; ``rows`` counts all. Combined before the shuffle."""
    v = F.when(~F.isnan(F.col(value).cast("double")), F.col(value).cast("double"))
    return df.select(F.window(time, every)["start"].alias("bucket"), *by, v.alias("_v"), F.col(key).cast("string").alias("_k")).groupBy(
        "bucket", *by).agg(
        F.count(F.lit(1)).alias("rows"), F.count("_v").alias("n"), F.sum("_v").alias("total"),
        F.min("_v").alias("low"), F.max("_v").alias("high"),
        F.kll_sketch_agg_double("_v", k).alias("values"), F.hll_sketch_agg("_k", lg_k).alias("keys"))


def sketch_sink(path: str, **options) -> Callable[[DataFrame, int], None]:
    """Sink of ``foreachBatch``: a folder of sketches per micro-batch, overwritten when it is replayed."""
    def write(batch: DataFrame, batch_id: int) -> None:
        sketch(batch, **options).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")
    return write


def merge_sketches(sketches: DataFrame, every: str | None = None, by: list[str] = (), k: int = 200) -> DataFrame:
    """Sketches merged to buckets of ``every`` (None: one over all time) and groups ``by``."""
    bucket = F.window("bucket", every)["start"] if every else F.lit(None).cast("timestamp")
    return sketches.withColumn("bucket", bucket).groupBy("bucket", *by).agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.sum("total").alias("total"),
        F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double("values", k).alias("values"), F.hll_union_agg("keys").alias("keys"))


def sketched_report(sketches: DataFrame) -> DataFrame:
    """Per row of sketches: rows, n, min, p50, p95, p99, max and mean of the values, and distinct keys.

    Quantiles are values of the input whose rank is off by about ``RANK_ERROR`` of n at most, distinct
    keys by about 1.6 % (lg_k 12) in two of three cases. Without values the figures are null.
    """
    cuts = [_quantile(p).alias(name) for name, p in QUANTILES.items()]
    groups = [c for c in sketches.columns if c not in ("rows", "n", "total", "low", "high", "values", "keys")]
    return sketches.select(
        *groups, "rows", "n", F.col("low").alias("min"), *cuts, F.col("high").alias("max"),
        F.try_divide("total", "n").alias("mean"), F.hll_sketch_estimate("keys").alias("keys"))


def sketched_histogram(sketches: DataFrame, edges: list[float]) -> DataFrame:
    """About how many values lie in [edge, next edge) per row of sketches; the last bin holds its upper edge."""
    if len(edges) < 2 or sorted(set(edges)) != list(edges):
        raise ValueError("edges must rise")
    groups = [c for c in sketches.columns if c not in ("rows", "n", "total", "low", "high", "values", "keys")]
    # the rank of an edge counts values up to the edge itself, so inner edges step just below
    inner = [F.lit(float(e)) - F.lit(abs(float(e)) * 1e-12 + 1e-300) for e in edges[:-1]] + [F.lit(float(edges[-1]))]
    rank = [F.kll_sketch_get_rank_double("values", e) * F.col("n") for e in inner]
    bins = F.array(*[F.struct(F.lit(i).alias("bin"), F.lit(float(edges[i])).alias("bin_start"),
                              (rank[i + 1] - rank[i]).alias("n")) for i in range(len(edges) - 1)])
    return sketches.where("n > 0").select(*groups, F.inline(bins))


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch")


def _quantile(p: float) -> Column:
    return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("values", F.lit(p)))
