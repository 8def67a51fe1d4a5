"""Summaries, grouped rates and top lists over clicks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwarden.functions import hour_prefix, safe_ratio
from clickwarden.operators.ingest import ip_stats
from clickwarden.runtime import spill


def click_summary(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Totals, rates, time range and distinct IPs in one row."""
    distinct = F.approx_count_distinct("ip") if approximate else F.count_distinct("ip")
    totals = df.agg(
        F.count(F.lit(1)).alias("clicks"),
        F.coalesce(F.sum("is_fraud"), F.lit(0)).cast("bigint").alias("fraud"),
        F.coalesce(F.sum("is_attributed"), F.lit(0)).cast("bigint").alias("attributed"),
        distinct.alias("unique_ips"),
        F.min("click_time").alias("first_time"), F.max("click_time").alias("last_time"),
    )
    return totals.withColumns({
        "fraud_rate": safe_ratio(F.col("fraud"), F.col("clicks")),
        "attribution_rate": safe_ratio(F.col("attributed"), F.col("clicks")),
    })


def fraud_rate_by(df: DataFrame, column: str, label: str = "is_fraud") -> DataFrame:
    """Rows, positives and fraud rate per value of ``column``."""
    return df.groupBy(column).agg(
        F.count(F.lit(1)).alias("clicks"),
        F.sum(label).cast("bigint").alias("fraud"),
        F.avg(label).alias("fraud_rate"),
    )


def clicks_per_hour(df: DataFrame, time: str = "click_time") -> DataFrame:
    return df.groupBy(hour_prefix(F.col(time)).alias("hour")).agg(
        F.count(F.lit(1)).alias("clicks"))


def clicks_per_minute(df: DataFrame, time: str = "click_time") -> DataFrame:
    """Clicks per minute from the first to the last, empty minutes with zero.

    Counts are taken and stored first. The minutes between their ends come from a range
    that Spark makes in all tasks.
    """
    minute = F.date_trunc("minute", F.col(time).cast("timestamp"))
    counts = spill(df.where(F.col(time).isNotNull()).groupBy(minute.alias("minute")).agg(
        F.count(F.lit(1)).alias("_n")), "minutes")
    number = F.expr("unix_seconds(minute) div 60")
    ends = counts.agg(F.min(number).alias("a"), F.max(number).alias("b")).first()
    first, last = (0, -1) if ends["a"] is None else (ends["a"], ends["b"])
    every = df.sparkSession.range(first, last + 1).select(
        F.timestamp_seconds(F.col("id") * 60).alias("minute"))
    return every.join(counts, "minute", "left").select(
        "minute", F.coalesce("_n", F.lit(0)).cast("bigint").alias("clicks"))


def label_balance(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def top_rates(
    df: DataFrame, column: str, limit: int = 5, min_count: int = 100,
    label: str = "is_fraud", ascending: bool = False,
) -> DataFrame:
    """Ids with the highest fraud rate among those with enough rows.

    Ties go to more clicks, then to the id. ``ascending`` turns the picked rows around
    for display.
    """
    rates = fraud_rate_by(df, column, label).where(F.col("clicks") >= min_count)
    best = rates.orderBy(F.desc("fraud_rate"), F.desc("clicks"), F.asc(column)).limit(limit)
    out = best.select(
        F.col(column).alias("id"), "clicks", F.round("fraud_rate", 6).alias("fraud_rate"))
    if ascending:
        out = out.orderBy(F.asc("fraud_rate"), F.asc("clicks"), F.desc("id"))
    return out


def busiest_ips(df: DataFrame, limit: int = 5) -> DataFrame:
    top = ip_stats(df).orderBy(F.desc("clicks"), F.asc("ip")).limit(limit)
    return top.select("ip", "clicks", F.round("attribution_rate", 6).alias("attribution_rate"))


def busiest_hour(df: DataFrame, time: str = "click_time") -> DataFrame:
    return clicks_per_hour(df, time).orderBy(F.desc("clicks"), F.asc("hour")).limit(1)


def flagged(df: DataFrame, flag: str = "is_flagged") -> DataFrame:
    return df.where(F.col(flag) == 1)


def head_sample(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows in ``order`` (per-task top-n, then merged)."""
    return df.orderBy(*order).limit(n)
