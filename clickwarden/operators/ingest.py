"""From raw click logs to canonical, validated, labelled clicks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwarden import schemas
from clickwarden.functions import (
    blank_to_null, click_id, install_delta, padded_id, parse_times, parse_timestamp,
    plus_seconds, stable_id,
)
from clickwarden.operators.contract import violations
from clickwarden.operators.ordering import (
    before_row, global_index, lay_out, previous_value, quantiles, rows_at, same,
)
from clickwarden.runtime import spill


def map_clicks(df: DataFrame) -> DataFrame:
    """Raw click columns to the 14 canonical ones. The channel stands for both campaign
    and publisher."""
    clicked = parse_timestamp("click_time", df.schema["click_time"].dataType)
    installed = parse_timestamp("attributed_time", df.schema["attributed_time"].dataType)
    text = {name: F.col(name).cast("string") for name in ("ip", "app", "device", "os", "channel")}
    return df.select(
        click_id(text["ip"], text["device"], text["os"], text["app"], text["channel"],
                 F.col("click_time")).alias("click_id"),
        text["app"].alias("ad_id"),
        text["channel"].alias("campaign_id"),
        text["channel"].alias("publisher_id"),
        text["device"].alias("device_id"),
        text["ip"].alias("ip"),
        text["os"].alias("os"),
        clicked.alias("timestamp"),
        clicked.alias("click_time"),
        installed.alias("attributed_time"),
        F.col("is_attributed").try_cast("int").alias("is_attributed"),
        install_delta(clicked, installed).cast("double").alias("click_to_install_delta"),
        F.lit(0).alias("is_synthetic"),
        F.lit(0).alias("is_fraud"),
    )


def normalize_clicks(df: DataFrame, on_error: str = "fail") -> DataFrame:
    """Raw or canonical clicks to click events stamped with the publish time.

    ``on_error="fail"`` raises on the first contract violation while the rows are read;
    ``"keep"`` adds the array column ``errors`` instead.
    """
    events = df if "click_id" in df.columns else map_clicks(df).drop("is_fraud").withColumn(
        "click_to_install_delta", F.lit(None).cast("double"))
    if "is_synthetic" not in events.columns:
        events = events.withColumn("is_synthetic", F.lit(0))
    events = events.withColumn("event_timestamp", F.current_timestamp())
    errors = violations(
        list(events.columns),
        {name: F.col(name).cast("string")
         for name in (*schemas.NON_EMPTY_EVENT_FIELDS, *schemas.FLAG_EVENT_FIELDS)
         if name in events.columns},
    )
    events = events.withColumn("errors", errors)
    for flag in schemas.FLAG_EVENT_FIELDS:
        events = events.withColumn(flag, F.col(flag).try_cast("int"))
    if on_error == "keep":
        return events
    # A filter, so that no choice of columns and no count can leave the check out.
    stop = F.raise_error(F.array_join("errors", "; ")).cast("boolean")
    return events.where(F.when(F.size("errors") > 0, stop).otherwise(True)).drop("errors")


def from_time(df: DataFrame, start, column: str = "click_time") -> DataFrame:
    """Rows at or after ``start``."""
    return df.where(F.col(column) >= F.lit(start).cast(df.schema[column].dataType))


def order_violations(df: DataFrame, seq: str, time: str) -> DataFrame:
    """Rows whose time lies before the time of their predecessor in ``seq`` order."""
    laid = lay_out(df.select(seq, time), [seq])
    return previous_value(laid, [], time, "previous_time").where(
        F.col(time) < F.col("previous_time")
    ).select(seq, time, "previous_time")


def contiguous_slice(df: DataFrame, order: list[str], start: int, rows: int) -> DataFrame:
    """Rows ``[start, start + rows)`` in ``order``; fails when the table is too short.

    The two border rows come from an index over the order columns alone. Whole rows are
    indexed only between these borders, which settles equal order values exactly.
    """
    if rows < 1 or start < 0:
        raise ValueError("rows must be positive and start cannot be negative")
    edges = rows_at(df, order, [start, start + rows - 1])
    if start + rows - 1 not in edges:
        found = max(0, df.count() - start)
        raise ValueError(f"asked for {rows} rows from {start}, found {found}")
    first = before_row(df, order, edges[start])
    last = before_row(df, order, edges[start + rows - 1])
    is_last = F.lit(True)
    for name, value in zip(order, edges[start + rows - 1]):
        as_stored = F.col(name)
        if df.schema[name].dataType.typeName() in ("timestamp", "timestamp_ntz"):
            as_stored = F.unix_micros(as_stored.cast("timestamp"))
        is_last = is_last & same(as_stored, F.lit(value))
    skip = start - df.where(first).count()
    inside = global_index(df.where(~first & (last | is_last)), order, "_at")
    return inside.where((F.col("_at") >= skip) & (F.col("_at") < skip + rows)).drop("_at")


def ip_stats(df: DataFrame) -> DataFrame:
    """Clicks, attributions and rates per IP."""
    fraud = [F.avg("is_fraud").alias("fraud_rate")] if "is_fraud" in df.columns else []
    return df.groupBy("ip").agg(
        F.count(F.lit(1)).alias("clicks"),
        F.sum("is_attributed").cast("bigint").alias("attributed"),
        F.avg("is_attributed").alias("attribution_rate"),
        *fraud,
    )


def velocity_cutoff(stats: DataFrame, percentile: float, column: str = "clicks") -> DataFrame:
    """Nearest-rank percentile of the per-IP click counts, as one row ``cutoff``."""
    return quantiles(stats, column, [percentile], nearest_rank=True).select(
        F.col("value").cast("bigint").alias("cutoff")
    )


def fraud_ips(df: DataFrame, percentile: float = 0.999, max_rate: float = 0.001) -> DataFrame:
    """IPs in the velocity tail with next to no attributions, with their counts."""
    return _velocity_tail(df, percentile, max_rate)[0]


def _velocity_tail(df: DataFrame, percentile: float, max_rate: float) -> tuple[DataFrame, int | None]:
    """The IPs of ``fraud_ips`` and the cutoff, which exists even if no IP is flagged."""
    stats = spill(ip_stats(df.select("ip", "is_attributed")), "ip-stats")
    cutoff = velocity_cutoff(stats, percentile).first()["cutoff"]
    return stats.where(
        (F.col("clicks") >= F.lit(cutoff))
        & (F.col("attributed") / F.col("clicks") <= F.lit(max_rate))
    ).select("ip", "clicks", "attributed", F.lit(cutoff).cast("bigint").alias("cutoff")), cutoff


def bootstrap_labels(
    df: DataFrame, percentile: float = 0.999, max_rate: float = 0.001
) -> DataFrame:
    """Set ``is_fraud`` to 1 for all clicks of the IPs in ``fraud_ips``.

    The label looks at the totals of the whole window, so it also sees clicks that come
    later than the one it marks.
    """
    flagged = spill(fraud_ips(df, percentile, max_rate).select(F.col("ip").alias("_f")), "ips")
    joined = df.join(flagged.withColumn("_hit", F.lit(1)), same(F.col("ip"), F.col("_f")), "left")
    label = F.when(F.col("_hit") == 1, 1).otherwise(0)
    return joined.withColumn("is_fraud", label).drop("_f", "_hit")


def union_clicks(organic: DataFrame, added: DataFrame) -> DataFrame:
    return organic.unionByName(added, allowMissingColumns=True)


def labelled_bursts(
    df: DataFrame, every: int, count: int, gap_seconds: int,
    time: str = "click_time", tie: str = "click_id", prefix: str = "farm", ips: int = 3, devices: int = 2,
) -> DataFrame:
    """Labelled burst clicks after every ``every``-th click in time order.

    Each burst has ``count`` clicks ``gap_seconds`` apart that reuse a few IPs and
    devices. Names of the burst's ids begin with ``prefix``. Only the time and the
    tie-breaker of the source are read.
    """
    if min(every, count, gap_seconds) < 1:
        raise ValueError("burst arguments must be positive")
    indexed = global_index(df.select(time, tie), [time, tie], "_at")
    anchors = indexed.where((F.col("_at") + 1) % every == 0)
    burst = anchors.select(
        F.col(time).alias("_start"),
        F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("_i"),
    )
    at = plus_seconds(F.col("_start"), F.col("_i") * gap_seconds)
    ip = padded_id(f"{prefix}-", F.col("_i") % ips, 2)
    device = padded_id(f"{prefix}-device-", F.col("_i") % devices, 2)
    stamp = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    return burst.select(
        stable_id(F.lit(f"synthetic-{prefix}"), ip, device, stamp).alias("click_id"),
        F.lit(f"{prefix}-ad-001").alias("ad_id"),
        F.lit(f"{prefix}-campaign-001").alias("campaign_id"),
        F.lit(f"{prefix}-publisher-001").alias("publisher_id"),
        device.alias("device_id"), ip.alias("ip"), F.lit(f"{prefix}-os-1").alias("os"),
        at.alias("timestamp"), at.alias("click_time"),
        F.lit(None).cast("timestamp").alias("attributed_time"),
        F.lit(0).alias("is_attributed"),
        F.lit(None).cast("double").alias("click_to_install_delta"),
        F.lit(1).alias("is_synthetic"), F.lit(1).alias("is_fraud"),
    )


def sample_metadata(
    df: DataFrame, percentile: float = 0.999, max_rate: float = 0.001, start: int = 0
) -> DataFrame:
    """One row that describes a labelled click sample."""
    flagged, cutoff = _velocity_tail(df, percentile, max_rate)
    ips = flagged.agg(
        F.count(F.lit(1)).alias("flagged_ips"), F.sum("clicks").alias("_fraud"),
    ).first()
    fraud = ips["_fraud"] or 0
    return df.agg(
        F.count(F.lit(1)).alias("sample_rows"),
        F.min("click_time").alias("click_time_start"),
        F.max("click_time").alias("click_time_end"),
    ).select(
        F.lit(start).cast("bigint").alias("sample_start_row"), "sample_rows",
        "click_time_start", "click_time_end",
        F.lit(percentile).alias("velocity_percentile"),
        F.lit(cutoff).cast("bigint").alias("velocity_count_cutoff"),
        F.lit(max_rate).alias("max_attribution_rate"),
        F.lit(ips["flagged_ips"]).cast("bigint").alias("flagged_ips"),
        F.lit(fraud).cast("bigint").alias("is_fraud_positive_rows"),
        F.coalesce(F.try_divide(F.lit(fraud).cast("double"), F.col("sample_rows")), F.lit(0.0))
        .alias("is_fraud_rate"),
    )
