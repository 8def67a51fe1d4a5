"""The ordered click feature set, conversion snapshots and vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickwarden import schemas
from clickwarden.functions import click_to_install_seconds, safe_ratio
from clickwarden.operators import windows as w
from clickwarden.operators.ordering import before_row, hot_keys, rows_at, same
from clickwarden.runtime import spill


def conversion_snapshots(
    df: DataFrame, id_column: str, cutoff: int | None = None,
    order: list[str] = ("timestamp", "click_id"),
) -> DataFrame:
    """Clicks and attributions per id over the first ``cutoff`` rows (all when None)."""
    if cutoff is not None:
        edge = rows_at(df, list(order), [cutoff])
        if cutoff in edge:
            df = df.where(before_row(df, list(order), edge[cutoff]))
    return df.groupBy(F.col(id_column).alias("id")).agg(
        F.count(F.lit(1)).alias("clicks"),
        F.sum("is_attributed").cast("bigint").alias("attributed"),
    )


def snapshot_rate() -> Column:
    """Rate of a snapshot row from its counts."""
    return safe_ratio(F.col("attributed"), F.col("clicks"))


def attach_rates(
    df: DataFrame, snapshot: DataFrame | None, id_column: str, name: str
) -> DataFrame:
    """Left join of the snapshot's rate; unknown ids and empty snapshots give zero.

    Rows of one id in the snapshot add up, so a click stays one row; of several bare rates
    the largest counts. Spark broadcasts the side by its own size threshold.
    """
    if snapshot is None:
        return df.withColumn(name, F.lit(0.0))
    bare = F.col("rate").cast("double") if "rate" in snapshot.columns else F.lit(None).cast("double")
    side = snapshot.withColumn("_bare", bare).groupBy(F.col("id").cast("string").alias("_id")).agg(
        F.sum("clicks").alias("clicks"), F.sum("attributed").alias("attributed"),
        F.max("_bare").alias("_bare"),
    ).select("_id", F.coalesce("_bare", snapshot_rate()).alias(name))
    joined = df.join(side, same(F.col(id_column).cast("string"), F.col("_id")), "left")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(0.0))).drop("_id")


def _ip_ordinary(df: DataFrame, tie: str) -> DataFrame:
    widths = {f"ip_clicks_{k}": s for k, s in schemas.WINDOW_SECONDS.items()}
    df = w.counts_ordinary(df, ["ip"], tie, widths)
    df = w.gap_ordinary(df, ["ip"], tie, "ip_inter_click_gap_seconds")
    return w.entropy_ordinary(
        df, ["ip"], ["device_id", "os"], tie, schemas.ENTROPY_SECONDS,
        "ip_fingerprint_entropy_5m",
    )


def _ip_spread(laid: DataFrame) -> DataFrame:
    widths = {f"ip_clicks_{k}": s for k, s in schemas.WINDOW_SECONDS.items()}
    out = w.counts_spread(laid, ["ip"], widths)
    out = w.gap_spread(out, ["ip"], "ip_inter_click_gap_seconds")
    return w.entropy_spread(
        out, ["ip"], ["device_id", "os"], schemas.ENTROPY_SECONDS, "ip_fingerprint_entropy_5m"
    )


def click_features(
    df: DataFrame, campaign: DataFrame | None = None, publisher: DataFrame | None = None,
    device_scope: str = "global", time: str = "timestamp", tie: str = "click_id",
    hot_rows: int | None = None,
) -> DataFrame:
    """Add all eleven click features.

    ``device_scope="global"`` counts a device over all IPs, ``"per_ip"`` only within the
    click's own IP, which is what a stream keyed by IP can see. All IP windows share one
    exchange, the device windows take a second one.
    """
    if device_scope not in ("global", "per_ip"):
        raise ValueError("device_scope is 'global' or 'per_ip'")
    device = ["device_id"] if device_scope == "global" else ["ip", "device_id"]
    widths = {f"device_clicks_{k}": s for k, s in schemas.WINDOW_SECONDS.items()}
    if time not in df.columns and "click_time" in df.columns:
        time = "click_time"  # the fallback when there is no time of its own
    # Both key counts read the source, not the features computed so far.
    hot_devices = hot_keys(df, device, hot_rows)
    out = w.apply_by_key(
        df, "ip", time, tie, lambda d: _ip_ordinary(d, tie), _ip_spread, hot_rows)
    if hot_devices:
        out = spill(out, "ip-features")  # both device plans read it
    out = w.apply_split(
        out, device, time, tie, lambda d: w.counts_ordinary(d, device, tie, widths),
        lambda d: w.counts_spread(d, device, widths), hot_devices)
    stamp = "timestamp" if "timestamp" in out.columns else "click_time"
    out = out.withColumn("click_to_install_delta_seconds", click_to_install_seconds(
        F.col("click_to_install_delta"), F.col(stamp), F.col("attributed_time")))
    out = attach_rates(out, campaign, "campaign_id", "campaign_conversion_rate")
    out = attach_rates(out, publisher, "publisher_id", "publisher_conversion_rate")
    others = [c for c in out.columns if c not in schemas.CLICK_FEATURES]
    return out.select(*others, *schemas.CLICK_FEATURES)


def vectorize(
    df: DataFrame, names: list[str] = tuple(schemas.CLICK_FEATURES), out: str = "vector"
) -> DataFrame:
    """Features as ``array<double>`` in fixed order; null, missing and empty give zero."""
    def number(name: str) -> Column:
        if name not in df.columns:
            return F.lit(0.0)
        column = F.col(name)
        if df.schema[name].dataType.simpleString() == "string":
            column = F.nullif(column, F.lit(""))
        return F.coalesce(column.cast("double"), F.lit(0.0))

    return df.withColumn(out, F.array(*[number(name) for name in names]))


def shannon_entropy(df: DataFrame, group: list[str], values: list[str]) -> DataFrame:
    """Base-2 entropy of a bag of values per group, counted before the groups meet."""
    counts = df.groupBy(*dict.fromkeys([*group, *values])).agg(F.count(F.lit(1)).alias("_c"))
    # Counts per value are combined before the shuffle, so a heavy group stays cheap.
    sums = counts.groupBy(*group).agg(
        F.sum("_c").alias("n"), F.sum(F.col("_c") * F.log2("_c")).alias("_s")
    )
    bits = F.greatest(F.lit(0.0), F.log2("n") - F.col("_s") / F.col("n"))
    return sums.select(*group, "n", bits.alias("entropy"))
