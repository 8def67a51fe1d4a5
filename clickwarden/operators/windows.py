"""Trailing counts, entropy, gaps and counts so far, per key in time order.

Every operator has two plans with the same results. Keys of ordinary size use windows
partitioned by the key. Keys above ``clickwarden.hotKeyRows`` go through chunked running
sums, which spread one key over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickwarden.functions.scalars import entropy_from_sums, x_log2_x
from clickwarden.functions.times import micros
from clickwarden.operators.ordering import (
    CHUNK, ROW, HotKeys, chunks_for, hot_keys, lay_out, previous_value, running,
)
from clickwarden.runtime import spill

US = "_us"
SECOND = 1_000_000


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def apply_by_key(
    df: DataFrame, key: str | list[str], time: str, tie: str, ordinary, spread,
    hot_rows: int | None = None,
) -> DataFrame:
    """Run ``ordinary`` on ordinary keys and ``spread`` on laid-out rows of hot keys.

    Keys with more than ``hot_rows`` rows are hot (default: ``clickwarden.hotKeyRows``).
    """
    return apply_split(df, key, time, tie, ordinary, spread, hot_keys(df, _keys(key), hot_rows))


def apply_split(
    df: DataFrame, key: str | list[str], time: str, tie: str, ordinary, spread,
    hot: HotKeys | None,
) -> DataFrame:
    """As ``apply_by_key`` with the hot keys already known.

    Both plans get the microsecond column ``_us``. Ordinary rows arrive hash-partitioned
    by the key, so all windows on it share that one exchange.
    """
    keys = _keys(key)
    timed = df.withColumn(US, micros(df, time))
    cold, large = hot.split(timed, keys) if hot else (timed, None)
    out = ordinary(cold.repartition(*[F.col(k) for k in keys]))
    if large is not None:
        parts = chunks_for(df.sparkSession, hot.rows)
        big = spread(lay_out(large, [*keys, US, tie], parts))
        out = out.unionByName(big.drop(CHUNK, ROW))
    return out.drop(US)


# --- trailing counts -------------------------------------------------------------------

def counts_ordinary(df: DataFrame, keys: list[str], tie: str, widths: dict[str, int]):
    """Rows so far minus rows that fell out. The lower edge is closed and later tied rows
    are left out, which a plain RANGE frame could not do."""
    base = Window.partitionBy(*keys)
    df = df.withColumn("_seen", F.row_number().over(base.orderBy(US, tie)).cast("bigint"))
    gone = {
        name: F.count(F.lit(1)).over(
            base.orderBy(US).rangeBetween(Window.unboundedPreceding, -(s * SECOND + 1))
        )
        for name, s in widths.items()
    }
    df = df.withColumns(gone)
    return df.withColumns({name: F.col("_seen") - F.col(name) for name in widths}).drop("_seen")


def counts_spread(laid: DataFrame, keys: list[str], widths: dict[str, int]) -> DataFrame:
    """The same counts from a sweep over arrivals and one probe per window edge."""
    marks = [F.struct(F.col(US).alias("t"), F.lit(1).alias("add"), F.lit("").alias("edge"))]
    marks += [
        F.struct((F.col(US) - s * SECOND).alias("t"), F.lit(0).alias("add"),
                 F.lit(name).alias("edge"))
        for name, s in widths.items()
    ]
    events = laid.select(*keys, CHUNK, ROW, F.explode(F.array(*marks)).alias("m"))
    events = events.select(
        *keys, F.col(CHUNK).alias("_c"), F.col(ROW).alias("_r"), "m.t", "m.add", "m.edge"
    )
    # Probes sort before arrivals of the same time: the lower edge stays in the window.
    swept = running(
        events, keys, ["t", "add", "_c", "_r", "edge"], {"upto": F.col("add").cast("bigint")}
    )
    at = {name: F.max(F.when(F.col("edge") == name, F.col("upto"))) for name in widths}
    rows = swept.groupBy("_c", "_r").agg(
        F.max(F.when(F.col("add") == 1, F.col("upto"))).alias("_seen"),
        *[value.alias(name) for name, value in at.items()],
    )
    rows = rows.select(
        "_c", "_r", *[(F.col("_seen") - F.col(name)).alias(name) for name in widths]
    )
    return _attach(laid, rows)


def _attach(laid: DataFrame, rows: DataFrame) -> DataFrame:
    on = (F.col(CHUNK) == F.col("_c")) & (F.col(ROW) == F.col("_r"))
    return laid.join(rows, on).drop("_c", "_r")


def rolling_counts(
    df: DataFrame, key: str | list[str], widths: dict[str, int],
    time: str = "timestamp", tie: str = "click_id", hot_rows: int | None = None,
) -> DataFrame:
    """Add trailing row counts per key; ``widths`` maps new columns to seconds.

    A row counts itself, all rows at most ``width`` seconds older (closed edge), and of
    the rows with its own time only those before it in ``tie`` order.
    """
    keys = _keys(key)
    return apply_by_key(
        df, keys, time, tie,
        lambda d: counts_ordinary(d, keys, tie, widths),
        lambda d: counts_spread(d, keys, widths),
        hot_rows,
    )


# --- trailing entropy ------------------------------------------------------------------

def _sign_events(df: DataFrame, width: int) -> DataFrame:
    """Every row once on arrival (+1) and once when it leaves the window (-1)."""
    marks = F.array(
        F.struct(F.col(US).alias("t"), F.lit(1).alias("d")),
        F.struct((F.col(US) + width * SECOND + 1).alias("t"), F.lit(-1).alias("d")),
    )
    return df.withColumn("_m", F.explode(marks)).select(
        *df.columns, F.col("_m.t").alias("_t"), F.col("_m.d").alias("_d")
    )


def _weight_change() -> Column:
    """Change of ``c * log2(c)`` caused by one event, ``_c`` being the count after it."""
    return x_log2_x(F.col("_c")) - x_log2_x(F.col("_c") - F.col("_d"))


def entropy_ordinary(df: DataFrame, keys, values, tie, width, name) -> DataFrame:
    kept = df.columns
    events = _sign_events(df, width)
    # Only the sweep columns travel with the leaving events.
    needed = {*keys, *values, tie, "_t", "_d"}
    events = events.select(*[
        F.col(c) if c in needed else F.when(F.col("_d") > 0, F.col(c)).alias(c)
        for c in events.columns
    ])
    upto = (Window.unboundedPreceding, Window.currentRow)
    order = ["_t", "_d", tie]
    per_value = Window.partitionBy(*keys, *values).orderBy(*order).rowsBetween(*upto)
    per_key = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*upto)
    swept = events.withColumn("_c", F.sum("_d").over(per_value))
    swept = swept.withColumn("_delta", _weight_change())
    swept = swept.withColumns({
        "_n": F.sum("_d").over(per_key), "_s": F.sum("_delta").over(per_key),
    })
    return swept.where(F.col("_d") > 0).withColumn(
        name, entropy_from_sums(F.col("_n"), F.col("_s"))
    ).select(*kept, name)


def entropy_spread(laid: DataFrame, keys, values, width, name) -> DataFrame:
    events = _sign_events(laid.select(*dict.fromkeys([*keys, *values, US, CHUNK, ROW])), width)
    events = events.withColumnsRenamed({CHUNK: "_ec", ROW: "_er"})
    order = ["_t", "_d", "_ec", "_er"]
    counted = running(events, [*keys, *values], order, {"_c": F.col("_d").cast("bigint")})
    counted = counted.withColumn("_delta", _weight_change())
    swept = running(
        counted, keys, order, {"_n": F.col("_d").cast("bigint"), "_s": F.col("_delta")}
    )
    rows = swept.where(F.col("_d") > 0).select(
        F.col("_ec").alias("_c"), F.col("_er").alias("_r"),
        entropy_from_sums(F.col("_n"), F.col("_s")).alias(name),
    )
    return _attach(laid, rows)


def rolling_entropy(
    df: DataFrame, key: str | list[str], values: list[str], width: int, name: str,
    time: str = "timestamp", tie: str = "click_id", hot_rows: int | None = None,
) -> DataFrame:
    """Add the base-2 entropy of ``values`` over the key's trailing window.

    A sweep over arrivals and departures keeps the work linear in the rows, whatever the
    window holds.
    """
    keys = _keys(key)
    return apply_by_key(
        df, keys, time, tie,
        lambda d: entropy_ordinary(d, keys, values, tie, width, name),
        lambda d: entropy_spread(d, keys, values, width, name),
        hot_rows,
    )


# --- gap and count so far --------------------------------------------------------------

def _gap(previous: Column) -> Column:
    return F.coalesce(
        F.greatest(F.lit(0.0), (F.col(US) - previous) / F.lit(float(SECOND))), F.lit(0.0)
    )


def gap_ordinary(df: DataFrame, keys, tie, name) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(US, tie)
    return df.withColumn(name, _gap(F.lag(US).over(order)))


def gap_spread(laid: DataFrame, keys, name) -> DataFrame:
    return previous_value(laid, keys, US, "_prev").withColumn(
        name, _gap(F.col("_prev"))
    ).drop("_prev")


def inter_click_gap(
    df: DataFrame, key: str | list[str] = "ip", name: str = "ip_inter_click_gap_seconds",
    time: str = "timestamp", tie: str = "click_id", hot_rows: int | None = None,
) -> DataFrame:
    """Add the seconds since the key's previous row; zero for its first."""
    keys = _keys(key)
    return apply_by_key(
        df, keys, time, tie,
        lambda d: gap_ordinary(d, keys, tie, name),
        lambda d: gap_spread(d, keys, name),
        hot_rows,
    )


def count_so_far(
    df: DataFrame, key: str | list[str], order: list[str],
    name: str = "dest_txn_count_so_far", hot_rows: int | None = None,
) -> DataFrame:
    """Add the number of the key's rows before this one in ``order`` (unique within it).

    With hot keys the rows are read several times, so they are stored: before the keys are
    counted where ``hot_rows`` is given, else once hot keys have been found.
    """
    keys = _keys(key)
    if hot_rows is not None:
        df = spill(df, "counted")
    hot = hot_keys(df, keys, hot_rows)
    if hot and hot_rows is None:
        df = spill(df, "counted")
    cold, large = hot.split(df, keys) if hot else (df, None)
    window = Window.partitionBy(*keys).orderBy(*order)
    out = cold.withColumn(name, (F.row_number().over(window) - 1).cast("bigint"))
    if large is not None:
        parts = chunks_for(df.sparkSession, hot.rows)
        ranked = running(large, keys, order, {name: F.lit(1).cast("bigint")}, parts)
        out = out.unionByName(ranked.withColumn(name, F.col(name) - 1))
    return out
