"""Order-dependent building blocks that stay balanced under any skew.

A plain window puts all rows of one key into one task. The functions here instead lay the
rows out by range of (key, order) into chunks of about equal size, work inside the chunks,
and carry one small total per chunk across the borders. A key, a time bucket or a set of
tied rows may then hold any share of the table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickwarden.runtime import CHUNK_ROWS, hot_key_rows, spill

CHUNK, ROW = "_chunk", "_row"
_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above the low 33 bits


def _columns(names):
    return [F.col(n) if isinstance(n, str) else n for n in names]


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def lay_out(df: DataFrame, order: list, parts: int | None = None) -> DataFrame:
    """Range-partition by ``order`` and store the rows with ``_chunk`` and ``_row``.

    ``(_chunk, _row)`` is the place of a row in the total order. It depends on the
    physical layout, hence the stored copy. End ``order`` in a unique column for results
    that repeat.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = _columns(order)
    place = F.monotonically_increasing_id()
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = placed.withColumn("_place", place)
    placed = placed.withColumn(CHUNK, F.shiftright("_place", _ROW_BITS))
    placed = placed.withColumn(ROW, F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    return spill(placed.drop("_place"), "ordered")


def _starts(laid: DataFrame) -> DataFrame:
    """First global index of every chunk; one row per chunk."""
    before = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    sizes = laid.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("_size"))
    return sizes.select(
        CHUNK, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )


def index_laid(laid: DataFrame, name: str = "row_index") -> DataFrame:
    """Add the zero-based global index to laid-out rows."""
    out = laid.join(F.broadcast(_starts(laid)), CHUNK)
    return out.withColumn(name, F.col("_start") + F.col(ROW)).drop("_start")


def global_index(
    df: DataFrame, order: list, name: str = "row_index", parts: int | None = None
) -> DataFrame:
    """Zero-based index of every row in ``order``, without a single-task window."""
    return index_laid(lay_out(df, order, parts), name).drop(CHUNK, ROW)


def running(
    df: DataFrame, keys: list[str], order: list, sums: dict[str, Column],
    parts: int | None = None,
) -> DataFrame:
    """Add inclusive running sums per key over ``order``.

    ``sums`` maps new columns to the values to add up. Only the first key of a chunk can
    have earlier rows, so at most one carry row per chunk is broadcast.
    """
    staged = df.withColumns({f"_v_{name}": value for name, value in sums.items()})
    laid = lay_out(staged, [*keys, *order], parts)
    local = Window.partitionBy(CHUNK, *keys).orderBy(ROW).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(CHUNK).rowsBetween(
        Window.unboundedPreceding, -1
    )
    totals = laid.groupBy(CHUNK, *keys).agg(
        *[F.sum(f"_v_{name}").alias(f"_t_{name}") for name in sums]
    )
    carry = totals.select(
        F.col(CHUNK).alias("_c_chunk"),
        *[F.col(k).alias(f"_c_{i}") for i, k in enumerate(keys)],
        F.count(F.lit(1)).over(earlier).alias("_c_rows"),
        *[F.sum(f"_t_{name}").over(earlier).alias(f"_c_{name}") for name in sums],
    ).where(F.col("_c_rows") > 0)
    on = F.col(CHUNK) == F.col("_c_chunk")
    for i, key in enumerate(keys):
        on = on & same(F.col(key), F.col(f"_c_{i}"))
    out = laid.withColumns({name: F.sum(f"_v_{name}").over(local) for name in sums})
    out = out.join(F.broadcast(carry), on, "left")
    for name in sums:
        zero = F.lit(0).cast(out.schema[name].dataType)
        out = out.withColumn(name, F.col(name) + F.coalesce(F.col(f"_c_{name}"), zero))
    return out.select(*df.columns, *sums)


def previous_value(laid: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Add the ``value`` of the key's preceding row to laid-out rows (null for its first).

    Chunks without rows do not appear, so the preceding chunk is found by a lag over the
    list of chunks.
    """
    inside = Window.partitionBy(CHUNK, *keys).orderBy(ROW)
    last = laid.groupBy(CHUNK).agg(
        F.max_by(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)],
                          F.col(value).alias("v")), ROW).alias("_last")
    )
    last = last.select(
        F.col(CHUNK).alias("_p_chunk"), F.lag("_last").over(Window.orderBy(CHUNK)).alias("_last")
    )
    out = laid.withColumn("_inside", F.lag(value).over(inside))
    out = out.join(F.broadcast(last), (F.col(CHUNK) == F.col("_p_chunk")) & (F.col(ROW) == 0),
                   "left")
    linked = F.col("_last").isNotNull()
    for i, key in enumerate(keys):
        linked = linked & same(F.col(key), F.col(f"_last.k{i}"))
    return out.withColumn(
        name, F.when(linked, F.col("_last.v")).otherwise(F.col("_inside"))
    ).drop("_inside", "_p_chunk", "_last")


class HotKeys:
    """Keys too large for one task: their stored table and their row count."""

    def __init__(self, listed: DataFrame, rows: int):
        self.listed, self.rows = listed, rows

    def split(self, df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
        """``(cold, hot)`` rows of ``df``."""
        on = F.lit(True)
        for i, key in enumerate(keys):
            on = on & same(F.col(key), F.col(f"_h{i}"))
        return df.join(self.listed, on, "left_anti"), df.join(self.listed, on, "left_semi")


def hot_keys(df: DataFrame, keys: list[str], limit: int | None = None) -> HotKeys | None:
    """Find the keys with more than ``limit`` rows; None when there are none.

    Counts rows per key, combined before the shuffle. The list, whatever its length, is a
    stored table, and Spark chooses how to join it.
    """
    limit = limit or hot_key_rows(df.sparkSession)
    large = spill(
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
        .select(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)], "_n"), "hot-keys")
    rows = large.agg(F.sum("_n")).first()[0]
    return HotKeys(large.drop("_n"), rows) if rows else None


def chunks_for(spark, rows: int) -> int:
    """Number of chunks for a known number of rows, at least the shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // CHUNK_ROWS))


def _order_literal(value, kind: T.DataType) -> Column:
    if isinstance(kind, _TIMES):
        stamp = F.timestamp_micros(F.lit(value))
        return stamp.cast(kind) if isinstance(kind, T.TimestampNTZType) else stamp
    return F.lit(value).cast(kind)


_INTEGRAL = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
_TIMES = (T.TimestampType, T.TimestampNTZType)
_BUCKETS = 10_000


def _as_integer(df: DataFrame, name: str) -> Column | None:
    kind = df.schema[name].dataType
    if isinstance(kind, _TIMES):
        return F.unix_micros(F.col(name).cast("timestamp"))
    return F.col(name).cast("bigint") if isinstance(kind, _INTEGRAL) else None


def _histogram(
    df: DataFrame, value: Column
) -> tuple[int, int, int, list[tuple[int, int]]] | None:
    """Lowest and highest value, bucket width and row counts of at most ``_BUCKETS`` buckets.

    Null values sort first and count as bucket -1.
    """
    ends = df.agg(F.min(value).alias("a"), F.max(value).alias("b")).first()
    if ends["a"] is None:
        return None
    span = ends["b"] - ends["a"]
    width = span // _BUCKETS + 1
    # Whole-number division. A span beyond a long is reckoned in decimals.
    kind = "bigint" if span < 1 << 63 else "decimal(20,0)"
    offset = value.cast(kind) - F.lit(str(ends["a"])).cast(kind)
    bucket = F.call_function("div", offset, F.lit(str(width)).cast(kind))
    counts = df.groupBy(F.coalesce(bucket.cast("bigint"), F.lit(-1)).alias("b")).agg(
        F.count(F.lit(1)).alias("n")).collect()
    return ends["a"], ends["b"], width, sorted((row["b"], row["n"]) for row in counts)


def rows_at(df: DataFrame, order: list[str], positions: list[int]) -> dict[int, tuple]:
    """Order values of the rows at a few zero-based positions.

    A histogram of the first order column, combined before the shuffle, tells which
    buckets hold the positions. Only rows of these buckets are sorted, by their order
    columns alone. Times come back as microseconds. Positions beyond the table have no
    entry; a position within it that is not found raises.
    """
    if not positions:
        return {}
    narrow = df.select(*order)
    value = _as_integer(df, order[0])
    found = _histogram(narrow, value) if value is not None else None
    if found is None:
        return _rows_at_sorted(df, narrow, order, {p: p for p in positions})
    low, high, width, counts = found
    kind, column = df.schema[order[0]].dataType, F.col(order[0])
    keep, inside, start, kept = F.lit(False), {}, 0, 0
    for bucket, rows in counts:
        hits = [p for p in positions if start <= p < start + rows]
        if hits:
            # Bucket edges may lie beyond a narrow integer type.
            edge = kind if isinstance(kind, _TIMES) else T.LongType()
            first = _order_literal(low + bucket * width, edge)
            last = _order_literal(min(low + (bucket + 1) * width - 1, high), edge)
            keep = keep | (column.isNull() if bucket < 0 else (column >= first) & (column <= last))
            # The kept buckets are sorted together, one after the other.
            inside.update({p - start + kept: p for p in hits})
            kept += rows
        start += rows
    rows = _rows_at_sorted(df, narrow.where(keep), order, inside) if inside else {}
    lost = [p for p in positions if 0 <= p < start and p not in rows]
    if lost:
        raise RuntimeError(f"rows at positions {lost[:5]} of {start} were not found")
    return rows


def _rows_at_sorted(
    df: DataFrame, part: DataFrame, order: list[str], inside: dict[int, int]
) -> dict[int, tuple]:
    indexed = index_laid(lay_out(part, order)).where(F.col("row_index").isin(*inside))
    picked = [
        _as_integer(df, name).alias(name)
        if isinstance(df.schema[name].dataType, _TIMES) else F.col(name)
        for name in order
    ]
    return {
        inside[row["row_index"]]: tuple(row[name] for name in order)
        for row in indexed.select("row_index", *picked).collect()
    }


def before_row(df: DataFrame, order: list[str], row: tuple) -> Column:
    """Filter for rows that come before ``row`` in ``order``, nulls first.

    Plain comparisons with literals, so that scans can skip files by their statistics.
    """
    condition = F.lit(False)
    for name, value in reversed(list(zip(order, row))):
        column = F.col(name)
        if value is None:
            condition = column.isNull() & condition
            continue
        edge = _order_literal(value, df.schema[name].dataType)
        condition = column.isNull() | (column < edge) | ((column == edge) & condition)
    return condition


def quantiles(
    df: DataFrame, column: str, probabilities: list[float], nearest_rank: bool = False
) -> DataFrame:
    """Exact quantiles of a column, one row per probability: ``(p, value)``.

    Values are counted first and the running count is taken over ranges of values, so
    neither many rows nor many distinct values land in one task. Linear interpolation
    between the two neighbours, or the nearest rank ``max(0, ceil(p * n) - 1)``.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("_n")
    )
    ranked = running(counts, [], [column], {"_upto": F.col("_n")})
    total = ranked.agg(F.max("_upto")).first()[0] or 0
    rows = []
    for p in probabilities:
        if nearest_rank:
            low = high = max(0, math.ceil(p * total) - 1)
            share = 0.0
        else:
            low, high = math.floor(p * (total - 1)), math.ceil(p * (total - 1))
            share = p * (total - 1) - low
        # The value at index k is the smallest one whose running count exceeds k.
        a = F.min(F.when(F.col("_upto") > low, F.col(column)))
        b = F.min(F.when(F.col("_upto") > high, F.col(column)))
        if not nearest_rank:
            a, b = a.cast("double"), b.cast("double")
            a = a + (b - a) * F.lit(share)
        rows.append(F.struct(F.lit(float(p)).alias("p"), a.alias("value")))
    return ranked.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))
