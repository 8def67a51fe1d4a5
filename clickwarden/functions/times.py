"""Time parsing and time arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_timestamp(column: Column | str, kind: T.DataType | None = None) -> Column:
    """Epoch numbers, ISO-8601 text or ``yyyy-MM-dd HH:mm:ss`` text to a timestamp.

    ``kind`` is the type of the column. Numbers are epoch seconds, text without an offset
    is taken in the session time zone (UTC), and text that is no time gives null.
    """
    column = F.col(column) if isinstance(column, str) else column
    if isinstance(kind, T.NumericType):
        return F.timestamp_seconds(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return column.cast("timestamp")
    return blank_to_null(column).try_cast("timestamp")


def parse_times(df: DataFrame, *columns: str) -> DataFrame:
    """Parse the named columns of ``df`` by their own types."""
    return df.withColumns({
        name: parse_timestamp(name, df.schema[name].dataType) for name in columns
    })


def micros(df: DataFrame, column: str) -> Column:
    """The column as epoch microseconds; bigint columns are taken as such already."""
    if isinstance(df.schema[column].dataType, T.LongType):
        return F.col(column)
    return F.unix_micros(F.col(column).cast("timestamp"))


def is_blank(column: Column) -> Column:
    """Null or empty text."""
    return column.isNull() | (column.cast("string") == "")


def blank_to_null(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def seconds_between(start: Column, end: Column) -> Column:
    """``end - start`` in seconds, fractions kept, sign kept."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def clamped_seconds(start: Column, end: Column) -> Column:
    """``end - start`` in seconds, never below zero."""
    return F.greatest(F.lit(0.0), seconds_between(start, end))


def install_delta(click_time: Column, attributed_time: Column) -> Column:
    """Whole seconds from click to install; null without an install, may be negative."""
    return F.unix_seconds(attributed_time) - F.unix_seconds(click_time)


def click_to_install_seconds(
    delta: Column, timestamp: Column, attributed_time: Column
) -> Column:
    """The given delta when there is one, else the clamped time difference, else zero."""
    return F.coalesce(
        delta.cast("double"), clamped_seconds(timestamp, attributed_time), F.lit(0.0)
    )


def latency_ms(published: Column, scored: Column) -> Column:
    """Milliseconds from publishing to scoring, three digits, never below zero."""
    return F.greatest(
        F.lit(0.0),
        F.round((F.unix_micros(scored) - F.unix_micros(published)) / F.lit(1000.0), 3),
    )


def hour_prefix(column: Column) -> Column:
    """The ``yyyy-MM-dd HH`` text of a timestamp."""
    return F.date_format(column, "yyyy-MM-dd HH")


def plus_seconds(column: Column, seconds: Column) -> Column:
    return F.timestamp_micros(
        F.unix_micros(column) + seconds.cast("bigint") * F.lit(1_000_000)
    )
