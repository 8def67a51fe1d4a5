"""Ids, ratios and flag checks as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(*parts: Column) -> Column:
    """128-bit hex id of the parts joined with a bar; null parts count as empty text."""
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def click_id(
    ip: Column, device: Column, os: Column, app: Column, channel: Column, click_time: Column
) -> Column:
    return stable_id(ip, device, os, app, channel, click_time)


def txn_key(orig: Column, dest: Column, step: Column, amount: Column) -> Column:
    """Join key of a transaction. The amount goes through a decimal, so that its text is
    the same on every engine."""
    return F.concat_ws(
        "|", orig, dest, step.cast("string"), amount.cast("decimal(18,2)").cast("string")
    )


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Zero where the denominator is zero or either side is null."""
    return F.coalesce(
        F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0)
    )


def is_integer_like(column: Column) -> Column:
    """Text of a whole number, blanks around it allowed; null gives false."""
    return F.coalesce(column.cast("string").rlike(r"^\s*[+-]?\d+\s*$"), F.lit(False))


def is_zero_or_one(column: Column) -> Column:
    number = F.trim(column.cast("string")).try_cast("bigint")
    return is_integer_like(column) & F.coalesce(number.isin(0, 1), F.lit(False))


def padded_id(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def x_log2_x(count: Column, scale: int = 100_000_000) -> Column:
    """``count * log2(count)`` as a scaled whole number, zero for counts below two.

    Whole numbers make running sums exact and independent of their order, so they do not
    drift on long keys.
    """
    return F.when(
        count > 1, F.round(count * F.log2(count.cast("double")) * F.lit(float(scale)))
    ).otherwise(F.lit(0.0)).cast("bigint")


def entropy_from_sums(total: Column, weighted: Column, scale: int = 100_000_000) -> Column:
    """Base-2 entropy from a bag's size and its summed ``x_log2_x`` counts.

    Both terms carry the same rounding, so a bag of one value has exactly no entropy.
    """
    bits = (x_log2_x(total, scale) - weighted) / (total * F.lit(float(scale)))
    return F.when(total > 0, F.greatest(F.lit(0.0), bits)).otherwise(F.lit(0.0))
