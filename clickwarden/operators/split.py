"""Splits of a table along its time order.

Border rows are found from the order columns alone; the splits themselves are plain
filters, which scans can use to skip files. Rows that agree in all order columns stay on
the same side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwarden.operators.ordering import before_row, rows_at


def split_at(df: DataFrame, order: list[str], position: int) -> tuple[DataFrame, DataFrame]:
    """The first ``position`` rows in ``order``, and the rest; all rows when there are fewer."""
    edge = rows_at(df, order, [position]).get(position)
    if edge is None:
        return df, df.limit(0)
    early = before_row(df, order, edge)
    return df.where(early), df.where(~early)


def chronological_split(
    df: DataFrame, test_fraction: float = 0.2, order: list[str] = ("timestamp", "click_id")
) -> tuple[DataFrame, DataFrame]:
    """Training rows before the cut at ``int(n * (1 - test_fraction))``, test rows after."""
    if not 0 < test_fraction < 0.5:
        raise ValueError("test_fraction must be between 0 and 0.5")
    return split_at(df, list(order), int(df.count() * (1 - test_fraction)))


def split_history(
    df: DataFrame, order: list[str] = ("timestamp", "click_id")
) -> tuple[DataFrame, DataFrame]:
    """Earlier and later half of the rows."""
    return split_at(df, list(order), df.count() // 2)


def walk_forward_folds(
    df: DataFrame, folds: int = 5, order: list[str] = ("timestamp", "click_id"),
    name: str = "block",
) -> DataFrame:
    """Number ``folds + 1`` successive blocks of about equal size from zero.

    Fold ``i`` (from 1) trains on the blocks below ``i`` and tests on block ``i``.
    """
    size, extra = divmod(df.count(), folds + 1)
    starts = [b * size + min(b, extra) for b in range(1, folds + 1)]
    edges = rows_at(df, list(order), starts)
    block = F.lit(folds)
    for number in range(folds, 0, -1):
        edge = edges.get(starts[number - 1])
        if edge is not None:
            block = F.when(before_row(df, list(order), edge), number - 1).otherwise(block)
    return df.withColumn(name, block.cast("int"))


def fold(df: DataFrame, number: int, name: str = "block") -> tuple[DataFrame, DataFrame]:
    """Training and test rows of one walk-forward fold."""
    return df.where(F.col(name) < number), df.where(F.col(name) == number)
