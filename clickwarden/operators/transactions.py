"""Payment transactions: type filter, join key, features and time split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwarden import schemas
from clickwarden.functions import txn_key as key_of
from clickwarden.operators.ordering import quantiles
from clickwarden.operators.windows import count_so_far


def filter_types(df: DataFrame, types: list[str] = tuple(schemas.SCORABLE_TYPES)) -> DataFrame:
    return df.where(F.col("type").isin(*types))


def txn_key(df: DataFrame, name: str = "txn_key") -> DataFrame:
    return df.withColumn(name, key_of(
        F.col("nameOrig"), F.col("nameDest"), F.col("step"), F.col("amount")))


def transaction_columns(df: DataFrame) -> DataFrame:
    """Join key and the features that need no other rows."""
    return txn_key(df).withColumns({
        "is_transfer_type": F.lit(1),
        "amount_to_balance_ratio": F.try_divide(
            F.col("amount").cast("double"), F.col("oldbalanceOrg").cast("double") + 1),
    })


def transaction_features(
    df: DataFrame, order: list[str] = ("step", "nameOrig"), keep: list[str] = ()
) -> DataFrame:
    """Scorable transactions with join key and the four features.

    ``order`` should end in a unique column, so that the counts per destination repeat.
    """
    scorable = transaction_columns(filter_types(df))
    wanted = dict.fromkeys([
        *schemas.TRANSACTION_FEATURES, "isFraud", "step", "nameDest", "txn_key", *keep,
    ])
    needed = dict.fromkeys(["nameDest", *order, *wanted])
    narrow = scorable.select(*[c for c in needed if c != "dest_txn_count_so_far"])
    return count_so_far(narrow, "nameDest", list(order)).select(*wanted)


def split_by_quantile(
    df: DataFrame, column: str = "step", probability: float = 0.8
) -> tuple[DataFrame, DataFrame]:
    """Rows up to the interpolated quantile, and rows beyond it."""
    edge = quantiles(df.select(column), column, [probability]).first()["value"]
    return df.where(F.col(column) <= F.lit(edge)), df.where(F.col(column) > F.lit(edge))


def filter_impact(df: DataFrame, types: list[str] = tuple(schemas.SCORABLE_TYPES)) -> DataFrame:
    """Share of rows the type filter removes and share of fraud it keeps."""
    kept = F.coalesce(F.col("type").isin(*types), F.lit(False))
    fraud = F.col("isFraud") == 1
    totals = df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(kept).alias("kept"),
        F.count_if(fraud).alias("fraud"), F.count_if(fraud & kept).alias("fraud_kept"),
    )
    return totals.select(
        "total", "kept", "fraud", "fraud_kept",
        F.coalesce(F.try_divide(F.col("total") - F.col("kept"), F.col("total")), F.lit(0.0))
        .alias("removed_share"),
        F.coalesce(F.try_divide("fraud_kept", "fraud"), F.lit(0.0)).alias("fraud_recall"),
    )
