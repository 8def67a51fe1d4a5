"""Scans of click and transaction data in files, tables and streams."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickwarden import schemas
from clickwarden.functions import blank_to_null, parse_timestamp
from clickwarden.operators.ordering import global_index


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns to the schema's types; columns the source lacks become null."""
    out = []
    for field in schema.fields:
        if field.name not in df.columns:
            column = F.lit(None).cast(field.dataType)
        elif isinstance(field.dataType, T.TimestampType):
            column = parse_timestamp(field.name, df.schema[field.name].dataType)
        elif isinstance(field.dataType, T.StringType):
            column = F.col(field.name)
        else:
            column = blank_to_null(F.col(field.name)).try_cast(field.dataType)
        out.append(column.alias(field.name))
    return df.select(*out)


def _require(df: DataFrame, names: list[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"source lacks columns: {missing}")
    return df


def read_raw_clicks(
    spark: SparkSession, path: str, numbered: str | None = None
) -> DataFrame:
    """Raw click CSV with a header, all columns as text; fails on missing columns.

    ``numbered`` names a column for the zero-based row number in the source: files by
    path, and within a file the order of its lines. Every split of a file is read by one
    task from its start, so split offset and row id give the line order.
    """
    df = spark.read.option("header", True).csv(path)
    text = [
        F.coalesce(F.col(c), F.lit("")).alias(c) for c in schemas.RAW_CLICK_COLUMNS
    ]
    df = _require(df, schemas.RAW_CLICK_COLUMNS)
    if numbered is None:
        return df.select(*text)
    placed = df.select(
        *text, F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"))
    return global_index(placed, ["_file", "_block", "_line"], numbered).drop(
        "_file", "_block", "_line")


def read_clicks(spark: SparkSession, path: str) -> DataFrame:
    """Canonical click CSV with parsed times, flags and deltas."""
    df = spark.read.option("header", True).csv(path)
    return _typed(_require(df, schemas.CLICK_COLUMNS), schemas.CLICK)


def read_transactions(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Transaction CSV. The schema is fixed unless ``infer`` asks for a second pass."""
    if infer:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    df = spark.read.option("header", True).csv(path)
    return _typed(_require(df, schemas.TRANSACTION.fieldNames()), schemas.TRANSACTION)


def read_staging(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All JSON files below ``path``, whatever the bucket folders are called."""
    reader = spark.read.option("recursiveFileLookup", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    """A table written by ``upsert_insert_only``; older files lack newer columns."""
    stored = stored_schema(spark, path)
    if stored is not None:
        return spark.read.schema(stored).parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def schema_path(path: str) -> str:
    return path.rstrip("/") + ".schema"


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema that the table's writer keeps beside it, None where there is none."""
    try:
        row = spark.read.schema("value string").text(schema_path(path), wholetext=True).where("value != ''").first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return T.StructType.fromJson(json.loads(row["value"])) if row else None


def read_table(spark: SparkSession, name: str = schemas.BATCH_TABLE,
               database: str = schemas.DATABASE) -> DataFrame:
    return spark.table(f"{database}.{name}")


def read_snapshots(spark: SparkSession, path: str, lines: bool = False) -> dict[str, DataFrame]:
    """Conversion snapshot JSON as ``campaign`` and ``publisher`` tables.

    A file is one object with both sides keyed by id; with ``lines`` every line is such an
    object with some of the ids, which suits many ids. An entry is an object with counts,
    or a bare number that is the rate itself.
    """
    text = spark.read.text(path, wholetext=not lines)
    tables = {}
    for side in ("campaign", "publisher"):
        outer = F.from_json("value", "map<string,map<string,string>>").getItem(side)
        entry = F.from_json("entry", "map<string,string>")
        rows = text.select(F.explode(outer).alias("id", "entry"))
        tables[side] = rows.select(
            "id",
            F.coalesce(entry.getItem("clicks").try_cast("bigint"), F.lit(0)).alias("clicks"),
            F.coalesce(entry.getItem("attributed").try_cast("bigint"), F.lit(0)).alias("attributed"),
            F.col("entry").try_cast("double").alias("rate"),
        )
    return tables


def read_click_stream(
    spark: SparkSession, fmt: str = "kafka", starting: str = "latest", **options
) -> DataFrame:
    """Streaming source as one text column ``value``.

    ``fmt="kafka"`` takes the usual options (``kafka.bootstrap.servers``, ``subscribe``,
    ``kafka.group.id``); file formats take ``path``.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", starting)
    return reader.load().select(F.col("value").cast("string").alias("value"))
