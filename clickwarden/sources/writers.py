"""Sinks: CSV, keyed JSON messages, insert-only tables, catalog tables and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from clickwarden import schemas
from clickwarden.operators.eda import head_sample
from clickwarden.runtime import spill
from clickwarden.sources.readers import read_scored, schema_path, stored_schema

CSV_TIME = "yyyy-MM-dd HH:mm:ss"


def write_clicks(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Canonical click CSV in fixed column order; null becomes empty text."""
    df.select(*schemas.CLICK_COLUMNS).write.mode(mode).option("header", True).option(
        "timestampFormat", CSV_TIME).option("emptyValue", "").csv(path)


def write_head(df: DataFrame, path: str, n: int = 1_000,
               order: list[str] = ("timestamp", "click_id")) -> None:
    write_clicks(head_sample(df, n, list(order)), path)


def click_messages(df: DataFrame, key: str = "ip") -> DataFrame:
    """Rows as ``key`` and compact JSON ``value``; null fields are written out."""
    value = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def write_click_stream(df: DataFrame, key: str = "ip", fmt: str = "kafka", **options) -> None:
    """Publish rows as keyed messages, so that one IP stays in one partition."""
    click_messages(df, key).write.format(fmt).options(**options).mode("append").save()


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_snapshots(campaign: DataFrame, publisher: DataFrame, path: str,
                    mode: str = "overwrite") -> None:
    """Store both snapshots as one table with a ``side`` column."""
    sides = [d.withColumn("side", F.lit(n)) for n, d in
             (("campaign", campaign), ("publisher", publisher))]
    sides[0].unionByName(sides[1], allowMissingColumns=True).write.mode(mode).partitionBy(
        "side").parquet(path)


def load_snapshots(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    table = spark.read.parquet(path)
    return {side: table.where(F.col("side") == side).drop("side")
            for side in ("campaign", "publisher")}


# Partition values of a batch that reach the driver; with more of them their range stands for all.
PARTITION_VALUES = 1000

_COMMIT = T.StructType([
    T.StructField("version", T.LongType()), T.StructField("committed_at", T.TimestampType()),
    T.StructField("operation", T.StringType()), T.StructField("rows", T.LongType()),
])


def _commits_path(path: str) -> str:
    return path.rstrip("/") + ".commits"


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where no folder is yet. Any other failure to read it is raised."""
    try:
        return read_scored(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def distinct_on(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, the smallest by its plain columns, so that the choice repeats.

    An aggregate, combined before the shuffle: many copies of one key stay cheap.
    """
    nested = (T.MapType, T.ArrayType, T.StructType)
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, nested)]
    # grouping makes one value of the zeros, so such keys stay in the row
    outside = [k for k in keys if not isinstance(df.schema[k].dataType, (*nested, T.FloatType, T.DoubleType))]
    rest = [c for c in df.columns if c not in outside]
    if len(plain) == len(df.columns) and rest and len(set(outside)) == len(outside):
        # all columns are plain: each travels once, keys beside the row
        row = df.groupBy(*outside, *[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys) if k not in outside]).agg(
            F.min(F.struct(*rest)).alias("_row"))
        return row.select(*[F.col(c) if c in outside else F.col("_row")[c].alias(c) for c in df.columns])
    picked = df.groupBy(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)]).agg(
        F.min_by(F.struct(*df.columns), F.struct(*plain)).alias("_row"))
    return picked.select("_row.*")


def upsert_insert_only(
    df: DataFrame, path: str, keys: list[str], partition_by: list[str] = (), prune: bool = False,
) -> int:
    """Append the rows whose keys the table lacks; returns how many were added.

    Running it again adds nothing. New columns widen the table. With ``prune`` the partition
    must follow from the key, and only the batch's partitions are looked at. The table's keys are cut down to those of the batch first, so the large side is scanned but
    not shuffled when the batch is small. One writer at a time.
    """
    spark = df.sparkSession
    target = _existing(spark, path)
    rows = distinct_on(df, keys)
    if target is not None:
        rows = spill(rows, "batch")
        for column in partition_by if prune else ():
            # The scan skips the partitions the batch does not touch; of a backfill, those outside its range.
            values = [r[0] for r in rows.select(column).distinct().limit(PARTITION_VALUES + 1).collect()]
            if len(values) > PARTITION_VALUES:
                low, high, nulls = rows.agg(F.min(column), F.max(column), F.count_if(F.col(column).isNull())).first()
                found = F.col(column).between(low, high)
            else:
                nulls, known = None in values, [v for v in values if v is not None]
                found = F.col(column).isin(known)
            target = target.where(found | F.col(column).isNull() if nulls else found)
        # Null keys are equal to null keys, else they would be added by every run.
        batch = rows.select(*[F.col(k).alias(f"_b{i}") for i, k in enumerate(keys)])
        in_batch, known_to = F.lit(True), F.lit(True)
        for i, key in enumerate(keys):
            in_batch = in_batch & F.col(key).eqNullSafe(F.col(f"_b{i}"))
            known_to = known_to & F.col(key).eqNullSafe(F.col(f"_k{i}"))
        known = target.select(*keys).join(batch, in_batch, "left_semi").distinct().select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
        # Stored, so that Spark knows that they are few and leaves the rows where they lie.
        known = spill(known, "known")
        if not known.isEmpty():
            rows = spill(rows.join(known, known_to, "left_anti"), "insert")
    if target is None:  # all rows are new, and the table's own files tell their number
        _keep_schema(rows, path)
        rows.write.mode("append").option("compression", "zstd").partitionBy(*partition_by).parquet(path)
        added = spark.read.schema(rows.schema).parquet(path).count()
    else:
        added = rows.count()
        if added:
            _keep_schema(rows, path)
            rows.write.mode("append").option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    _log_commit(spark, path, "MERGE" if target is not None else "CREATE", added)
    return added


def _keep_schema(rows: DataFrame, path: str) -> None:
    """Store the table's schema, widened by new columns, before rows that have them: a reader
    then looks into no footers. Where the file is missing, readers merge the footers."""
    spark = rows.sparkSession
    known = stored_schema(spark, path)
    if known is None:
        table = _existing(spark, path)
        known = table.schema if table is not None else T.StructType([])
        wider = None
    else:
        wider = known
    fields = [T.StructField(f.name, f.dataType) for f in known.fields]
    fields += [T.StructField(f.name, f.dataType) for f in rows.schema.fields if f.name not in known.fieldNames()]
    schema = T.StructType(fields)
    if schema != wider:
        spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(schema_path(path))


def _log_commit(spark: SparkSession, path: str, operation: str, rows: int) -> None:
    log = _existing(spark, _commits_path(path))
    last = log.agg(F.max("version")).first()[0] if log is not None else None
    version = 0 if last is None else last + 1
    spark.range(1).select(
        F.lit(version).cast("bigint").alias("version"),
        F.current_timestamp().alias("committed_at"), F.lit(operation).alias("operation"),
        F.lit(rows).cast("bigint").alias("rows"),
    ).write.mode("append").parquet(_commits_path(path))


def commit_history(spark: SparkSession, path: str) -> DataFrame:
    """Commits of a table, newest first."""
    return spark.read.schema(_COMMIT).parquet(_commits_path(path)).orderBy(F.desc("version"))


def publish_batch_table(
    df: DataFrame, table: str = schemas.BATCH_TABLE, database: str = schemas.DATABASE,
    location: str | None = None,
) -> str:
    """Create the database when needed and overwrite the scored table in it."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    name = f"{database}.{table}"
    writer = df.write.mode("overwrite").format("parquet")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)
    return name
