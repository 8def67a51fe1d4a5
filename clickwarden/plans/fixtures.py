"""Clicks, transactions and scored pairs derived from the given tables.

Each fixture exists twice: as a DataFrame and as a SQL common table expression for the
oracle. Click times are compressed so that windows of minutes hold several clicks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwarden.functions import stable_id

START_US = 1_704_067_200_000_000
SQUEEZE = 600


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def clicks(spark: SparkSession, sf: str, tied: bool = False) -> DataFrame:
    """Canonical clicks with ``seq`` and ``us``; ``tied`` cuts times to whole minutes."""
    events = table(spark, sf, "events")
    us = F.lit(START_US) + F.expr(f"(unix_micros(cast(ts as timestamp)) - {START_US}) div {SQUEEZE}")
    if tied:
        us = us - F.pmod(us, F.lit(60_000_000))
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    hit = (F.col("event_type") == "purchase") & (k < 5)
    base = events.select(
        F.col("event_id").alias("seq"), us.alias("us"), F.col("user_id").cast("string").alias("ip"),
        k.alias("k"), F.col("event_type").alias("os"), "value", hit.alias("hit"))
    base = base.withColumns({
        "device_id": (F.col("k") % 10).cast("string"),
        "campaign_id": (F.col("k") % 20).cast("string"),
        "publisher_id": (F.col("k") % 7).cast("string"),
        "ad_id": F.col("k").cast("string"),
    })
    installed = F.col("us") + F.round(F.col("value") * 1_000_000).cast("bigint")
    return base.select(
        "seq", "us",
        stable_id(*[F.col(c) for c in ("ip", "device_id", "os", "ad_id", "campaign_id", "us", "seq")])
        .alias("click_id"),
        "ad_id", "campaign_id", "publisher_id", "device_id", "ip", "os",
        F.timestamp_micros("us").alias("timestamp"), F.timestamp_micros("us").alias("click_time"),
        F.when(F.col("hit"), F.timestamp_micros(installed)).alias("attributed_time"),
        F.col("hit").cast("int").alias("is_attributed"),
        F.lit(None).cast("double").alias("click_to_install_delta"),
        F.lit(0).alias("is_synthetic"), F.lit(0).alias("is_fraud"),
    )


def hot_clicks(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks of which one IP, one device and one minute hold most, and one moment a fifth."""
    minute = F.lit(START_US) + F.col("us") % 60_000_000
    us = F.when(F.col("seq") % 5 == 0, START_US + 30_000_000).when(F.col("seq") % 3 > 0, minute).otherwise(F.col("us"))
    return clicks(spark, sf).withColumns({
        "us": us, "ip": F.when(F.col("seq") % 10 < 8, "hot").otherwise(F.col("ip")),
        "device_id": F.when(F.col("seq") % 7 < 5, "0").otherwise(F.col("device_id")),
    }).withColumn("timestamp", F.timestamp_micros("us"))


def _clicks_sql(us: str) -> str:
    return f"""
raw_k AS (
  SELECT event_id AS seq, {us} AS us, CAST(user_id AS VARCHAR) AS ip, event_type AS os, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
  FROM events),
clicks AS (
  SELECT seq, us, md5(concat_ws('|', ip, CAST(k % 10 AS VARCHAR), os, CAST(k AS VARCHAR),
             CAST(k % 20 AS VARCHAR), CAST(us AS VARCHAR), CAST(seq AS VARCHAR))) AS click_id,
         CAST(k AS VARCHAR) AS ad_id, CAST(k % 20 AS VARCHAR) AS campaign_id,
         CAST(k % 7 AS VARCHAR) AS publisher_id, CAST(k % 10 AS VARCHAR) AS device_id, ip, os,
         CASE WHEN os = 'purchase' AND k < 5
              THEN us + CAST(round(value * 1000000) AS BIGINT) END AS attributed_us,
         CAST(CASE WHEN os = 'purchase' AND k < 5 THEN 1 ELSE 0 END AS INTEGER) AS is_attributed
  FROM raw_k)"""


_US = f"{START_US} + (epoch_us(ts) - {START_US}) // {SQUEEZE}"
CLICKS_SQL = _clicks_sql(_US)
HOT_SQL = CLICKS_SQL.replace("clicks AS (", "plain AS (") + f""",
clicks AS (
  SELECT * REPLACE (
    CASE WHEN seq % 5 = 0 THEN {START_US} + 30000000 WHEN seq % 3 > 0 THEN {START_US} + us % 60000000 ELSE us END AS us,
    CASE WHEN seq % 10 < 8 THEN 'hot' ELSE ip END AS ip, CASE WHEN seq % 7 < 5 THEN '0' ELSE device_id END AS device_id)
  FROM plain)"""
TIED_SQL = _clicks_sql(f"(({_US}) // 60000000) * 60000000")


def raw_clicks(spark: SparkSession, sf: str) -> DataFrame:
    """Raw click log columns as text, times in whole seconds."""
    text = "yyyy-MM-dd HH:mm:ss"
    c = clicks(spark, sf)
    return c.select(
        "seq", "ip", F.col("ad_id").alias("app"), F.col("device_id").alias("device"), "os",
        F.col("campaign_id").alias("channel"),
        F.date_format("click_time", text).alias("click_time"),
        F.coalesce(F.date_format("attributed_time", text), F.lit("")).alias("attributed_time"),
        F.col("is_attributed").cast("string").alias("is_attributed"),
    )


def _text_time(us: str) -> str:
    return f"strftime(make_timestamp({us}), '%Y-%m-%d %H:%M:%S')"


RAW_SQL = CLICKS_SQL + f""",
raw AS (
  SELECT seq, ip, ad_id AS app, device_id AS device, os, campaign_id AS channel,
         {_text_time('us')} AS click_time,
         coalesce({_text_time('attributed_us')}, '') AS attributed_time,
         CAST(is_attributed AS VARCHAR) AS is_attributed
  FROM clicks)"""

TIE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions with the tie-breaking line columns kept."""
    line = table(spark, sf, "lineitem").select(
        *TIE, "l_returnflag", "l_shipdate", "l_discount")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    joined = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        customer, F.col("o_custkey") == F.col("c_custkey"))
    kind = F.when(F.col("l_returnflag") == "A", "TRANSFER").when(
        F.col("l_returnflag") == "R", "CASH_OUT").otherwise("PAYMENT")
    fraud = (F.col("l_discount") >= 0.09) & (F.col("l_quantity") >= 45)
    return joined.select(
        F.datediff(F.col("l_shipdate").cast("date"), F.lit("1995-01-01").cast("date")).alias("step"),
        kind.alias("type"), F.col("l_extendedprice").alias("amount"),
        F.concat(F.lit("C"), F.col("o_custkey")).alias("nameOrig"),
        F.abs("c_acctbal").alias("oldbalanceOrg"),
        F.concat(F.lit("M"), F.col("l_suppkey")).alias("nameDest"),
        fraud.cast("int").alias("isFraud"), *TIE,
    )


TXN_SQL = """
txn AS (
  SELECT CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS INTEGER) AS step,
         CASE l_returnflag WHEN 'A' THEN 'TRANSFER' WHEN 'R' THEN 'CASH_OUT' ELSE 'PAYMENT' END
           AS type,
         l_extendedprice AS amount, 'C' || o_custkey AS nameOrig, abs(c_acctbal) AS oldbalanceOrg,
         'M' || l_suppkey AS nameDest,
         CAST(CASE WHEN l_discount >= 0.09 AND l_quantity >= 45 THEN 1 ELSE 0 END AS INTEGER)
           AS isFraud,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
txn_keyed AS (
  SELECT *, concat_ws('|', nameOrig, nameDest, CAST(step AS VARCHAR),
                      CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR)) AS txn_key
  FROM txn WHERE type IN ('TRANSFER', 'CASH_OUT'))"""


def speed_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Streaming-side scores without a model, with many ties."""
    c = clicks(spark, sf)
    p = (F.col("seq") % 97) / F.lit(97.0)
    return c.select(
        "click_id", "seq", "us", p.alias("fraud_probability"),
        (p >= 0.8).cast("int").alias("is_flagged"),
        (F.col("seq") % 13).cast("bigint").alias("dest_txn_count_so_far"))


def batch_scores(spark: SparkSession, sf: str) -> DataFrame:
    c = clicks(spark, sf)
    p = (F.col("seq") % 89) / F.lit(89.0)
    fraud = (F.col("device_id") == "3") & (F.col("seq") % 5 != 0)
    return c.select(
        "click_id", p.alias("batch_fraud_probability"), (p >= 0.5).cast("int").alias("batch_is_flagged"),
        fraud.cast("int").alias("isFraud"),
        (F.col("seq") % 17).cast("bigint").alias("dest_txn_count_so_far"))


PAIRS_SQL = CLICKS_SQL + """,
speed AS (
  SELECT click_id, seq, us, (seq % 97) / 97.0::DOUBLE AS p, seq % 13 AS cnt,
         CAST((seq % 97) / 97.0::DOUBLE >= 0.8::DOUBLE AS INTEGER) AS flag
  FROM clicks),
batch AS (
  SELECT click_id, (seq % 89) / 89.0::DOUBLE AS p, seq % 17 AS cnt,
         CAST((seq % 89) / 89.0::DOUBLE >= 0.5::DOUBLE AS INTEGER) AS flag,
         CAST(device_id = '3' AND seq % 5 <> 0 AS INTEGER) AS fraud
  FROM clicks),
pairs AS (
  SELECT s.click_id, s.seq, s.us, b.fraud AS true_label, s.p AS speed_probability,
         s.flag AS speed_flagged, b.p AS batch_probability, b.flag AS batch_flagged,
         CAST(s.cnt AS BIGINT) AS speed_dest_count, CAST(b.cnt AS BIGINT) AS batch_dest_count
  FROM speed s JOIN batch b ON s.click_id = b.click_id)"""
