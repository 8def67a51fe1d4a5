"""Queries on inputs at the edges: wide sort keys, sentinel dates, bad times, null keys."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from clickwarden.operators import contract, features, ingest, split
from clickwarden.plans import fixtures as fx
from clickwarden.plans.registry import big, query, r6
from clickwarden.runtime import scratch_root
from clickwarden.sources import readers, writers

_WIDE_SQL = """wide AS (
  SELECT event_id AS seq, CAST(CASE WHEN u >= 9223372036854775808 THEN CAST(u AS HUGEINT) - 18446744073709551616
                                    ELSE u END AS BIGINT) AS h
  FROM (SELECT event_id, CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 16) AS UBIGINT) AS u FROM events))"""


def _wide(spark, sf):
    """Event ids with a hash over the full range of longs."""
    text = F.substring(F.md5(F.col("event_id").cast("string").cast("binary")), 1, 16)
    return fx.table(spark, sf, "events").select(
        F.col("event_id").alias("seq"), F.conv(text, 16, -10).cast("bigint").alias("h"))


def _cut(order, share):
    return f"row_number() OVER (ORDER BY {order}) - 1 >= CAST(floor(count(*) OVER () * (1 - {share}::DOUBLE)) AS BIGINT)"


@query("split_wide_longs", f"""WITH {_WIDE_SQL}
SELECT seq, {_cut('h, seq', 0.2)} AS late_fifth, {_cut('h, seq', 0.37)} AS late_third,
       {_cut('h // 2, seq', 0.2)} AS half_range FROM wide""")
def split_wide_longs(spark, sf):
    rows = _wide(spark, sf)
    halved = rows.withColumn("h", F.expr("floor(h / cast(2 as decimal(20, 0)))").cast("bigint"))
    out = rows.select("seq")
    for name, table, share in (("late_fifth", rows, 0.2), ("late_third", rows, 0.37), ("half_range", halved, 0.2)):
        test = split.chronological_split(table, share, ["h", "seq"])[1]
        out = out.join(test.select("seq", F.lit(True).alias(name)), "seq", "left")
    return out.fillna(False)


@query("folds_wide_longs", f"""WITH {_WIDE_SQL}
SELECT seq, CAST(ntile(6) OVER (ORDER BY h, seq) - 1 AS INTEGER) AS block FROM wide""")
def folds_wide_longs(spark, sf):
    return split.walk_forward_folds(_wide(spark, sf), 5, ["h", "seq"]).select("seq", "block")


_SENTINEL_SQL = f"""{fx.CLICKS_SQL}, dated AS (
  SELECT seq, us FROM clicks UNION ALL
  SELECT -1, epoch_us(TIMESTAMP '0001-01-01 00:00:00') UNION ALL SELECT -2, epoch_us(TIMESTAMP '9999-12-31 00:00:00'))"""


def _dated(spark, sf):
    ends = spark.sql("SELECT -1L AS seq, timestamp'0001-01-01 00:00:00' AS at "
                     "UNION ALL SELECT -2L, timestamp'9999-12-31 00:00:00'")
    return fx.clicks(spark, sf).select("seq", F.col("timestamp").alias("at")).unionByName(ends)


@query("split_sentinel_dates", f"""WITH {_SENTINEL_SQL}
SELECT seq, {_cut('us, seq', 0.1)} AS late_tenth, {_cut('us, seq', 0.45)} AS late_half FROM dated""")
def split_sentinel_dates(spark, sf):
    rows = _dated(spark, sf)
    out = rows.select("seq")
    for name, share in (("late_tenth", 0.1), ("late_half", 0.45)):
        test = split.chronological_split(rows, share, ["at", "seq"])[1]
        out = out.join(test.select("seq", F.lit(True).alias(name)), "seq", "left")
    return out.fillna(False)


@query("slice_sentinel_dates", f"""WITH {_SENTINEL_SQL}
SELECT seq FROM (SELECT seq, row_number() OVER (ORDER BY us, seq) - 1 AS i FROM dated) WHERE i >= 100 AND i < 350""")
def slice_sentinel_dates(spark, sf):
    return ingest.contiguous_slice(_dated(spark, sf), ["at", "seq"], 100, 250).select("seq")


@query("snapshot_wide_longs", f"""WITH {_WIDE_SQL}, {fx.CLICKS_SQL},
f AS (SELECT campaign_id, is_attributed, row_number() OVER (ORDER BY h, seq) - 1 AS i FROM clicks JOIN wide USING (seq))
SELECT campaign_id AS id, count(*) AS clicks, CAST(sum(is_attributed) AS BIGINT) AS attributed
FROM f WHERE i < 321 GROUP BY 1""")
def snapshot_wide_longs(spark, sf):
    clicks = fx.clicks(spark, sf).join(_wide(spark, sf), "seq")
    return features.conversion_snapshots(clicks, "campaign_id", 321, ["h", "seq"])


@query("quarantine_bad_times", f"""WITH {fx.CLICKS_SQL}
SELECT click_id, seq % 3 = 0 AS bad_time, seq % 3 <> 0 AS has_time FROM clicks""")
def quarantine_bad_times(spark, sf):
    """Records whose click time is no time keep their text as the reason."""
    time = F.when(F.col("seq") % 3 == 0, F.lit("junk")).otherwise(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    text = fx.clicks(spark, sf).select(F.to_json(F.struct("click_id", "ip", time.alias("click_time"))).alias("value"))
    return contract.parse_clicks(text, quarantine=True).select(
        "click_id", F.col("parse_error").isNotNull().alias("bad_time"), F.col("click_time").isNotNull().alias("has_time"))


@query("metadata_without_flagged", f"""WITH {fx.CLICKS_SQL}, stats AS (
  SELECT ip, count(*) AS c FROM clicks GROUP BY ip)
SELECT CAST((SELECT quantile_disc(c, 0.9) FROM stats) AS BIGINT) AS velocity_count_cutoff,
       CAST(0 AS BIGINT) AS flagged_ips, (SELECT count(*) FROM clicks) AS sample_rows""")
def metadata_without_flagged(spark, sf):
    """A sample in which no IP is flagged still reports its cutoff."""
    return ingest.sample_metadata(fx.clicks(spark, sf), 0.9, -1.0).select(
        "velocity_count_cutoff", "flagged_ips", "sample_rows")


@query("rates_of_repeated_ids", f"""WITH {fx.CLICKS_SQL}, snap AS (
  SELECT campaign_id AS id, count(*) AS n, sum(is_attributed) AS a FROM clicks GROUP BY 1)
SELECT seq, round(a / n::DOUBLE, 6) + 0.0 AS rate FROM clicks JOIN snap ON campaign_id = id""")
def rates_of_repeated_ids(spark, sf):
    """A snapshot that holds every id several times leaves one row a click."""
    clicks = fx.clicks(spark, sf)
    parts = clicks.groupBy(F.col("campaign_id").alias("id"), "publisher_id").agg(
        F.count(F.lit(1)).alias("clicks"), F.sum("is_attributed").alias("attributed")).drop("publisher_id")
    return features.attach_rates(clicks.select("seq", "campaign_id"), parts, "campaign_id", "rate").select("seq", r6("rate"))


@query("upsert_null_keys", """
SELECT CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_id END AS id, event_type AS kind, CAST(1 AS BIGINT) AS rows
FROM events WHERE event_id % 10 <> 0
UNION ALL SELECT DISTINCT NULL, event_type, CAST(1 AS BIGINT) FROM events WHERE event_id % 10 = 0""")
def upsert_null_keys(spark, sf):
    """A batch with null keys that is added three times is in the table once."""
    path = f"{scratch_root(spark)}/nulls-{uuid.uuid4().hex}"
    rows = fx.table(spark, sf, "events").select(
        F.when(F.col("event_id") % 10 != 0, F.col("event_id")).alias("id"), F.col("event_type").alias("kind"))
    for _ in range(3):
        writers.upsert_insert_only(rows, path, ["id", "kind"])
    return readers.read_scored(spark, path).groupBy("id", "kind").agg(big(F.count(F.lit(1)), "rows"))


@query("contract_stops_counts", "SELECT true AS count_stops, true AS narrow_select_stops, true AS good_rows_pass")
def contract_stops_counts(spark, sf):
    """A violation stops the job even if only a count or another column is asked for."""
    clicks = fx.clicks(spark, sf).drop("seq", "us")
    bad = clicks.withColumn("is_attributed", F.when(F.col("click_id") < "1", 2).otherwise(F.col("is_attributed")))

    def stops(action) -> bool:
        try:
            action(ingest.normalize_clicks(bad))
        except Exception as error:  # the message tells it from any other failure
            return "must be 0 or 1" in str(error)
        return False

    passed = ingest.normalize_clicks(clicks).count() == clicks.count()
    return spark.createDataFrame(
        [(stops(lambda d: d.count()), stops(lambda d: d.select("ip").collect()), passed)],
        "count_stops boolean, narrow_select_stops boolean, good_rows_pass boolean")
