"""Queries on ordered features, splits, labels and ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickwarden.functions import click_to_install_seconds, parse_timestamp, seconds_between
from clickwarden.operators import contract, features, ingest, ordering, split, windows
from clickwarden.plans import fixtures as fx
from clickwarden.plans.registry import big, query, r6, us_of
from clickwarden.runtime import spill

WIDTHS = {"1m": 60, "5m": 300, "1h": 3600}


def _counts_sql(fixture: str, key: str, label: str, extra: str = "") -> str:
    return f"""WITH {fixture}
SELECT a.seq, count(*) FILTER (WHERE b.us >= a.us - 60000000) AS {label}_clicks_1m,
       count(*) FILTER (WHERE b.us >= a.us - 300000000) AS {label}_clicks_5m,
       count(*) AS {label}_clicks_1h
FROM clicks a JOIN clicks b ON a.{key} = b.{key} {extra}
 AND b.us BETWEEN a.us - 3600000000 AND a.us AND (b.us < a.us OR b.seq <= a.seq)
GROUP BY a.seq"""


def _widths(label):
    return {f"{label}_clicks_{n}": s for n, s in WIDTHS.items()}


def _counts(c, key, label, hot_rows=None):
    out = windows.rolling_counts(c, key, _widths(label), "us", "seq", hot_rows)
    return out.select("seq", *[big(n) for n in _widths(label)])


@query("rolling_counts_ip", _counts_sql(fx.CLICKS_SQL, "ip", "ip"))
def rolling_counts_ip(spark, sf):
    return _counts(fx.clicks(spark, sf), "ip", "ip")


@query("rolling_counts_ip_tied", _counts_sql(fx.TIED_SQL, "ip", "ip"))
def rolling_counts_ip_tied(spark, sf):
    return _counts(fx.clicks(spark, sf, tied=True), "ip", "ip")


@query("rolling_counts_ip_hot_keys", _counts_sql(fx.HOT_SQL, "ip", "ip"))
def rolling_counts_ip_hot_keys(spark, sf):
    return _counts(fx.hot_clicks(spark, sf), "ip", "ip", hot_rows=70)


@query("rolling_counts_device", _counts_sql(fx.CLICKS_SQL, "device_id", "device"))
def rolling_counts_device(spark, sf):
    return _counts(fx.clicks(spark, sf), "device_id", "device")


@query("rolling_counts_device_per_ip",
       _counts_sql(fx.CLICKS_SQL, "device_id", "device", "AND a.ip = b.ip"))
def rolling_counts_device_per_ip(spark, sf):
    return _counts(fx.clicks(spark, sf), ["ip", "device_id"], "device")


def _entropy_sql(fixture: str) -> str:
    return f"""WITH {fixture},
bags AS (
  SELECT a.seq, count(*) AS c
  FROM clicks a JOIN clicks b ON a.ip = b.ip
   AND b.us BETWEEN a.us - 300000000 AND a.us AND (b.us < a.us OR b.seq <= a.seq)
  GROUP BY a.seq, b.device_id, b.os)
SELECT seq, round(greatest(0.0, log2(sum(c)) - sum(c * log2(c)) / sum(c)), 6) + 0.0
         AS ip_fingerprint_entropy_5m
FROM bags GROUP BY seq"""


def _entropy(c, hot_rows=None):
    out = windows.rolling_entropy(
        c, "ip", ["device_id", "os"], 300, "ip_fingerprint_entropy_5m", "us", "seq", hot_rows)
    return out.select("seq", r6("ip_fingerprint_entropy_5m"))


@query("rolling_entropy", _entropy_sql(fx.CLICKS_SQL))
def rolling_entropy(spark, sf):
    return _entropy(fx.clicks(spark, sf))


@query("rolling_entropy_tied", _entropy_sql(fx.TIED_SQL))
def rolling_entropy_tied(spark, sf):
    return _entropy(fx.clicks(spark, sf, tied=True))


@query("rolling_entropy_hot_keys", _entropy_sql(fx.HOT_SQL))
def rolling_entropy_hot_keys(spark, sf):
    return _entropy(fx.hot_clicks(spark, sf), hot_rows=70)


@query("inter_click_gap", f"""WITH {fx.CLICKS_SQL}
SELECT seq, round(coalesce(greatest(0.0,
  (us - lag(us) OVER (PARTITION BY ip ORDER BY us, seq)) / 1000000.0::DOUBLE), 0.0), 6) + 0.0
  AS ip_inter_click_gap_seconds FROM clicks""")
def inter_click_gap(spark, sf):
    out = windows.inter_click_gap(fx.clicks(spark, sf), time="us", tie="seq")
    return out.select("seq", r6("ip_inter_click_gap_seconds"))


TXN_ORDER = ["step", "nameOrig", *fx.TIE]
_TXN_ORDER_SQL = ", ".join(TXN_ORDER)


@query("count_so_far", f"""WITH {fx.TXN_SQL}
SELECT {", ".join(fx.TIE)}, nameDest, CAST(row_number() OVER (
  PARTITION BY nameDest ORDER BY {_TXN_ORDER_SQL}) - 1 AS BIGINT) AS dest_txn_count_so_far
FROM txn""")
def count_so_far(spark, sf):
    out = windows.count_so_far(fx.transactions(spark, sf), "nameDest", TXN_ORDER)
    return out.select(*fx.TIE, "nameDest", "dest_txn_count_so_far")


@query("count_so_far_hot_keys", f"""WITH {fx.TXN_SQL}
SELECT {", ".join(fx.TIE)}, nameDest, CAST(row_number() OVER (
  PARTITION BY nameDest ORDER BY {_TXN_ORDER_SQL}) - 1 AS BIGINT) AS dest_txn_count_so_far
FROM txn""")
def count_so_far_hot_keys(spark, sf):
    out = windows.count_so_far(fx.transactions(spark, sf), "nameDest", TXN_ORDER, hot_rows=600)
    return out.select(*fx.TIE, "nameDest", "dest_txn_count_so_far")


SNAP_SQL = """,
camp AS (SELECT campaign_id AS id, count(*) AS clicks, sum(is_attributed) AS attributed
         FROM clicks GROUP BY 1),
publ AS (SELECT publisher_id AS id, count(*) AS clicks, sum(is_attributed) AS attributed
         FROM clicks GROUP BY 1)"""

_FEATURES_SQL = """,
ipc AS (
  SELECT a.seq, count(*) FILTER (WHERE b.us >= a.us - 60000000) AS ip_clicks_1m,
         count(*) FILTER (WHERE b.us >= a.us - 300000000) AS ip_clicks_5m,
         count(*) AS ip_clicks_1h
  FROM clicks a JOIN clicks b ON a.ip = b.ip AND b.us BETWEEN a.us - 3600000000 AND a.us
  GROUP BY a.seq),
dev AS (
  SELECT a.seq, count(*) FILTER (WHERE b.us >= a.us - 60000000) AS device_clicks_1m,
         count(*) FILTER (WHERE b.us >= a.us - 300000000) AS device_clicks_5m,
         count(*) AS device_clicks_1h
  FROM clicks a JOIN clicks b ON a.device_id = b.device_id {scope}
   AND b.us BETWEEN a.us - 3600000000 AND a.us
  GROUP BY a.seq),
bags AS (
  SELECT a.seq, count(*) AS c
  FROM clicks a JOIN clicks b ON a.ip = b.ip AND b.us BETWEEN a.us - 300000000 AND a.us
  GROUP BY a.seq, b.device_id, b.os),
ent AS (
  SELECT seq, greatest(0.0, log2(sum(c)) - sum(c * log2(c)) / sum(c)) AS e FROM bags GROUP BY seq),
gap AS (
  SELECT seq, coalesce((us - lag(us) OVER (PARTITION BY ip ORDER BY us, seq))
                       / 1000000.0::DOUBLE, 0.0) AS g FROM clicks),
feat AS (
  SELECT clicks.seq, clicks.click_id, clicks.is_attributed, ip_clicks_1m, ip_clicks_5m,
         ip_clicks_1h, device_clicks_1m, device_clicks_5m, device_clicks_1h,
         round(e, 6) + 0.0 AS ip_fingerprint_entropy_5m,
         round(g, 6) + 0.0 AS ip_inter_click_gap_seconds,
         round(coalesce((attributed_us - us) / 1000000.0::DOUBLE, 0.0), 6) + 0.0
           AS click_to_install_delta_seconds,
         round(coalesce(camp.attributed / camp.clicks::DOUBLE, 0.0), 6) + 0.0
           AS campaign_conversion_rate,
         round(coalesce(publ.attributed / publ.clicks::DOUBLE, 0.0), 6) + 0.0
           AS publisher_conversion_rate
  FROM clicks JOIN ipc USING (seq) JOIN dev USING (seq) JOIN ent USING (seq) JOIN gap USING (seq)
  LEFT JOIN camp ON campaign_id = camp.id LEFT JOIN publ ON publisher_id = publ.id)"""

FEATURES_SQL = fx.CLICKS_SQL + SNAP_SQL + _FEATURES_SQL.replace("{scope}", "")
FEATURES_PER_IP_SQL = fx.CLICKS_SQL + SNAP_SQL + _FEATURES_SQL.replace(
    "{scope}", "AND a.ip = b.ip")

COUNT_FEATURES = [f"{w}_clicks_{n}" for w in ("ip", "device") for n in WIDTHS]
OTHER_FEATURES = [
    "ip_fingerprint_entropy_5m", "ip_inter_click_gap_seconds", "click_to_install_delta_seconds",
    "campaign_conversion_rate", "publisher_conversion_rate",
]


def feature_columns():
    return [*[big(n) for n in COUNT_FEATURES], *[r6(n) for n in OTHER_FEATURES]]


READ_BY_FEATURES = ["seq", "us", "ip", "device_id", "os", "campaign_id", "publisher_id", "timestamp",
                    "attributed_time", "click_to_install_delta"]


def snapshots(c):
    """Stored conversion snapshots of both sides."""
    return tuple(
        spill(features.conversion_snapshots(c, side), "snapshot")
        for side in ("campaign_id", "publisher_id"))


def all_features(spark, sf, scope="global", hot_rows=None, keep=None):
    """The click features beside the click's columns, or only those of them named in ``keep``."""
    c = fx.clicks(spark, sf)
    campaign, publisher = snapshots(c)
    if keep is not None:
        c = c.select(*dict.fromkeys([*keep, *READ_BY_FEATURES]))
    return features.click_features(c, campaign, publisher, scope, "us", "seq", hot_rows)


_FEATURE_LIST = ", ".join(COUNT_FEATURES + OTHER_FEATURES)


@query("click_features", f"WITH {FEATURES_SQL} SELECT seq, {_FEATURE_LIST} FROM feat")
def click_features(spark, sf):
    return all_features(spark, sf).select("seq", *feature_columns())


@query("click_features_per_ip",
       f"WITH {FEATURES_PER_IP_SQL} SELECT seq, {_FEATURE_LIST} FROM feat")
def click_features_per_ip(spark, sf):
    return all_features(spark, sf, "per_ip").select("seq", *feature_columns())


@query("click_features_hot_keys", f"WITH {FEATURES_SQL} SELECT seq, {_FEATURE_LIST} FROM feat")
def click_features_hot_keys(spark, sf):
    """The same features with all devices and the busier IPs split over many tasks."""
    return all_features(spark, sf, hot_rows=70).select("seq", *feature_columns())


@query("vectorize", f"""WITH {FEATURES_SQL}
SELECT seq, round(ip_clicks_1m * 1.0 + ip_clicks_5m * 2.0 + ip_clicks_1h * 3.0
  + device_clicks_1m * 4.0 + device_clicks_5m * 5.0 + device_clicks_1h * 6.0
  + ip_fingerprint_entropy_5m * 7.0 + ip_inter_click_gap_seconds * 8.0
  + click_to_install_delta_seconds * 9.0 + campaign_conversion_rate * 10.0
  + publisher_conversion_rate * 11.0, 3) + 0.0 AS weighted, CAST(11 AS BIGINT) AS n FROM feat""")
def vectorize(spark, sf):
    rounded = all_features(spark, sf).select("seq", *feature_columns())
    v = features.vectorize(rounded)
    weighted = sum((F.col("vector")[i] * float(i + 1) for i in range(11)), F.lit(0.0))
    return v.select(
        "seq", (F.round(weighted, 3) + 0.0).alias("weighted"), big(F.size("vector"), "n"))


@query("conversion_snapshots", f"""WITH {fx.CLICKS_SQL}, cut AS (
  SELECT *, row_number() OVER (ORDER BY us, seq) - 1 AS i, count(*) OVER () AS n FROM clicks)
SELECT side, id, count(*) AS clicks, CAST(sum(is_attributed) AS BIGINT) AS attributed FROM (
  SELECT 'campaign' AS side, campaign_id AS id, is_attributed FROM cut WHERE i < n * 4 // 5
  UNION ALL
  SELECT 'publisher', publisher_id, is_attributed FROM cut WHERE i < n * 4 // 5) GROUP BY 1, 2""")
def conversion_snapshots(spark, sf):
    c = fx.clicks(spark, sf)
    cutoff = c.count() * 4 // 5
    sides = [
        features.conversion_snapshots(c, f"{side}_id", cutoff, ["us", "seq"]).select(
            F.lit(side).alias("side"), "id", "clicks", "attributed")
        for side in ("campaign", "publisher")]
    return sides[0].unionByName(sides[1])


@query("attach_rates", f"""WITH {fx.CLICKS_SQL}, camp AS (
  SELECT campaign_id AS id, count(*) AS clicks, sum(is_attributed) AS attributed FROM clicks
  WHERE os <> 'view' AND campaign_id <> '3' GROUP BY 1)
SELECT seq, campaign_id, round(coalesce(attributed / clicks::DOUBLE, 0.0), 6) + 0.0 AS rate
FROM clicks LEFT JOIN camp ON campaign_id = id""")
def attach_rates(spark, sf):
    c = fx.clicks(spark, sf)
    known = c.where((F.col("os") != "view") & (F.col("campaign_id") != "3"))
    snap = spill(features.conversion_snapshots(known, "campaign_id"), "snapshot")
    return features.attach_rates(c, snap, "campaign_id", "rate").select(
        "seq", "campaign_id", r6("rate"))


@query("shannon_entropy", f"""WITH {fx.CLICKS_SQL}, bags AS (
  SELECT ip, count(*) AS c FROM clicks GROUP BY ip, device_id, os)
SELECT ip, CAST(sum(c) AS BIGINT) AS n,
       round(greatest(0.0, log2(sum(c)) - sum(c * log2(c)) / sum(c)), 6) + 0.0 AS entropy
FROM bags GROUP BY ip""")
def shannon_entropy(spark, sf):
    out = features.shannon_entropy(fx.clicks(spark, sf), ["ip"], ["device_id", "os"])
    return out.select("ip", big("n"), r6("entropy"))


@query("click_to_install", f"""WITH {fx.CLICKS_SQL}
SELECT seq, CAST(CASE WHEN attributed_us IS NULL THEN NULL
                 ELSE attributed_us // 1000000 - us // 1000000 END AS BIGINT) AS install_delta,
       round(CASE WHEN os = 'view' THEN -1.5 ELSE
         coalesce(greatest(0.0, (attributed_us - us) / 1000000.0::DOUBLE), 0.0) END, 6) + 0.0
         AS seconds,
       round(coalesce((us - attributed_us) / 1000000.0::DOUBLE, 0.0), 6) + 0.0 AS signed_seconds
FROM clicks""")
def click_to_install(spark, sf):
    from clickwarden.functions import install_delta

    c = fx.clicks(spark, sf)
    given = F.when(F.col("os") == "view", F.lit(-1.5))
    return c.select(
        "seq", install_delta(F.col("timestamp"), F.col("attributed_time")).alias("install_delta"),
        r6(click_to_install_seconds(given, F.col("timestamp"), F.col("attributed_time")), "seconds"),
        r6(F.coalesce(seconds_between(F.col("attributed_time"), F.col("timestamp")), F.lit(0.0)),
           "signed_seconds"))


@query("parse_timestamp", f"""WITH {fx.CLICKS_SQL}
SELECT seq, us AS from_iso, us // 1000000 * 1000000 AS from_text,
       us // 1000000 * 1000000 AS from_number, CAST(NULL AS BIGINT) AS from_junk FROM clicks""")
def parse_timestamp_query(spark, sf):
    from pyspark.sql import types as T

    t = F.col("timestamp")
    c = fx.clicks(spark, sf).select(
        "seq", F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("iso"),
        F.date_format(t, "yyyy-MM-dd HH:mm:ss").alias("text"),
        F.expr("us div 1000000").alias("number"), F.concat(F.lit("no "), "ip").alias("junk"))
    return c.select(
        "seq", F.unix_micros(parse_timestamp("iso")).alias("from_iso"),
        F.unix_micros(parse_timestamp("text")).alias("from_text"),
        F.unix_micros(parse_timestamp("number", T.LongType())).alias("from_number"),
        F.unix_micros(parse_timestamp("junk")).alias("from_junk"))


# --- order and splits --------------------------------------------------------------------

@query("global_index", f"""WITH {fx.CLICKS_SQL}
SELECT seq, row_number() OVER (ORDER BY device_id, us, seq) - 1 AS row_index FROM clicks""")
def global_index(spark, sf):
    out = ordering.global_index(fx.clicks(spark, sf), ["device_id", "us", "seq"])
    return out.select("seq", big("row_index"))


@query("chronological_split", f"""WITH {fx.CLICKS_SQL}, i AS (
  SELECT seq, us, row_number() OVER (ORDER BY us, seq) - 1 AS i, count(*) OVER () AS n FROM clicks)
SELECT seq, us, CASE WHEN i < CAST(floor(n * (1 - 0.2::DOUBLE)) AS BIGINT) THEN 'train'
                     ELSE 'test' END AS part FROM i""")
def chronological_split(spark, sf):
    train, test = split.chronological_split(fx.clicks(spark, sf), 0.2, ["us", "seq"])
    return train.select("seq", "us", F.lit("train").alias("part")).unionByName(
        test.select("seq", "us", F.lit("test").alias("part")))


@query("split_history", f"""WITH {fx.CLICKS_SQL}, i AS (
  SELECT seq, row_number() OVER (ORDER BY us, seq) - 1 AS i, count(*) OVER () AS n FROM clicks)
SELECT seq, CASE WHEN i < n // 2 THEN 'w1' ELSE 'w2' END AS part FROM i""")
def split_history(spark, sf):
    older, newer = split.split_history(fx.clicks(spark, sf), ["us", "seq"])
    return older.select("seq", F.lit("w1").alias("part")).unionByName(
        newer.select("seq", F.lit("w2").alias("part")))


@query("walk_forward_folds", f"""WITH {fx.CLICKS_SQL}
SELECT seq, CAST(ntile(6) OVER (ORDER BY us, seq) - 1 AS INTEGER) AS block FROM clicks""")
def walk_forward_folds(spark, sf):
    return split.walk_forward_folds(fx.clicks(spark, sf), 5, ["us", "seq"]).select("seq", "block")


@query("contiguous_slice", f"""WITH {fx.TIED_SQL}, i AS (
  SELECT seq, us, row_number() OVER (ORDER BY us, seq) - 1 AS i, count(*) OVER () AS n FROM clicks)
SELECT seq, us FROM i WHERE i >= n // 10 AND i < n // 10 + n // 2""")
def contiguous_slice(spark, sf):
    c = fx.clicks(spark, sf, tied=True)
    n = c.count()
    return ingest.contiguous_slice(c, ["us", "seq"], n // 10, n // 2).select("seq", "us")


@query("order_violations", """SELECT event_id AS seq, CAST(v AS BIGINT) AS v,
  CAST(previous AS BIGINT) AS previous FROM (
  SELECT event_id, round(value * 100) AS v,
         lag(round(value * 100)) OVER (ORDER BY event_id) AS previous FROM events)
WHERE v < previous""")
def order_violations(spark, sf):
    e = fx.table(spark, sf, "events").select(
        F.col("event_id").alias("seq"), big(F.round(F.col("value") * 100), "v"))
    return ingest.order_violations(e, "seq", "v").select(
        "seq", "v", F.col("previous_time").alias("previous"))


# --- ingest and labels -------------------------------------------------------------------

_MAPPED = """md5(concat_ws('|', ip, device, os, app, channel, click_time)) AS click_id,
  app AS ad_id, channel AS campaign_id, channel AS publisher_id, device AS device_id, ip, os,
  epoch_us(strptime(click_time, '%Y-%m-%d %H:%M:%S')) AS us,
  CASE WHEN attributed_time <> '' THEN
    epoch_us(strptime(attributed_time, '%Y-%m-%d %H:%M:%S')) END AS attributed_us,
  CAST(is_attributed AS INTEGER) AS is_attributed,
  CASE WHEN attributed_time <> '' THEN CAST(
    epoch_us(strptime(attributed_time, '%Y-%m-%d %H:%M:%S')) // 1000000
    - epoch_us(strptime(click_time, '%Y-%m-%d %H:%M:%S')) // 1000000 AS DOUBLE) END
    AS click_to_install_delta"""


def mapped_columns():
    return ["click_id", "ad_id", "campaign_id", "publisher_id", "device_id", "ip", "os",
            us_of("timestamp", "us"), us_of("attributed_time", "attributed_us"),
            "is_attributed", "click_to_install_delta"]


MAPPED_SQL = f"WITH {fx.RAW_SQL} SELECT {_MAPPED} FROM raw"


@query("map_clicks", MAPPED_SQL)
def map_clicks(spark, sf):
    return ingest.map_clicks(fx.raw_clicks(spark, sf)).select(*mapped_columns())


@query("normalize_clicks", f"""WITH {fx.RAW_SQL}
SELECT md5(concat_ws('|', ip, device, os, app, channel, click_time)) AS click_id, ip,
       channel AS campaign_id, CAST(is_attributed AS INTEGER) AS is_attributed,
       CAST(0 AS INTEGER) AS is_synthetic, true AS stamped FROM raw""")
def normalize_clicks(spark, sf):
    out = ingest.normalize_clicks(fx.raw_clicks(spark, sf))
    return out.select("click_id", "ip", "campaign_id", "is_attributed", "is_synthetic",
                      F.col("event_timestamp").isNotNull().alias("stamped"))


@query("from_time", f"""WITH {fx.CLICKS_SQL}
SELECT seq, us FROM clicks
WHERE us >= epoch_us(TIMESTAMP '2024-01-01 00:30:00')""")
def from_time(spark, sf):
    return ingest.from_time(fx.clicks(spark, sf), "2024-01-01 00:30:00").select("seq", "us")


@query("ip_stats", f"""WITH {fx.CLICKS_SQL}
SELECT ip, count(*) AS clicks, CAST(sum(is_attributed) AS BIGINT) AS attributed,
       round(avg(is_attributed), 6) + 0.0 AS attribution_rate FROM clicks GROUP BY ip""")
def ip_stats(spark, sf):
    out = ingest.ip_stats(fx.clicks(spark, sf))
    return out.select("ip", "clicks", "attributed", r6("attribution_rate"))


@query("velocity_cutoff", f"""WITH {fx.CLICKS_SQL}, s AS (
  SELECT ip, count(*) AS c FROM clicks GROUP BY ip)
SELECT CAST(quantile_disc(c, 0.9) AS BIGINT) AS cutoff FROM s""")
def velocity_cutoff(spark, sf):
    return ingest.velocity_cutoff(ingest.ip_stats(fx.clicks(spark, sf)), 0.9)


LABEL_SQL = """,
stats AS (SELECT ip, count(*) AS c, sum(is_attributed) AS a FROM clicks GROUP BY ip),
farm AS (SELECT ip, c FROM stats WHERE c >= (SELECT quantile_disc(c, 0.9) FROM stats)
         AND a / c::DOUBLE <= 0.001),
labelled AS (SELECT clicks.*, CAST(farm.ip IS NOT NULL AS INTEGER) AS is_fraud
             FROM clicks LEFT JOIN farm ON clicks.ip = farm.ip)"""


def labelled(spark, sf):
    return ingest.bootstrap_labels(fx.clicks(spark, sf), 0.9, 0.001)


@query("bootstrap_labels", f"WITH {fx.CLICKS_SQL}{LABEL_SQL} SELECT seq, ip, is_fraud FROM labelled")
def bootstrap_labels(spark, sf):
    return labelled(spark, sf).select("seq", "ip", "is_fraud")


@query("fraud_ips", f"""WITH {fx.CLICKS_SQL}{LABEL_SQL}
SELECT ip, c AS clicks FROM farm""")
def fraud_ips(spark, sf):
    return ingest.fraud_ips(fx.clicks(spark, sf), 0.9, 0.001).select("ip", "clicks")


@query("sample_metadata", f"""WITH {fx.CLICKS_SQL}{LABEL_SQL}
SELECT count(*) AS sample_rows, min(us) AS first_us, max(us) AS last_us,
       CAST((SELECT quantile_disc(c, 0.9) FROM stats) AS BIGINT) AS velocity_count_cutoff,
       (SELECT count(*) FROM farm) AS flagged_ips,
       CAST(sum(is_fraud) AS BIGINT) AS is_fraud_positive_rows,
       round(avg(is_fraud), 6) + 0.0 AS is_fraud_rate FROM labelled""")
def sample_metadata(spark, sf):
    out = ingest.sample_metadata(fx.clicks(spark, sf), 0.9, 0.001)
    return out.select("sample_rows", us_of("click_time_start", "first_us"),
                      us_of("click_time_end", "last_us"), "velocity_count_cutoff",
                      "flagged_ips", "is_fraud_positive_rows", r6("is_fraud_rate"))


_BURST_SQL = """, anchors AS (
  SELECT us FROM (SELECT us, row_number() OVER (ORDER BY us, seq) AS i FROM clicks)
  WHERE i % 25 = 0),
burst AS (
  SELECT us + i * 2 * 1000000 AS us, 'farm-' || lpad(CAST(i % 3 AS VARCHAR), 2, '0') AS ip,
         'farm-device-' || lpad(CAST(i % 2 AS VARCHAR), 2, '0') AS device_id
  FROM anchors, range(7) r(i)),
bursts AS (
  SELECT md5(concat_ws('|', 'synthetic-farm', ip, device_id,
             strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%S'))) AS click_id, ip, device_id,
         'farm-os-1' AS os, us, CAST(1 AS INTEGER) AS is_synthetic, CAST(1 AS INTEGER) AS is_fraud
  FROM burst)"""


@query("labelled_bursts", f"WITH {fx.CLICKS_SQL}{_BURST_SQL} SELECT * FROM bursts")
def labelled_bursts(spark, sf):
    out = ingest.labelled_bursts(fx.clicks(spark, sf), 25, 7, 2, tie="seq")
    return out.select("click_id", "ip", "device_id", "os", us_of("timestamp", "us"),
                      "is_synthetic", "is_fraud")


@query("union_clicks", f"""WITH {fx.CLICKS_SQL}{_BURST_SQL}
SELECT ip, CAST(sum(fraud) AS BIGINT) AS fraud, count(*) AS clicks, max(seq) AS last_seq FROM (
  SELECT ip, 0 AS fraud, seq FROM clicks UNION ALL SELECT ip, 1, NULL FROM bursts) GROUP BY ip""")
def union_clicks(spark, sf):
    c = fx.clicks(spark, sf)
    both = ingest.union_clicks(c, ingest.labelled_bursts(c, 25, 7, 2, tie="seq"))
    return both.groupBy("ip").agg(
        big(F.sum("is_fraud"), "fraud"), F.count(F.lit(1)).alias("clicks"),
        F.max("seq").alias("last_seq"))


# --- contract ----------------------------------------------------------------------------

def messages(spark, sf):
    """Click events as JSON text, with every kind of contract violation among them."""
    kind = F.col("seq") % 9
    ip = F.when(kind == 1, "").when(kind == 2, ',"ip":null').when(kind == 3, ',"ip":""').otherwise(
        F.concat(F.lit(',"ip":"'), "ip", F.lit('"')))
    flag = F.when(kind == 4, '"is_attributed":2').when(kind == 5, '"is_attributed":"x"').when(
        kind == 6, '"is_attributed":null').otherwise(
        F.concat(F.lit('"is_attributed":"'), "is_attributed", F.lit('"')))
    body = F.concat(
        F.lit('{"click_id":"'), "click_id", F.lit('"'), ip,
        F.lit(',"ad_id":"'), "ad_id", F.lit('","campaign_id":"'), "campaign_id",
        F.lit('","publisher_id":"'), "publisher_id", F.lit('","device_id":"'), "device_id",
        F.lit('","os":"'), "os",
        F.lit('","timestamp":"2024-01-01 00:00:00","click_time":"2024-01-01T00:00:00Z",'),
        flag, F.lit(',"is_synthetic":0,"event_timestamp":"2024-01-01 00:00:00"}'))
    value = F.when(kind == 7, F.concat(F.lit("no json "), "seq")).when(
        kind == 8, F.concat(F.lit("["), "seq", F.lit("]"))).otherwise(body)
    return fx.clicks(spark, sf).select("seq", value.alias("value"))


MESSAGES_SQL = fx.CLICKS_SQL + """,
messages AS (
  SELECT seq, CASE seq % 9 WHEN 7 THEN 'no json ' || seq WHEN 8 THEN '[' || seq || ']' ELSE
    '{"click_id":"' || click_id || '"'
    || CASE seq % 9 WHEN 1 THEN '' WHEN 2 THEN ',"ip":null' WHEN 3 THEN ',"ip":""'
       ELSE ',"ip":"' || ip || '"' END
    || ',"ad_id":"' || ad_id || '","campaign_id":"' || campaign_id || '","publisher_id":"'
    || publisher_id || '","device_id":"' || device_id || '","os":"' || os
    || '","timestamp":"2024-01-01 00:00:00","click_time":"2024-01-01T00:00:00Z",'
    || CASE seq % 9 WHEN 4 THEN '"is_attributed":2' WHEN 5 THEN '"is_attributed":"x"'
       WHEN 6 THEN '"is_attributed":null' ELSE '"is_attributed":"' || is_attributed || '"' END
    || ',"is_synthetic":0,"event_timestamp":"2024-01-01 00:00:00"}' END AS value
  FROM clicks),
sorted_out AS (
  SELECT seq, value, NOT (json_valid(value) AND value LIKE '{%') AS is_malformed FROM messages),
read_out AS (
  SELECT seq, is_malformed, CASE WHEN NOT is_malformed THEN value END AS j FROM sorted_out),
checked AS (
  SELECT seq, is_malformed, j,
    CASE WHEN is_malformed THEN NULL ELSE concat_ws('; ',
      CASE WHEN NOT list_contains(json_keys(j), 'ip') THEN 'missing required key: ip' END,
      CASE WHEN list_contains(json_keys(j), 'ip')
            AND coalesce(json_extract_string(j, '$.ip'), '') = ''
           THEN 'empty required value: ip' END,
      CASE WHEN try_cast(json_extract_string(j, '$.is_attributed') AS INTEGER) IS NULL
           THEN 'is_attributed must be integer-like'
           WHEN try_cast(json_extract_string(j, '$.is_attributed') AS INTEGER) NOT IN (0, 1)
           THEN 'is_attributed must be 0 or 1' END) END AS errors
  FROM read_out)"""


@query("validate_clicks", f"WITH {MESSAGES_SQL} SELECT seq, is_malformed, errors FROM checked")
def validate_clicks(spark, sf):
    out = contract.validate_clicks(messages(spark, sf))
    return out.select("seq", "is_malformed", F.array_join("errors", "; ").alias("errors"))


@query("contract_report", f"""WITH {MESSAGES_SQL}
SELECT count(*) FILTER (WHERE NOT is_malformed AND errors = '') AS valid,
       count(*) FILTER (WHERE NOT is_malformed AND errors <> '') AS invalid,
       count(*) FILTER (WHERE is_malformed) AS malformed_json, count(*) AS total FROM checked""")
def contract_report(spark, sf):
    return contract.contract_report(contract.validate_clicks(messages(spark, sf)))


@query("parse_clicks", f"""WITH {MESSAGES_SQL}
SELECT json_extract_string(j, '$.click_id') AS click_id, json_extract_string(j, '$.ip') AS ip,
       try_cast(json_extract_string(j, '$.is_attributed') AS INTEGER) AS is_attributed,
       CAST(1704067200000000 AS BIGINT) AS us FROM checked WHERE NOT is_malformed""")
def parse_clicks(spark, sf):
    return contract.parse_clicks(messages(spark, sf)).select(
        "click_id", "ip", "is_attributed", us_of("click_time", "us"))


@query("parse_clicks_quarantine", f"""WITH {MESSAGES_SQL}
SELECT json_extract_string(j, '$.click_id') AS click_id,
       CASE WHEN c.is_malformed THEN value END AS parse_error
FROM checked c JOIN sorted_out USING (seq)""")
def parse_clicks_quarantine(spark, sf):
    return contract.parse_clicks(messages(spark, sf), quarantine=True).select(
        "click_id", "parse_error")
