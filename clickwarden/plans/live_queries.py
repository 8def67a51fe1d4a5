"""Queries on running streams: late labels, totals of a monitor, and reports from sketches that merge."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickwarden.plans import fixtures as fx
from clickwarden.plans.feature_queries import LABEL_SQL, MESSAGES_SQL, labelled, messages
from clickwarden.plans.registry import query, r6, us_of
from clickwarden.plans.store_queries import folder
from clickwarden.runtime import spill
from clickwarden.sources import readers
from clickwarden.streaming import labels, scoring, sketches

# A label comes up to 49 minutes after its click; the wait is half an hour.
_WAIT_US, _WAIT = 1_800_000_000, "30 minutes"
_LATE_SQL = f"""WITH {fx.CLICKS_SQL}{LABEL_SQL},
came AS (SELECT click_id, is_fraud, us + (seq % 50) * 60000000 AS label_us FROM labelled WHERE os <> 'view'),
joined AS (
  SELECT c.seq, c.us, CAST((c.seq % 97) / 97.0::DOUBLE >= 0.8::DOUBLE AS INTEGER) AS is_flagged, l.is_fraud, l.label_us
  FROM clicks c LEFT JOIN came l ON c.click_id = l.click_id AND l.label_us - c.us <= {_WAIT_US})"""


def _scored_and_labels(spark, sf):
    scored = fx.clicks(spark, sf).select(
        "seq", "click_id", "timestamp", ((F.col("seq") % 97) / F.lit(97.0) >= 0.8).cast("int").alias("is_flagged"))
    late = labelled(spark, sf).where(F.col("os") != "view").select("click_id", "is_fraud", F.timestamp_micros(
        F.col("us") + F.col("seq") % 50 * 60_000_000).alias("label_time"))
    return spill(scored, "scored"), spill(late, "late")


def _live(spark, sf, build):
    """Both streams in two runs by time, then one row a year later in each, which moves the watermark on.

    Every label comes twice.
    """
    scored, late = _scored_and_labels(spark, sf)
    rows, came, sink, checkpoint = (folder(spark, n) for n in ("rows", "labels", "sink", "checkpoint"))
    ends = scored.agg(((F.unix_micros(F.min("timestamp")) + F.unix_micros(F.max("timestamp"))) / 2).cast("long").alias("m"),
                      (F.max("timestamp") + F.expr("interval 1 year")).alias("end"))
    middle, end = ends.select(F.timestamp_micros("m"), "end").first()
    beat = [("end", end)]
    parts = [(scored.where(F.col("timestamp") < middle), late.where(F.col("label_time") < middle)),
             (scored.where(F.col("timestamp") >= middle), late.where(F.col("label_time") >= middle)),
             (spark.createDataFrame(beat, "click_id string, timestamp timestamp"),
              spark.createDataFrame(beat, "click_id string, label_time timestamp"))]
    for a, b in parts:
        a.write.mode("append").parquet(rows)
        b.write.mode("append").parquet(came)
        b.write.mode("append").parquet(came)
        joined = labels.late_labels(
            scoring.read_file_stream(spark, rows, scored.schema, files_per_batch=1000),
            scoring.read_file_stream(spark, came, late.schema, files_per_batch=1000), wait=_WAIT)
        scoring.drain(scoring.to_files(build(joined), sink, checkpoint, "parquet"))
    return spark.read.parquet(sink)


@query("late_labels_stream", f"{_LATE_SQL} SELECT seq, is_flagged, is_fraud, label_us FROM joined")
def late_labels_stream(spark, sf):
    """Scored clicks and their labels as both arrive; clicks whose label does not come in time have none."""
    out = _live(spark, sf, lambda joined: joined)
    return out.where("seq is not null").select("seq", "is_flagged", "is_fraud", us_of("label_time", "label_us"))


_DRIFT_SQL = f"""{_LATE_SQL}
SELECT us - us % 600000000 AS bucket_us, count(*) AS n, count(is_fraud) AS labelled,
       count(*) FILTER (WHERE is_fraud = 1) AS fraud,
       round(coalesce(sum(is_fraud * is_flagged) / nullif(count(is_fraud) FILTER (WHERE is_flagged = 1), 0)::DOUBLE, 0.0), 6) + 0.0 AS precision,
       round(coalesce(sum(is_fraud * is_flagged) / nullif(sum(is_fraud), 0)::DOUBLE, 0.0), 6) + 0.0 AS recall
FROM joined GROUP BY 1"""


def _drift_columns(out):
    return out.select(us_of("bucket", "bucket_us"), "n", "labelled", "fraud", r6("precision"), r6("recall"))


@query("live_drift_stream", _DRIFT_SQL)
def live_drift_stream(spark, sf):
    """Precision and recall per window, summed behind the join of both streams."""
    return _drift_columns(_live(spark, sf, labels.live_drift))


@query("live_drift_batch", _DRIFT_SQL)
def live_drift_batch(spark, sf):
    """The same report of stored scores and labels."""
    scored, late = _scored_and_labels(spark, sf)
    return _drift_columns(labels.live_drift(labels.late_labels(scored, late, wait=_WAIT)))


@query("monitor_totals", f"""WITH {MESSAGES_SQL}
SELECT count(*) FILTER (WHERE NOT is_malformed AND errors = '') AS valid,
       count(*) FILTER (WHERE NOT is_malformed AND errors <> '') AS invalid,
       count(*) FILTER (WHERE is_malformed) AS malformed_json, count(*) AS total,
       CAST(4 AS BIGINT) AS batches, count(*) AS stored FROM checked""")
def monitor_totals(spark, sf):
    """Totals that a listener adds up over the micro-batches of two runs, and the messages that were stored."""
    source, sink, checkpoint = (folder(spark, n) for n in ("source", "sink", "checkpoint"))
    rows = spill(messages(spark, sf).select("value"), "messages")
    found = []
    for half in (0, 1):
        rows.where(F.pmod(F.hash("value"), F.lit(2)) == half).repartition(2).write.mode("append").text(source)
        stream = readers.read_click_stream(spark, "text", path=source, maxFilesPerTrigger=1)
        found.append(scoring.monitor_totals(stream, sink, checkpoint))
    sums = found[0].unionByName(found[1]).agg(*[F.sum(c).alias(c) for c in found[0].columns])
    return sums.withColumn("stored", F.lit(spark.read.parquet(sink).count()).cast("long"))


# --- sketches ------------------------------------------------------------------------------

def _latencies(spark, sf):
    ms = F.greatest(F.lit(0.0), F.round(F.col("value") * 7.0 - 3.0, 3))
    return fx.table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("timestamp"), F.col("user_id").cast("string").alias("ip"),
        F.when(F.col("event_type") != "error", ms).alias("latency_ms"))


def _sketched(spark, sf):
    """Four micro-batches of latencies, each replayed once into its own folder."""
    rows, source, path, checkpoint = _latencies(spark, sf), *(folder(spark, n) for n in ("source", "sketches", "checkpoint"))
    rows.repartition(4).write.parquet(source)
    sink = sketches.sketch_sink(path, every="1 day")

    def twice(batch, batch_id):
        sink(batch, batch_id)
        sink(batch, batch_id)

    scoring.drain(scoring.read_file_stream(spark, source, rows.schema).writeStream.foreachBatch(twice).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start())
    return rows, sketches.read_sketches(spark, path)


@query("sketched_report", """WITH l AS (
  SELECT CAST(floor(epoch_us(ts) / 86400000000.0 / 7) AS BIGINT) AS week, CASE WHEN event_type <> 'error' THEN
    greatest(0.0, round(value * 7.0 - 3.0, 3)) END AS ms FROM events)
SELECT week, count(*) AS rows, count(ms) AS n, round(min(ms), 6) + 0.0 AS min, round(max(ms), 6) + 0.0 AS max,
       round(avg(ms), 4) + 0.0 AS mean, true AS p50_ok, true AS p95_ok, true AS p99_ok, true AS keys_ok FROM l GROUP BY 1""")
def sketched_report(spark, sf):
    """Weeks merged from sketches of days and micro-batches. A quantile is right where its rank among
    the week's own values is within twice the sketch's error, distinct users within 8 % of the exact count."""
    rows, stored = _sketched(spark, sf)
    week = lambda c: F.floor(F.unix_micros(c) / 86_400_000_000.0 / 7)
    report = sketches.sketched_report(sketches.merge_sketches(
        stored.withColumn("week", week("bucket")), by=["week"])).drop("bucket")
    truth = rows.withColumn("week", week("timestamp")).groupBy("week").agg(F.count_distinct("ip").alias("exact"))
    cuts = report.select("week", *sketches.QUANTILES)
    ranks = rows.where("latency_ms is not null").withColumn("week", week("timestamp")).join(cuts, "week").groupBy("week").agg(*[
        f.alias(f"{side}_{name}") for name in sketches.QUANTILES for side, f in (
            ("under", F.avg((F.col("latency_ms") < F.col(name)).cast("double"))),
            ("upto", F.avg((F.col("latency_ms") <= F.col(name)).cast("double"))))])
    near = 2 * sketches.RANK_ERROR
    ok = [((F.col(f"under_{name}") <= p + near) & (F.col(f"upto_{name}") >= p - near)).alias(f"{name}_ok")
          for name, p in sketches.QUANTILES.items()]
    return report.join(truth, "week").join(ranks, "week", "left").select(
        "week", "rows", "n", r6("min"), r6("max"), (F.round("mean", 4) + 0.0).alias("mean"), *ok,
        (F.abs(F.col("keys") - F.col("exact")) <= 0.08 * F.col("exact")).alias("keys_ok"))
