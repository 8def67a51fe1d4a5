"""Queries on files, tables, models and streams.

Sinks and streams write to a fresh folder below the session's scratch folder and are read
back, so every query exercises the write and the scan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from clickwarden import schemas
from clickwarden.operators import ingest, metrics, models, ordering, split, transactions
from clickwarden.plans import fixtures as fx
from clickwarden.plans.feature_queries import (
    COUNT_FEATURES, FEATURES_PER_IP_SQL, FEATURES_SQL, LABEL_SQL, MAPPED_SQL, MESSAGES_SQL, TXN_ORDER,
    all_features, feature_columns, labelled, mapped_columns, messages, snapshots,
)
from clickwarden.plans.registry import big, query, r6
from clickwarden.runtime import scratch_root, spill, stages
from clickwarden.sources import readers, writers
from clickwarden.streaming import scoring, state


def folder(spark, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


# --- files and tables ----------------------------------------------------------------------

@query("scan_raw_clicks", MAPPED_SQL)
def scan_raw_clicks(spark, sf):
    path = folder(spark, "raw-csv")
    fx.raw_clicks(spark, sf).drop("seq").write.option("header", True).option(
        "emptyValue", "").csv(path)
    return ingest.map_clicks(readers.read_raw_clicks(spark, path)).select(*mapped_columns())


@query("number_source_rows", f"""WITH {fx.RAW_SQL}
SELECT raw.ip, raw.click_time, row_number() OVER (ORDER BY us, seq) - 1 AS source_row
FROM raw JOIN clicks USING (seq)""")
def number_source_rows(spark, sf):
    """Row numbers of a CSV source that was written in time order."""
    path = folder(spark, "raw-csv")
    times = fx.clicks(spark, sf).select("seq", "us")
    fx.raw_clicks(spark, sf).join(times, "seq").orderBy("us", "seq").drop("seq", "us").write.option(
        "header", True).option("emptyValue", "").csv(path)
    out = readers.read_raw_clicks(spark, path, "source_row")
    return out.select("ip", "click_time", big("source_row"))


@query("scan_clicks", MAPPED_SQL)
def scan_clicks(spark, sf):
    path = folder(spark, "clicks-csv")
    writers.write_clicks(ingest.map_clicks(fx.raw_clicks(spark, sf)), path)
    return readers.read_clicks(spark, path).select(*mapped_columns())


@query("scan_transactions", f"""WITH {fx.TXN_SQL}
SELECT step, type, amount, nameOrig, oldbalanceOrg, nameDest, isFraud FROM txn""")
def scan_transactions(spark, sf):
    path = folder(spark, "transactions-csv")
    fx.transactions(spark, sf).select(*schemas.TRANSACTION.fieldNames()).write.option(
        "header", True).csv(path)
    return readers.read_transactions(spark, path)


@query("click_messages", f"""WITH {fx.CLICKS_SQL}
SELECT ip AS key, '{{"click_id":"' || click_id || '","ip":"' || ip || '","is_attributed":'
  || is_attributed || '}}' AS value FROM clicks""")
def click_messages(spark, sf):
    c = fx.clicks(spark, sf).select("click_id", "ip", "is_attributed")
    return writers.click_messages(c)


@query("scan_staging", f"""WITH {fx.PAIRS_SQL}
SELECT click_id, flag AS is_flagged, round(p, 6) + 0.0 AS fraud_probability FROM speed""")
def scan_staging(spark, sf):
    path = folder(spark, "staging")
    fx.speed_scores(spark, sf).withColumn(
        "bucket", F.date_format(F.timestamp_micros("us"), "yyyy-MM-dd--HH")
    ).write.partitionBy("bucket").json(path)
    schema = "click_id string, fraud_probability double, is_flagged int"
    return readers.read_staging(spark, path, schema).select(
        "click_id", "is_flagged", r6("fraud_probability"))


_UPSERT_SQL = f"""WITH {fx.PAIRS_SQL}
SELECT click_id, flag AS is_flagged, round(p, 6) + 0.0 AS fraud_probability,
       CASE WHEN flag = 1 THEN 'late' END AS note FROM speed"""


def _upserted(spark, sf):
    """The unflagged rows, then all rows twice with a new column."""
    path = folder(spark, "scored")
    s = fx.speed_scores(spark, sf).select("click_id", "is_flagged", "fraud_probability")
    writers.upsert_insert_only(s.where("is_flagged = 0"), path, ["click_id"])
    again = s.unionByName(s).withColumn("note", F.lit("late"))
    writers.upsert_insert_only(again, path, ["click_id"])
    writers.upsert_insert_only(again, path, ["click_id"])
    return path


@query("upsert_insert_only", _UPSERT_SQL)
def upsert_insert_only(spark, sf):
    return readers.read_scored(spark, _upserted(spark, sf)).select(
        "click_id", "is_flagged", r6("fraud_probability"), "note")


@query("commit_history", f"""WITH {fx.PAIRS_SQL}
SELECT CAST(v AS BIGINT) AS version, CASE v WHEN 0 THEN 'CREATE' ELSE 'MERGE' END AS operation,
  CAST((SELECT count(*) FILTER (WHERE v = flag) FROM speed)
       AS BIGINT) AS rows FROM range(3) r(v)""")
def commit_history(spark, sf):
    return writers.commit_history(spark, _upserted(spark, sf)).select("version", "operation", "rows")


@query("catalog_table", f"""WITH {fx.PAIRS_SQL}
SELECT click_id, round(p, 6) + 0.0 AS batch_fraud_probability, flag AS batch_is_flagged,
       fraud AS "isFraud" FROM batch""")
def catalog_table(spark, sf):
    name = f"scored_{uuid.uuid4().hex}"
    writers.publish_batch_table(
        fx.batch_scores(spark, sf), name, location=folder(spark, "catalog"))
    return readers.read_table(spark, name).select(
        "click_id", r6("batch_fraud_probability"), "batch_is_flagged", "isFraud")


@query("snapshot_json", f"""WITH {fx.CLICKS_SQL}, s AS (
  SELECT 'campaign' AS side, campaign_id AS id, count(*) AS c, sum(is_attributed) AS a
  FROM clicks GROUP BY 1, 2
  UNION ALL SELECT 'publisher', publisher_id, count(*), sum(is_attributed) FROM clicks GROUP BY 1, 2)
SELECT side, id, CASE WHEN side = 'campaign' THEN c ELSE 0 END AS clicks,
       CAST(CASE WHEN side = 'campaign' THEN a ELSE 0 END AS BIGINT) AS attributed,
       CASE WHEN side = 'publisher' THEN round(a / c::DOUBLE, 6) + 0.0 END AS rate FROM s""")
def snapshot_json(spark, sf):
    """Counts for campaigns, bare rates for publishers, one line of JSON per id."""
    campaign, publisher = snapshots(fx.clicks(spark, sf))
    path = folder(spark, "snapshot-json")
    counts = F.create_map("id", F.struct("clicks", "attributed"))
    rates = F.create_map("id", F.round(F.col("attributed") / F.col("clicks"), 6))
    lines = campaign.select(F.to_json(F.struct(counts.alias("campaign"))).alias("value"))
    lines.unionByName(
        publisher.select(F.to_json(F.struct(rates.alias("publisher"))).alias("value"))
    ).write.text(path)
    tables = readers.read_snapshots(spark, path, lines=True)
    out = [t.select(F.lit(side).alias("side"), "id", "clicks", "attributed", r6("rate"))
           for side, t in tables.items()]
    return out[0].unionByName(out[1])


# --- models --------------------------------------------------------------------------------

# The settings that the jobs have by default.
TREES, RETRAIN_TREES, DEPTH, ITERATIONS, FOLDS = 120, 200, 6, 500, 5
WARM_TREES = 10  # trees added to half the others, fewer than the default so that the query stays short


def _training(spark, sf, scope="global"):
    marks = labelled(spark, sf).select("seq", "is_fraud")
    # columns that no feature reads would travel through every window
    joined = all_features(spark, sf, scope, keep=["seq", "us"]).join(marks, "seq")
    return joined.select("seq", "us", *schemas.CLICK_FEATURES, "is_fraud")


def _assembled(spark, sf, scope="global"):
    ready = models.assemble(_training(spark, sf, scope), schemas.CLICK_FEATURES, "is_fraud")
    ready = spill(ready.select("seq", "us", *COUNT_FEATURES, "features", "label"), "training")
    return split.chronological_split(ready, 0.2, ["us", "seq"])


def _txn_training(spark, sf):
    feats = transactions.transaction_features(fx.transactions(spark, sf), TXN_ORDER)
    ready = models.assemble(feats, schemas.TRANSACTION_FEATURES, "isFraud")
    return transactions.split_by_quantile(spill(ready, "training"))


# A model's scores have no SQL equal. The oracle checks which rows were scored, and states
# the best ranking that a single count feature gives on them. A model has to get at least
# half way from chance to it, which a constant score does not.
_SPLIT_SQL = f"""{LABEL_SQL}, i AS (
  SELECT seq, is_fraud, row_number() OVER (ORDER BY us, seq) - 1 AS i, count(*) OVER () AS n
  FROM labelled),
test AS (SELECT * FROM i WHERE i >= CAST(floor(n * (1 - 0.2::DOUBLE)) AS BIGINT))"""
_TEST_SQL = f"WITH {fx.CLICKS_SQL}{_SPLIT_SQL}"
_SINGLE_SQL = f"""WITH {FEATURES_SQL}{_SPLIT_SQL}, long AS (
  SELECT feature, CAST(v AS DOUBLE) AS v, is_fraud FROM (
    UNPIVOT (SELECT {', '.join(COUNT_FEATURES)}, is_fraud FROM feat JOIN test USING (seq))
    ON {', '.join(COUNT_FEATURES)} INTO NAME feature VALUE v)),
s AS (SELECT feature, v, sum(is_fraud) AS pos, sum(1 - is_fraud) AS neg FROM long GROUP BY 1, 2),
c AS (SELECT *, sum(pos) OVER (PARTITION BY feature ORDER BY v DESC) AS tp FROM s),
a AS (SELECT feature, sum(neg * (tp - pos / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)) AS auc
      FROM c GROUP BY feature),
best AS (SELECT round(max(auc), 6) + 0.0 AS best_single FROM a)"""


def _best_single(test):
    found = metrics.single_feature_auc(test, COUNT_FEATURES)
    return found.agg(F.max("roc_auc")).first()[0]


def half_way(auc, best):
    return auc >= F.lit(0.5 + 0.5 * (best - 0.5))


def sound(threshold, p="fraud_probability", flag="is_flagged"):
    """The probability lies in [0, 1] and the flag follows the threshold."""
    p, flag = F.col(p), F.col(flag)
    close = F.abs(p - F.lit(threshold)) < 1e-6  # the stored probability is rounded
    return p.between(0.0, 1.0) & (((p >= threshold).cast("int") == flag) | close)


@query("train_gbt", f"{_SINGLE_SQL} SELECT seq, best_single, true AS sound, true AS better FROM test, best")
def train_gbt(spark, sf):
    train, test = _assembled(spark, sf)
    scored = spill(models.score(models.train_gbt(train, TREES, depth=DEPTH), test, 0.5), "scored")
    best = _best_single(test)
    auc = metrics.ranking_metrics(scored, score="fraud_probability").first()["roc_auc"]
    return scored.select("seq", r6(F.lit(best), "best_single"), sound(0.5).alias("sound"),
                         half_way(F.lit(auc), best).alias("better"))


def _compared(names):
    rows = " UNION ALL ".join(f"SELECT '{n}' AS model" for n in names)
    return f"""{_SINGLE_SQL}
SELECT model, CAST(sum(is_fraud) AS BIGINT) AS positives,
       CAST(sum(1 - is_fraud) AS BIGINT) AS negatives, any_value(best_single) AS best_single,
       true AS better
FROM test, best, ({rows}) m GROUP BY model"""


def _comparison(report, test):
    best = _best_single(test)
    better = half_way(F.col("roc_auc"), best) & (
        F.col("pr_auc") > F.col("positives") / (F.col("positives") + F.col("negatives")))
    return report.select("model", big("positives"), big("negatives"),
                         r6(F.lit(best), "best_single"), better.alias("better"))


@query("train_lr", _compared(["logistic_regression"]))
def train_lr(spark, sf):
    train, test = _assembled(spark, sf)
    scored = models.score(models.train_lr(train, ITERATIONS), test)
    return _comparison(metrics.ranking_metrics(scored).withColumn(
        "model", F.lit("logistic_regression")), test)


@query("warm_vs_cold", _compared(["warm_start", "cold_w1_w2"]))
def warm_vs_cold(spark, sf):
    train, test = _assembled(spark, sf)
    return _comparison(models.warm_vs_cold(train, test, TREES, DEPTH, ["us", "seq"]), test)


@query("training_report", _compared(
    ["logistic_regression", "boosted_trees", "warm_start", "cold_w1_w2"]))
def training_report(spark, sf):
    rows = spill(_training(spark, sf).withColumn("label", F.col("is_fraud")), "training")
    report = models.training_report(
        rows.drop("label"), trees=TREES, max_iter=ITERATIONS, depth=DEPTH, order=["us", "seq"])
    return _comparison(report, split.chronological_split(rows, 0.2, ["us", "seq"])[1])


@query("retrain_and_publish", f"""WITH {fx.TXN_SQL}, q AS (
  SELECT quantile_cont(step, 0.8) AS q FROM txn_keyed),
f AS (SELECT *, CAST(row_number() OVER (PARTITION BY nameDest ORDER BY {", ".join(TXN_ORDER)}) - 1
             AS BIGINT) AS dest_txn_count_so_far FROM txn_keyed)
SELECT txn_key, step, "nameDest", "isFraud", amount, dest_txn_count_so_far, true AS sound
FROM f, q WHERE step > q""")
def retrain_and_publish(spark, sf):
    """Load, features, split, training, scoring of the newest part, catalog table."""
    train, test = _txn_training(spark, sf)
    model = models.retrain(train, RETRAIN_TREES, DEPTH)
    scored = models.score(model, test, schemas.TRANSACTION_FLAG_THRESHOLD).select(
        *schemas.TRANSACTION_FEATURES, "isFraud", "step", "nameDest", "txn_key",
        F.col("fraud_probability").alias("batch_fraud_probability"),
        F.col("is_flagged").alias("batch_is_flagged"))
    name = f"scored_{uuid.uuid4().hex}"
    writers.publish_batch_table(scored, name, location=folder(spark, "catalog"))
    return readers.read_table(spark, name).select(
        "txn_key", "step", "nameDest", "isFraud", "amount", "dest_txn_count_so_far",
        sound(0.5, "batch_fraud_probability", "batch_is_flagged").alias("sound"))


@query("publish_features", f"""WITH {fx.TXN_SQL}
SELECT txn_key, step, "nameDest", "isFraud", amount,
       CAST(row_number() OVER (PARTITION BY nameDest ORDER BY {", ".join(TXN_ORDER)}) - 1 AS BIGINT)
         AS dest_txn_count_so_far FROM txn_keyed""")
def publish_features(spark, sf):
    """The batch job without training: load, filter, features, catalog table."""
    feats = transactions.transaction_features(fx.transactions(spark, sf), TXN_ORDER)
    name = f"features_{uuid.uuid4().hex}"
    writers.publish_batch_table(feats, name, location=folder(spark, "catalog"))
    return readers.read_table(spark, name).select(
        "txn_key", "step", "nameDest", "isFraud", "amount", "dest_txn_count_so_far")


@query("walk_forward_training", f"SELECT CAST({FOLDS} AS BIGINT) AS folds, true AS better_than_chance")
def walk_forward_training(spark, sf):
    train, test = _assembled(spark, sf)
    blocks = spill(split.walk_forward_folds(train.unionByName(test), FOLDS, ["us", "seq"]), "blocks")
    scores = models.walk_forward_scores(
        blocks, lambda part: models.train_lr(part, ITERATIONS), FOLDS)
    out = metrics.walk_forward_metrics(scores, "fold")
    return out.select("folds", (F.col("roc_auc_mean") > 0.6).alias("better_than_chance"))


@query("model_store", f"{_TEST_SQL} SELECT seq, true AS same FROM test")
def model_store(spark, sf):
    """Scores of a stored model against those of the model it was stored from."""
    train, test = _assembled(spark, sf)
    path = folder(spark, "model")
    fitted = models.train_gbt(train, TREES, depth=DEPTH)
    models.save_model(fitted, path, schemas.CLICK_FEATURES, spark)
    loaded = models.load_model(path, schemas.CLICK_FEATURES, spark)
    both = models.score(loaded, models.score(fitted, test).withColumnRenamed("score", "p"))
    return both.select("seq", (F.col("score") == F.col("p")).alias("same"))


@query("warm_model_store", f"{_TEST_SQL} SELECT seq, true AS as_chained, true AS as_stored FROM test")
def warm_model_store(spark, sf):
    """A warm-started model stored and loaded: its scores against those of MLlib's own trees, one
    after the other, and against those before it was stored. A changed leaf shows in both."""
    train, test = _assembled(spark, sf)
    older, newer = split.split_history(train, ["us", "seq"])
    base = models.train_gbt(older, TREES // 2, depth=DEPTH)
    added = models.further_trees(base, newer, WARM_TREES, depth=DEPTH)
    warm = models.TreeEnsemble.of(base, added, models.RATE)
    path = folder(spark, "warm_model")
    models.save_model(warm, path, schemas.CLICK_FEATURES, spark)
    loaded = models.load_model(path, schemas.CLICK_FEATURES, spark)
    both = spill(models.score(warm, models.margin(base, test)).withColumnRenamed("score", "before"), "scored")
    for tree in added:
        step = F.col("_margin") + F.lit(models.RATE) * F.col("prediction")
        both = tree.transform(both).withColumn("_margin", step).drop("prediction")
    both = models.score(loaded, both)
    chained = 1 / (1 + F.exp(-2 * F.col("_margin")))
    return both.select("seq", (F.abs(F.col("score") - chained) < 1e-9).alias("as_chained"),
                       (F.col("score") == F.col("before")).alias("as_stored"))


@query("lr_gradient", "SELECT CAST(11 AS BIGINT) AS coefficients, true AS balanced")
def lr_gradient(spark, sf):
    """The balanced, penalised objective's gradient at the trained logistic model is zero but for
    a share of its terms."""
    train, _ = _assembled(spark, sf)
    gradient = models.lr_gradient(models.train_lr(train, ITERATIONS), train)
    return gradient.agg(
        (F.count(F.lit(1)) - 1).alias("coefficients"),
        (F.max(F.abs("gradient") / F.col("scale")) < 0.001).alias("balanced"))


# --- streams -------------------------------------------------------------------------------

def _halves(df, order):
    """The older and the newer half, to feed a stream in time order."""
    return split.split_history(df, order)


TILE_FILE_ROWS = 100_000


def _replayed(spark, df, order, build, copies=1, files=None):
    """Write each half to the source and run the bounded stream on from its checkpoint.

    With ``files`` each half lies in so many tiles by time, and each is a micro-batch, of one file or
    of as many as its rows need.
    """
    source, sink, checkpoint = (folder(spark, n) for n in ("source", "sink", "checkpoint"))
    per_tile = 1000
    for part in _halves(df, order):
        for _ in range(copies):
            if files is None:
                part.write.mode("append").parquet(source)
        if files is not None:
            # one write after the other: the source takes files by the time of their writing
            indexed = ordering.global_index(part, order, "_index")
            rows = indexed.count()
            share = F.expr(f"cast(_index * {files} div {max(1, rows)} as int)")
            per_tile = max(1, rows // files // TILE_FILE_ROWS)
            tiles = spill(indexed.withColumn("_tile", share).drop("_index"), "tiles")
            for tile in range(files):
                rows = tiles.where(F.col("_tile") == tile).drop("_tile")
                rows = rows.coalesce(1) if per_tile == 1 else rows.repartition(per_tile)
                rows.write.mode("append").parquet(source)
        stream = scoring.read_file_stream(spark, source, df.schema, files_per_batch=per_tile)
        scoring.drain(scoring.to_files(build(stream), sink, checkpoint, "parquet"))
    return spark.read.parquet(sink)


_STATE_COLUMNS = ("ip_clicks_1m, ip_clicks_5m, ip_clicks_1h, device_clicks_1m, device_clicks_5m, "
                  "device_clicks_1h, ip_fingerprint_entropy_5m, ip_inter_click_gap_seconds")


@query("enrich_stream", f"WITH {FEATURES_PER_IP_SQL} SELECT seq, {_STATE_COLUMNS} FROM feat")
def enrich_stream(spark, sf):
    c = fx.clicks(spark, sf)
    out = _replayed(spark, c, ["us", "seq"],
                    lambda s: state.enrich_stream(s, clock="event", tie="seq"))
    return out.select("seq", *feature_columns()[:8])


@query("enrich_stream_watermark", f"WITH {FEATURES_PER_IP_SQL} SELECT seq, {_STATE_COLUMNS} FROM feat")
def enrich_stream_watermark(spark, sf):
    """Every click comes twice in each run; a watermark drops replays and the state of idle IPs
    (idle for longer than the clicks last here, so that gaps match the batch)."""
    c = fx.clicks(spark, sf)
    out = _replayed(spark, c, ["us", "seq"], lambda s: state.enrich_stream(
        s, clock="event", tie="seq", delay="1 hour", once=True, ttl_ms=30 * 86_400_000), copies=2)
    return out.select("seq", *feature_columns()[:8])


@query("enrich_stream_own_clock", f"WITH {FEATURES_PER_IP_SQL} SELECT seq, {_STATE_COLUMNS} FROM feat")
def enrich_stream_own_clock(spark, sf):
    """Twenty micro-batches on a clock that is read for every click."""
    c = fx.clicks(spark, sf)
    out = _replayed(spark, c, ["us", "seq"], lambda s: state.enrich_stream(
        s, clock=lambda click: click["us"], tie="seq", ttl_ms=None), files=10)
    return out.select("seq", *feature_columns()[:8])


@query("count_so_far_stream", f"""WITH {fx.TXN_SQL}
SELECT {", ".join(fx.TIE)}, nameDest, CAST(row_number() OVER (
  PARTITION BY nameDest ORDER BY {", ".join(TXN_ORDER)}) - 1 AS BIGINT) AS dest_txn_count_so_far
FROM txn_keyed""")
def count_so_far_stream(spark, sf):
    t = transactions.filter_types(fx.transactions(spark, sf))
    out = _replayed(spark, t, TXN_ORDER,
                    lambda s: state.count_so_far_stream(s, "nameDest", TXN_ORDER))
    return out.select(*fx.TIE, "nameDest", "dest_txn_count_so_far")


@query("enrich_with_history", f"""WITH {FEATURES_SQL}
SELECT seq, {_STATE_COLUMNS}, round(click_to_install_delta_seconds, 6) + 0.0
  AS click_to_install_delta_seconds, campaign_conversion_rate, publisher_conversion_rate FROM feat""")
def enrich_with_history(spark, sf):
    """The whole history is kept, so that gaps match the batch features."""
    c = fx.clicks(spark, sf)
    campaign, publisher = snapshots(c)
    source, sink, checkpoint, history = (
        folder(spark, n) for n in ("source", "sink", "checkpoint", "history"))

    def handle(batch, batch_id):
        enriched = scoring.enrich_with_history(
            batch, batch_id, history, "global", campaign, publisher, keep_seconds=10**9)
        enriched.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    for part in _halves(c, ["us", "seq"]):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(c.schema).parquet(source)
        scoring.drain(stream.writeStream.foreachBatch(handle).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start())
    return spark.read.parquet(sink).select("seq", *feature_columns())


def _scored_stream(spark, sf, model):
    """Keyed features, static rates, score, table and alerts; each score beside that of the same
    model on the features of a batch in the scope of an IP."""
    c = fx.clicks(spark, sf).withColumn("event_timestamp", F.current_timestamp())
    campaign, publisher = snapshots(c)
    source, table, alerts, checkpoint = (
        folder(spark, n) for n in ("source", "scored", "alerts", "checkpoint"))
    c.write.parquet(source)
    stream = spark.readStream.schema(c.schema).parquet(source)
    enriched = state.enrich_stream(stream, clock="event", tie="seq")
    scoring.drain(scoring.score_stream(
        enriched, model, checkpoint,
        scoring.table_sink(table, ["click_id"], scoring.file_alerts(alerts)),
        0.5, campaign, publisher, trigger={"availableNow": True}))
    ready = models.assemble(all_features(spark, sf, "per_ip"), schemas.CLICK_FEATURES, "is_fraud")
    batch = models.score(model, ready, 0.5).select("click_id", F.col("fraud_probability").alias("in_batch"))
    return readers.read_scored(spark, table).join(batch, "click_id", "left").select(
        "click_id", sound(0.5).alias("sound"), (F.col("latency_ms") >= 0).alias("timed"),
        (F.abs(F.col("fraud_probability") - F.col("in_batch")) < 2e-6).alias("as_in_batch"))


@query("score_stream", f"""WITH {fx.CLICKS_SQL}
SELECT click_id, true AS sound, true AS timed, true AS as_in_batch FROM clicks""")
def score_stream(spark, sf):
    """A boosted model on a running stream."""
    train, _ = _assembled(spark, sf, "per_ip")
    return _scored_stream(spark, sf, models.train_gbt(train, TREES, depth=DEPTH))


@query("score_stream_warm", f"""WITH {fx.CLICKS_SQL}
SELECT click_id, true AS sound, true AS timed, true AS as_in_batch FROM clicks""")
def score_stream_warm(spark, sf):
    """A warm-started model, stored and loaded, on a running stream."""
    train, _ = _assembled(spark, sf, "per_ip")
    older, newer = split.split_history(train, ["us", "seq"])
    warm = models.continue_gbt(models.train_gbt(older, TREES // 2, depth=DEPTH), newer, WARM_TREES, depth=DEPTH)
    path = folder(spark, "warm_model")
    models.save_model(warm, path, schemas.CLICK_FEATURES, spark)
    return _scored_stream(spark, sf, models.load_model(path, schemas.CLICK_FEATURES, spark))


@query("score_transaction_stream", f"""WITH {fx.TXN_SQL}
SELECT txn_key, CAST(row_number() OVER (PARTITION BY nameDest ORDER BY {", ".join(TXN_ORDER)}) - 1
         AS BIGINT) AS dest_txn_count_so_far, true AS sound, true AS as_in_batch FROM txn_keyed""")
def score_transaction_stream(spark, sf):
    """Transactions in two runs of a stream: key, count so far, ratio, score, flag, table. Every
    score is that of the same model on the batch features, matched by key and count."""
    t = spill(fx.transactions(spark, sf), "payments")
    feats = spill(transactions.transaction_features(t, TXN_ORDER).select(
        "txn_key", *schemas.TRANSACTION_FEATURES, "isFraud"), "features")
    ready = models.assemble(feats, schemas.TRANSACTION_FEATURES, "isFraud")
    with stages(spark):
        model = models.train_lr(spill(ready.select("features", "label"), "training"), ITERATIONS)
    source, table, alerts, checkpoint = (folder(spark, n) for n in ("source", "scored", "alerts", "checkpoint"))
    keys = ["txn_key", "dest_txn_count_so_far"]
    for part in _halves(t, TXN_ORDER):
        part.write.mode("append").option("compression", "zstd").parquet(source)
        enriched = scoring.enrich_transactions(spark.readStream.schema(t.schema).parquet(source), TXN_ORDER)
        scoring.drain(scoring.score_stream(
            enriched, model, checkpoint, scoring.table_sink(table, keys, scoring.file_alerts(alerts, "gzip")),
            schemas.TRANSACTION_FLAG_THRESHOLD, names=schemas.TRANSACTION_FEATURES, trigger={"availableNow": True}))
    batch = models.score(model, ready, schemas.TRANSACTION_FLAG_THRESHOLD).select(
        *keys, F.col("fraud_probability").alias("p"), F.col("is_flagged").alias("f"))
    return readers.read_scored(spark, table).join(batch, keys, "left").select(
        *keys, sound(schemas.TRANSACTION_FLAG_THRESHOLD).alias("sound"),
        ((F.abs(F.col("fraud_probability") - F.col("p")) < 2e-6) & (F.col("is_flagged") == F.col("f"))).alias("as_in_batch"))


def _flagged_payments(spark, sf):
    rows = transactions.transaction_columns(transactions.filter_types(fx.transactions(spark, sf))).select(
        "txn_key", F.when(F.col("amount") >= 30000, 1).otherwise(0).alias("is_flagged"), "step", "nameDest", "amount")
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("txn_key").orderBy("step")))


def _sunk(spark, rows, sink):
    """Each half of the rows goes through a stream into the sink, on from one checkpoint."""
    source, checkpoint = folder(spark, "source"), folder(spark, "checkpoint")
    for part in _halves(spill(rows, "payments"), ["step", "txn_key", "n"]):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        scoring.drain(stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(
            availableNow=True).start())


@query("alerts_of_stream", f"""WITH {fx.TXN_SQL}
SELECT txn_key, count(*) AS n FROM txn_keyed WHERE amount >= 30000 GROUP BY 1""")
def alerts_of_stream(spark, sf):
    """Flagged rows of a stream as they are read back from its alert files."""
    alerts = folder(spark, "alerts")
    _sunk(spark, _flagged_payments(spark, sf),
          scoring.table_sink(folder(spark, "scored"), ["txn_key", "n"], scoring.file_alerts(alerts)))
    return spark.read.json(alerts).groupBy("txn_key").agg(F.count(F.lit(1)).alias("n"))


@query("json_of_stream", f"""WITH {fx.TXN_SQL}
SELECT txn_key, count(*) AS n, count(*) FILTER (WHERE amount >= 30000) AS flagged FROM txn_keyed GROUP BY 1""")
def json_of_stream(spark, sf):
    """All rows of a stream as they are read back from its JSON lines."""
    target = folder(spark, "lines")
    _sunk(spark, _flagged_payments(spark, sf), scoring.json_sink(target))
    return spark.read.json(target).groupBy("txn_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_flagged").alias("flagged"))


@query("monitor_stream", f"WITH {MESSAGES_SQL} SELECT value, is_malformed, errors FROM checked "
       "JOIN messages USING (seq)")
def monitor_stream(spark, sf):
    source, sink, checkpoint = (folder(spark, n) for n in ("source", "sink", "checkpoint"))
    messages(spark, sf).select("value").write.text(source)
    stream = readers.read_click_stream(spark, "text", path=source)
    scoring.drain(scoring.to_files(scoring.monitored(stream), sink, checkpoint, "parquet"))
    return spark.read.parquet(sink).select(
        "value", "is_malformed", F.array_join("errors", "; ").alias("errors"))


@query("contract_of_stream", f"""WITH {MESSAGES_SQL}
SELECT count(*) FILTER (WHERE NOT is_malformed AND errors = '') AS valid,
       count(*) FILTER (WHERE NOT is_malformed AND errors <> '') AS invalid,
       count(*) FILTER (WHERE is_malformed) AS malformed_json, count(*) AS total FROM checked""")
def contract_of_stream(spark, sf):
    """Totals of a stream that is stopped when all messages have been read, over several batches."""
    source, checkpoint = folder(spark, "source"), folder(spark, "checkpoint")
    messages(spark, sf).select("value").repartition(4).write.text(source)
    stream = readers.read_click_stream(spark, "text", path=source, maxFilesPerTrigger=1)
    found = scoring.check_contract_stream(stream, checkpoint, spark.read.text(source).count(), 600.0)
    return found.drop("messages_per_second")


@query("transaction_stream", f"""WITH {fx.TXN_SQL}
SELECT nameDest, count(*) AS n, CAST(sum(isFraud) AS BIGINT) AS fraud FROM txn_keyed GROUP BY 1""")
def transaction_stream(spark, sf):
    source, sink, checkpoint = (folder(spark, n) for n in ("source", "sink", "checkpoint"))
    t = fx.transactions(spark, sf).select(*schemas.TRANSACTION.fieldNames())
    writers.click_messages(t, "nameDest").select("value").write.text(source)
    rows, _ = scoring.transaction_stream(readers.read_click_stream(spark, "text", path=source))
    scoring.drain(scoring.to_files(rows, sink, checkpoint, "parquet"))
    return spark.read.parquet(sink).groupBy("nameDest").agg(
        F.count(F.lit(1)).alias("n"), big(F.sum("isFraud"), "fraud"))
