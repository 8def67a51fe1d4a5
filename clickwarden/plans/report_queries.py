"""Queries on transactions, summaries, metrics and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickwarden.operators import eda, features, metrics, reconcile, transactions
from clickwarden.operators.ordering import quantiles
from clickwarden.plans import fixtures as fx
from clickwarden.plans.feature_queries import (
    COUNT_FEATURES, FEATURES_SQL, LABEL_SQL, OTHER_FEATURES, TXN_ORDER, all_features, feature_columns, labelled,
)
from clickwarden.plans.registry import big, query, r6, us_of
from clickwarden.runtime import spill

_KEYED = f"WITH {fx.TXN_SQL}"


@query("filter_types", f"{_KEYED} SELECT {', '.join(fx.TIE)}, type, amount FROM txn_keyed")
def filter_types(spark, sf):
    return transactions.filter_types(fx.transactions(spark, sf)).select(*fx.TIE, "type", "amount")


@query("txn_key", f"{_KEYED} SELECT txn_key, isFraud FROM txn_keyed")
def txn_key(spark, sf):
    scorable = transactions.filter_types(fx.transactions(spark, sf))
    return transactions.txn_key(scorable).select("txn_key", "isFraud")


_ORDER = ", ".join(TXN_ORDER)


@query("transaction_features", f"""{_KEYED}
SELECT txn_key, step, nameDest, isFraud, amount, CAST(1 AS INTEGER) AS is_transfer_type,
       round(amount / (oldbalanceOrg + 1), 6) + 0.0 AS amount_to_balance_ratio,
       CAST(row_number() OVER (PARTITION BY nameDest ORDER BY {_ORDER}) - 1 AS BIGINT)
         AS dest_txn_count_so_far FROM txn_keyed""")
def transaction_features(spark, sf):
    out = transactions.transaction_features(fx.transactions(spark, sf), TXN_ORDER)
    return out.select("txn_key", "step", "nameDest", "isFraud", "amount", "is_transfer_type",
                      r6("amount_to_balance_ratio"), "dest_txn_count_so_far")


@query("split_by_quantile", f"""{_KEYED}, q AS (SELECT quantile_cont(step, 0.8) AS q FROM txn_keyed)
SELECT CASE WHEN step <= q THEN 'train' ELSE 'test' END AS part, count(*) AS n,
       CAST(sum(isFraud) AS BIGINT) AS fraud, min(step) AS low, max(step) AS high
FROM txn_keyed, q GROUP BY 1""")
def split_by_quantile(spark, sf):
    scorable = transactions.filter_types(fx.transactions(spark, sf))
    train, test = transactions.split_by_quantile(scorable)
    both = train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), big(F.sum("isFraud"), "fraud"),
        F.min("step").alias("low"), F.max("step").alias("high"))


@query("quantiles", """SELECT p, round(v, 6) + 0.0 AS value FROM (
  SELECT unnest([0.0, 0.25, 0.5, 0.8, 0.99, 1.0]::DOUBLE[]) AS p,
         unnest(quantile_cont(l_extendedprice, [0.0, 0.25, 0.5, 0.8, 0.99, 1.0])) AS v
  FROM lineitem)""")
def quantiles_query(spark, sf):
    out = quantiles(fx.table(spark, sf, "lineitem"), "l_extendedprice",
                    [0.0, 0.25, 0.5, 0.8, 0.99, 1.0])
    return out.select("p", r6("value"))


@query("filter_impact", f"""WITH {fx.TXN_SQL}
SELECT count(*) AS total, count(*) FILTER (WHERE type <> 'PAYMENT') AS kept,
       CAST(sum(isFraud) AS BIGINT) AS fraud,
       count(*) FILTER (WHERE type <> 'PAYMENT' AND isFraud = 1) AS fraud_kept,
       round(1 - count(*) FILTER (WHERE type <> 'PAYMENT') / count(*)::DOUBLE, 6) + 0.0
         AS removed_share,
       round(count(*) FILTER (WHERE type <> 'PAYMENT' AND isFraud = 1) / sum(isFraud)::DOUBLE, 6)
         + 0.0 AS fraud_recall FROM txn""")
def filter_impact(spark, sf):
    out = transactions.filter_impact(fx.transactions(spark, sf))
    return out.select("total", "kept", "fraud", "fraud_kept", r6("removed_share"),
                      r6("fraud_recall"))


@query("fraud_rate_by_type", f"""WITH {fx.TXN_SQL}
SELECT type, count(*) AS clicks, CAST(sum(isFraud) AS BIGINT) AS fraud,
       round(avg(isFraud), 6) + 0.0 AS fraud_rate FROM txn GROUP BY type""")
def fraud_rate_by_type(spark, sf):
    out = eda.fraud_rate_by(fx.transactions(spark, sf), "type", "isFraud")
    return out.select("type", "clicks", "fraud", r6("fraud_rate"))


# --- summaries ---------------------------------------------------------------------------

_LABELLED = f"WITH {fx.CLICKS_SQL}{LABEL_SQL}"


@query("click_summary", f"""{_LABELLED}
SELECT count(*) AS clicks, CAST(sum(is_fraud) AS BIGINT) AS fraud,
       CAST(sum(is_attributed) AS BIGINT) AS attributed, count(DISTINCT ip) AS unique_ips,
       min(us) AS first_us, max(us) AS last_us, round(avg(is_fraud), 6) + 0.0 AS fraud_rate,
       round(avg(is_attributed), 6) + 0.0 AS attribution_rate FROM labelled""")
def click_summary(spark, sf):
    out = eda.click_summary(labelled(spark, sf))
    return out.select("clicks", "fraud", "attributed", "unique_ips",
                      us_of("first_time", "first_us"), us_of("last_time", "last_us"),
                      r6("fraud_rate"), r6("attribution_rate"))


def _rate_sql(column: str) -> str:
    return f"""{_LABELLED}
SELECT {column}, count(*) AS clicks, CAST(sum(is_fraud) AS BIGINT) AS fraud,
       round(avg(is_fraud), 6) + 0.0 AS fraud_rate FROM labelled GROUP BY 1"""


def _rate_by(spark, sf, column):
    return eda.fraud_rate_by(labelled(spark, sf), column).select(
        column, "clicks", "fraud", r6("fraud_rate"))


@query("fraud_rate_by_campaign", _rate_sql("campaign_id"))
def fraud_rate_by_campaign(spark, sf):
    return _rate_by(spark, sf, "campaign_id")


@query("fraud_rate_by_publisher", _rate_sql("publisher_id"))
def fraud_rate_by_publisher(spark, sf):
    return _rate_by(spark, sf, "publisher_id")


@query("clicks_per_hour", f"""WITH {fx.CLICKS_SQL}
SELECT strftime(make_timestamp(us), '%Y-%m-%d %H') AS hour, count(*) AS clicks
FROM clicks GROUP BY 1""")
def clicks_per_hour(spark, sf):
    return eda.clicks_per_hour(fx.clicks(spark, sf))


_MINUTE_SQL = """, m AS (SELECT us // 60000000 AS m, count(*) AS n FROM {source} GROUP BY 1),
span AS (SELECT unnest(range(min(m), max(m) + 1)) AS m FROM m)
SELECT span.m * 60000000 AS minute_us, coalesce(n, 0) AS clicks
FROM span LEFT JOIN m USING (m)"""


@query("clicks_per_minute", f"WITH {fx.CLICKS_SQL}{_MINUTE_SQL.replace('{source}', 'clicks')}")
def clicks_per_minute(spark, sf):
    out = eda.clicks_per_minute(fx.clicks(spark, sf))
    return out.select(us_of("minute", "minute_us"), "clicks")


@query("installs_per_minute", f"""WITH {fx.CLICKS_SQL}, a AS (
  SELECT attributed_us AS us FROM clicks WHERE attributed_us IS NOT NULL)
{_MINUTE_SQL.replace('{source}', 'a')}""")
def installs_per_minute(spark, sf):
    """Sparse times, so that most minutes are filled with zero."""
    out = eda.clicks_per_minute(fx.clicks(spark, sf), "attributed_time")
    return out.select(us_of("minute", "minute_us"), "clicks")


@query("label_balance", f"{_LABELLED} SELECT is_fraud, count(*) AS count FROM labelled GROUP BY 1")
def label_balance(spark, sf):
    return eda.label_balance(labelled(spark, sf))


def _top_sql(column: str, limit: int, smallest: int) -> str:
    return f"""{_LABELLED}
SELECT {column} AS id, count(*) AS clicks, round(avg(is_fraud), 6) + 0.0 AS fraud_rate
FROM labelled GROUP BY 1 HAVING count(*) >= {smallest}
ORDER BY avg(is_fraud) DESC, count(*) DESC, id LIMIT {limit}"""


@query("top_rates_campaign", _top_sql("campaign_id", 5, 100))
def top_rates_campaign(spark, sf):
    return eda.top_rates(labelled(spark, sf), "campaign_id").select("id", "clicks", r6("fraud_rate"))


@query("top_rates_publisher", _top_sql("publisher_id", 5, 100))
def top_rates_publisher(spark, sf):
    return eda.top_rates(labelled(spark, sf), "publisher_id").select("id", "clicks", r6("fraud_rate"))


@query("top_rates_ascending", _top_sql("campaign_id", 15, 100))
def top_rates_ascending(spark, sf):
    return eda.top_rates(labelled(spark, sf), "campaign_id", 15, ascending=True).select(
        "id", "clicks", r6("fraud_rate"))


@query("busiest_ips", f"""WITH {fx.CLICKS_SQL}
SELECT ip, count(*) AS clicks, round(avg(is_attributed), 6) + 0.0 AS attribution_rate
FROM clicks GROUP BY ip ORDER BY count(*) DESC, ip LIMIT 5""")
def busiest_ips(spark, sf):
    return eda.busiest_ips(fx.clicks(spark, sf)).select("ip", "clicks", r6("attribution_rate"))


@query("busiest_hour", f"""WITH {fx.CLICKS_SQL}
SELECT strftime(make_timestamp(us), '%Y-%m-%d %H') AS hour, count(*) AS clicks
FROM clicks GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def busiest_hour(spark, sf):
    return eda.busiest_hour(fx.clicks(spark, sf))


@query("head_sample", f"""WITH {fx.CLICKS_SQL}
SELECT seq, us, click_id FROM clicks ORDER BY us, seq LIMIT 1000""")
def head_sample(spark, sf):
    return eda.head_sample(fx.clicks(spark, sf), 1000, ["us", "seq"]).select("seq", "us", "click_id")


# --- metrics -----------------------------------------------------------------------------

def pairs(spark, sf):
    return reconcile.reconcile(
        fx.speed_scores(spark, sf), fx.batch_scores(spark, sf), "click_id")


def _ranked(layer: str) -> str:
    return f"""WITH {fx.PAIRS_SQL}, s AS (
  SELECT {layer}_probability AS p, sum(true_label) AS pos, sum(1 - true_label) AS neg
  FROM pairs GROUP BY 1),
c AS (SELECT p, pos, neg, sum(pos) OVER (ORDER BY p DESC) AS tp,
             sum(neg) OVER (ORDER BY p DESC) AS fp FROM s),
t AS (SELECT sum(pos)::DOUBLE AS np, sum(neg)::DOUBLE AS nn FROM s)"""


def _labelled_pairs(spark, sf, layer="speed"):
    return pairs(spark, sf).select(
        F.col("true_label").alias("label"), F.col(f"{layer}_probability").alias("score"))


@query("roc_auc", f"""{_ranked('speed')}
SELECT round(sum(neg * (tp - pos / 2.0::DOUBLE)) / any_value(np * nn), 6) + 0.0 AS roc_auc
FROM c, t""")
def roc_auc(spark, sf):
    return metrics.roc_auc(_labelled_pairs(spark, sf)).select(r6("roc_auc"))


@query("average_precision", f"""{_ranked('speed')}
SELECT round(sum(pos * tp / (tp + fp)::DOUBLE) / any_value(np), 6) + 0.0 AS pr_auc FROM c, t""")
def average_precision(spark, sf):
    return metrics.average_precision(_labelled_pairs(spark, sf)).select(r6("pr_auc"))


_CURVE = """, curve AS (
  SELECT p AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
         tp / (tp + fp)::DOUBLE AS precision, tp / np AS recall FROM c, t),
f AS (SELECT *, 2 * precision * recall / greatest(precision + recall, 1e-12) AS f1 FROM curve)"""


@query("pr_curve", f"""{_ranked('speed')}{_CURVE}
SELECT round(threshold, 6) + 0.0 AS threshold, tp, fp, round(precision, 6) + 0.0 AS precision,
       round(recall, 6) + 0.0 AS recall, round(f1, 6) + 0.0 AS f1 FROM f""")
def pr_curve(spark, sf):
    out = metrics.pr_curve(_labelled_pairs(spark, sf))
    return out.select(r6("threshold"), big("tp"), big("fp"), r6("precision"), r6("recall"), r6("f1"))


@query("best_f1_threshold", f"""{_ranked('speed')}{_CURVE}
SELECT round(threshold, 6) + 0.0 AS threshold, round(f1, 6) + 0.0 AS f1 FROM f
ORDER BY f.f1 DESC, f.threshold LIMIT 1""")
def best_f1_threshold(spark, sf):
    return metrics.best_f1_threshold(_labelled_pairs(spark, sf)).select(r6("threshold"), r6("f1"))


@query("class_weight", f"""{_LABELLED}
SELECT CAST(sum(is_fraud) AS BIGINT) AS positives, CAST(sum(1 - is_fraud) AS BIGINT) AS negatives,
       round(sum(1 - is_fraud) / sum(is_fraud)::DOUBLE, 6) + 0.0 AS class_weight FROM labelled""")
def class_weight(spark, sf):
    out = metrics.class_weight(labelled(spark, sf), "is_fraud")
    return out.select("positives", "negatives", r6("class_weight"))


@query("single_feature_auc", f"""WITH {FEATURES_SQL}{LABEL_SQL}, long AS (
  SELECT feature, CAST(v AS DOUBLE) AS v, is_fraud FROM (
    UNPIVOT (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in COUNT_FEATURES)},
                    {', '.join(f'round(CAST({c} AS DOUBLE), 6) + 0.0 AS {c}' for c in OTHER_FEATURES)}, is_fraud
             FROM feat JOIN labelled USING (seq))
    ON {', '.join(COUNT_FEATURES + OTHER_FEATURES)} INTO NAME feature VALUE v)),
s AS (SELECT feature, v, sum(is_fraud) AS pos, sum(1 - is_fraud) AS neg FROM long GROUP BY 1, 2),
c AS (SELECT *, sum(pos) OVER (PARTITION BY feature ORDER BY v DESC) AS tp FROM s)
SELECT feature, round(sum(neg * (tp - pos / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)), 6) + 0.0
  AS roc_auc FROM c GROUP BY feature""")
def single_feature_auc(spark, sf):
    marks = labelled(spark, sf).select("seq", F.col("is_fraud").alias("label"))
    joined = all_features(spark, sf).select("seq", *feature_columns()).join(marks, "seq")
    return metrics.single_feature_auc(joined, COUNT_FEATURES + OTHER_FEATURES).select("feature", r6("roc_auc"))


@query("walk_forward_metrics", f"""WITH {fx.PAIRS_SQL}, b AS (
  SELECT ntile(6) OVER (ORDER BY us, seq) - 1 AS block, true_label, speed_probability AS p FROM pairs),
s AS (SELECT block, p, sum(true_label) AS pos, sum(1 - true_label) AS neg
      FROM b WHERE block > 0 GROUP BY 1, 2),
c AS (SELECT *, sum(pos) OVER (PARTITION BY block ORDER BY p DESC) AS tp,
             sum(neg) OVER (PARTITION BY block ORDER BY p DESC) AS fp FROM s),
f AS (SELECT block, sum(neg * (tp - pos / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)) AS auc,
             sum(pos * tp / (tp + fp)::DOUBLE) / sum(pos) AS ap FROM c GROUP BY block)
SELECT count(*) AS folds, round(avg(auc), 6) + 0.0 AS roc_auc_mean,
       round(stddev_samp(auc), 6) + 0.0 AS roc_auc_std, round(avg(ap), 6) + 0.0 AS pr_auc_mean,
       round(stddev_samp(ap), 6) + 0.0 AS pr_auc_std FROM f""")
def walk_forward_metrics(spark, sf):
    from clickwarden.operators.split import walk_forward_folds

    times = fx.clicks(spark, sf).select("click_id", "seq", "us")
    scored = spill(pairs(spark, sf).join(times, "click_id"), "pairs")
    blocks = walk_forward_folds(scored, 5, ["us", "seq"])
    tested = blocks.where(F.col("block") > 0)
    out = metrics.walk_forward_metrics(tested, "block", "true_label", "speed_probability")
    return out.select("folds", *[r6(n) for n in (
        "roc_auc_mean", "roc_auc_std", "pr_auc_mean", "pr_auc_std")])


@query("apply_threshold", f"""WITH {fx.CLICKS_SQL}
SELECT seq, CAST((seq % 101) / 101.0::DOUBLE >= 0.859968::DOUBLE AS INTEGER) AS is_flagged,
       round((seq % 101) / 101.0::DOUBLE, 6) + 0.0 AS fraud_probability FROM clicks""")
def apply_threshold(spark, sf):
    c = fx.clicks(spark, sf).select("seq", ((F.col("seq") % 101) / F.lit(101.0)).alias("p"))
    out = metrics.apply_threshold(c, 0.859968, "p")
    return out.select("seq", "is_flagged", r6("fraud_probability"))


@query("flagged", f"WITH {fx.PAIRS_SQL} SELECT seq, p AS fraud_probability FROM speed WHERE flag = 1")
def flagged(spark, sf):
    return eda.flagged(fx.speed_scores(spark, sf)).select("seq", "fraud_probability")


@query("score_histogram", f"""WITH {fx.PAIRS_SQL}, v AS (
  SELECT 'speed_probability' AS layer, speed_probability AS p FROM pairs
  UNION ALL SELECT 'batch_probability', batch_probability FROM pairs),
e AS (SELECT layer, min(p) AS lo, (max(p) - min(p)) / 50 AS w FROM v GROUP BY 1),
h AS (SELECT layer, least(CAST(floor((p - lo) / w) AS INTEGER), 49) AS bin, count(*) AS n
      FROM v JOIN e USING (layer) GROUP BY 1, 2),
g AS (SELECT layer, lo, w, CAST(unnest(range(50)) AS INTEGER) AS bin FROM e)
SELECT layer, bin, round(lo + bin * w, 6) + 0.0 AS bin_start, coalesce(n, 0) AS n
FROM g LEFT JOIN h USING (layer, bin)""")
def score_histogram(spark, sf):
    out = metrics.score_histogram(
        pairs(spark, sf), ["speed_probability", "batch_probability"], 50)
    return out.select("layer", "bin", r6("bin_start"), "n")


@query("latency_report", """WITH l AS (
  SELECT CASE WHEN event_type <> 'error' THEN
    greatest(0.0, round(value * 7.0 - 3.0, 3)) END AS ms FROM events)
SELECT count(ms) AS n, round(min(ms), 6) + 0.0 AS min, round(quantile_cont(ms, 0.5), 6) + 0.0 AS p50,
       round(quantile_cont(ms, 0.95), 6) + 0.0 AS p95, round(quantile_cont(ms, 0.99), 6) + 0.0 AS p99,
       round(max(ms), 6) + 0.0 AS max, round(avg(ms), 4) + 0.0 AS mean FROM l""")
def latency_report(spark, sf):
    ms = F.greatest(F.lit(0.0), F.round(F.col("value") * 7.0 - 3.0, 3))
    e = fx.table(spark, sf, "events").select(
        F.when(F.col("event_type") != "error", ms).alias("latency_ms"))
    out = metrics.latency_report(e)
    return out.select("n", *[r6(c) for c in ("min", "p50", "p95", "p99", "max")],
                      (F.round("mean", 4) + 0.0).alias("mean"))


@query("latency_ms", f"""WITH {fx.CLICKS_SQL}
SELECT seq, round(coalesce(greatest(0.0, round((attributed_us - us) / 1000.0::DOUBLE, 3)), 0.0), 3)
  + 0.0 AS latency_ms FROM clicks""")
def latency_ms(spark, sf):
    from clickwarden.functions import latency_ms as latency

    c = fx.clicks(spark, sf)
    return c.select("seq", (latency(F.col("timestamp"), F.col("attributed_time")) + 0.0)
                    .alias("latency_ms"))


# --- reconciliation ----------------------------------------------------------------------

_PAIR_COLUMNS = """click_id, true_label, round(speed_probability, 6) + 0.0 AS speed_probability,
  speed_flagged, round(batch_probability, 6) + 0.0 AS batch_probability, batch_flagged,
  speed_dest_count, batch_dest_count"""


def _pair_columns():
    return ["click_id", "true_label", r6("speed_probability"), "speed_flagged",
            r6("batch_probability"), "batch_flagged", "speed_dest_count", "batch_dest_count"]


@query("reconcile", f"WITH {fx.PAIRS_SQL} SELECT {_PAIR_COLUMNS} FROM pairs")
def reconcile_query(spark, sf):
    return pairs(spark, sf).select(*_pair_columns())


@query("reconcile_classes", f"""WITH {fx.PAIRS_SQL}
SELECT click_id, CASE WHEN true_label = 1 THEN 'fraud' WHEN speed_flagged <> batch_flagged
  THEN 'disagree' ELSE 'agree' END AS pair_class,
  CAST(speed_flagged <> batch_flagged AS INTEGER) AS disagrees,
  batch_dest_count - speed_dest_count AS dest_count_gap FROM pairs""")
def reconcile_classes(spark, sf):
    out = reconcile.reconcile_classes(pairs(spark, sf))
    return out.select("click_id", "pair_class", "disagrees", "dest_count_gap")


@query("agreement_rate", f"""WITH {fx.PAIRS_SQL}
SELECT round(avg(CAST(speed_flagged = batch_flagged AS INTEGER)), 6) + 0.0 AS agreement_rate
FROM pairs""")
def agreement_rate(spark, sf):
    return reconcile.agreement_rate(pairs(spark, sf)).select(r6("agreement_rate"))


@query("flag_breakdown", f"""WITH {fx.PAIRS_SQL}
SELECT speed_flagged, batch_flagged, count(*) AS count FROM pairs GROUP BY 1, 2 ORDER BY 1, 2""")
def flag_breakdown(spark, sf):
    return reconcile.flag_breakdown(pairs(spark, sf))


def _side(name, condition, function, side):
    @query(name, f"WITH {fx.PAIRS_SQL} SELECT {_PAIR_COLUMNS} FROM pairs WHERE {condition}")
    def run(spark, sf):
        return function(pairs(spark, sf), side).select(*_pair_columns())
    return run


_side("disagreements_speed", "speed_flagged = 1 AND batch_flagged = 0", reconcile.disagreements, "speed")
_side("disagreements_batch", "speed_flagged = 0 AND batch_flagged = 1", reconcile.disagreements, "batch")
_side("false_negatives_speed", "true_label = 1 AND speed_flagged = 0", reconcile.false_negatives, "speed")
_side("false_negatives_batch", "true_label = 1 AND batch_flagged = 0", reconcile.false_negatives, "batch")


@query("layer_metrics", f"""WITH {fx.PAIRS_SQL}, v AS (
  SELECT 'speed' AS layer, speed_probability AS p, true_label AS y FROM pairs
  UNION ALL SELECT 'batch', batch_probability, true_label FROM pairs),
s AS (SELECT layer, p, sum(y) AS pos, sum(1 - y) AS neg FROM v GROUP BY 1, 2),
c AS (SELECT *, sum(pos) OVER (PARTITION BY layer ORDER BY p DESC) AS tp,
             sum(neg) OVER (PARTITION BY layer ORDER BY p DESC) AS fp FROM s)
SELECT layer, CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
       round(sum(neg * (tp - pos / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)), 6) + 0.0 AS roc_auc,
       round(sum(pos * tp / (tp + fp)::DOUBLE) / sum(pos), 6) + 0.0 AS pr_auc FROM c GROUP BY layer""")
def layer_metrics(spark, sf):
    out = reconcile.layer_metrics(pairs(spark, sf))
    return out.select("layer", big("positives"), big("negatives"), r6("roc_auc"), r6("pr_auc"))


@query("reconcile_summary", f"""WITH {fx.PAIRS_SQL}
SELECT (SELECT count(*) FROM speed) AS speed_rows, (SELECT count(*) FROM batch) AS batch_rows,
       count(*) AS matched_rows, count(*) FILTER (WHERE true_label = 1) AS matched_fraud FROM pairs""")
def reconcile_summary(spark, sf):
    return reconcile.reconcile_summary(
        fx.speed_scores(spark, sf), fx.batch_scores(spark, sf), pairs(spark, sf))


@query("attach_labels", f"""WITH {fx.CLICKS_SQL}{LABEL_SQL}
SELECT clicks.seq, l.is_fraud FROM clicks
LEFT JOIN (SELECT click_id, is_fraud FROM labelled WHERE os <> 'view') l USING (click_id)""")
def attach_labels(spark, sf):
    late = labelled(spark, sf).where(F.col("os") != "view")
    return reconcile.attach_labels(fx.clicks(spark, sf), late).select("seq", "is_fraud")


@query("drift_over_time", f"""WITH {fx.PAIRS_SQL}
SELECT us // 600000000 AS bucket, count(*) AS n, count(*) FILTER (WHERE true_label = 1) AS fraud,
  round(coalesce(sum(true_label * speed_flagged) / nullif(sum(speed_flagged), 0)::DOUBLE, 0.0), 6) + 0.0
    AS speed_precision,
  round(coalesce(sum(true_label * speed_flagged) / nullif(sum(true_label), 0)::DOUBLE, 0.0), 6) + 0.0
    AS speed_recall,
  round(coalesce(sum(true_label * batch_flagged) / nullif(sum(batch_flagged), 0)::DOUBLE, 0.0), 6) + 0.0
    AS batch_precision,
  round(coalesce(sum(true_label * batch_flagged) / nullif(sum(true_label), 0)::DOUBLE, 0.0), 6) + 0.0
    AS batch_recall
FROM pairs GROUP BY 1""")
def drift_over_time(spark, sf):
    timed = pairs(spark, sf).join(fx.clicks(spark, sf).select("click_id", "us"), "click_id")
    out = reconcile.drift_over_time(timed, F.expr("us div 600000000"))
    return out.select("bucket", "n", "fraud", *[
        r6(f"{layer}_{m}") for layer in ("speed", "batch") for m in ("precision", "recall")])
