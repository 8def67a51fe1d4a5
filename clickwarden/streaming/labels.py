"""Labels that arrive later than the scores, joined while both streams run.

``late_labels`` holds a scored row until its label comes or the wait is over. ``live_drift``
sums what came of the scores per time window, as ``drift_over_time`` does for a batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def late_labels(
    scored: DataFrame, labels: DataFrame, key: str = "click_id", label: str = "is_fraud",
    time: str = "timestamp", label_time: str = "label_time", wait: str = "1 hour", delay: str = "10 minutes",
) -> DataFrame:
    """Scored rows with the label that came at their time or at most ``wait`` after it.

    A row without one comes out with a null label and label time, once the watermark has passed
    the end of its wait; so every row that is not late comes out once for each of its labels, and
    the state holds the rows of the last ``wait`` and ``delay`` only. Rows of either stream that
    come more than ``delay`` behind the newest row of their stream may be dropped. Labels with a
    null key match nothing. Equal copies of a label (key, label, time) count once. Batches take the
    same join without watermarks.
    """
    late = labels.select(F.col(key).alias("_key"), F.col(label).alias("_late"), F.col(label_time).alias("_came"))
    left = scored.drop(label, label_time)
    if labels.isStreaming:
        left = left.withWatermark(time, delay)
        # a copy has its label's time, so it is either dropped here or late itself
        late = late.withWatermark("_came", delay).dropDuplicatesWithinWatermark()
    else:
        late = late.distinct()
    came = (F.col(key) == F.col("_key")) & (F.col("_came") >= F.col(time)) & (
        F.col("_came") <= F.col(time) + F.expr(f"interval {wait}"))
    return left.join(late, came, "left").drop("_key").withColumnsRenamed({"_late": label, "_came": label_time})


def live_drift(
    labelled: DataFrame, every: str = "10 minutes", time: str = "timestamp", label: str = "is_fraud",
    flag: str = "is_flagged",
) -> DataFrame:
    """Precision and recall of a flag per window of the rows' own time, among the labelled rows.

    On a stream a window comes out once, when the watermark has passed the end of the last wait
    that began in it. Rates without a base are 0.
    """
    known, fraud, hit = F.col(label).isNotNull(), F.col(label) == 1, F.col(flag) == 1
    sums = labelled.groupBy(F.window(time, every).alias("_w")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(known).alias("labelled"), F.count_if(fraud).alias("fraud"),
        F.count_if(hit & known).alias("_hits"), F.count_if(hit & fraud).alias("_tp"))
    return sums.select(
        F.col("_w.start").alias("bucket"), "n", "labelled", "fraud",
        _rate("_tp", "_hits").alias("precision"), _rate("_tp", "fraud").alias("recall"))


def _rate(part: str, base: str) -> Column:
    return F.coalesce(F.try_divide(part, base), F.lit(0.0))
