"""Streaming jobs: scoring with alerts, contract monitoring and table-backed features."""

from __future__ import annotations

import threading
import time
import uuid
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from clickwarden import schemas
from clickwarden.functions import click_to_install_seconds, latency_ms
from clickwarden.operators.contract import check_contract_batch, read_record, validate_clicks
from clickwarden.operators.eda import flagged
from clickwarden.operators.features import attach_rates, click_features
from clickwarden.operators.models import score
from clickwarden.operators.transactions import filter_types, transaction_columns
from clickwarden.runtime import short_shuffles, spill, stages
from clickwarden.sources.writers import click_messages, upsert_insert_only
from clickwarden.streaming.state import count_so_far_stream

HISTORY_SECONDS = schemas.STATE_TTL_MS // 1000
EVERY = "10 seconds"


def score_batch(
    batch: DataFrame, model, threshold: float, names: list[str] = tuple(schemas.CLICK_FEATURES)
) -> DataFrame:
    """Probability, flag and scoring time for enriched rows, and the latency of rows that
    carry the time of their event."""
    from clickwarden.operators.models import assemble

    vectors = assemble(batch.withColumn("_none", F.lit(0)), list(names), "_none")
    scored = score(model, vectors, threshold).drop("features", "label", "_none")
    scored = scored.withColumn("scored_at", F.current_timestamp())
    if "event_timestamp" not in batch.columns:
        return scored
    return scored.withColumn(
        "latency_ms", latency_ms(F.col("event_timestamp").cast("timestamp"), F.col("scored_at")))


def add_static_features(
    df: DataFrame, campaign: DataFrame | None, publisher: DataFrame | None
) -> DataFrame:
    """Install delta and conversion rates, which need no state."""
    df = df.withColumn("click_to_install_delta_seconds", click_to_install_seconds(
        F.col("click_to_install_delta"), F.col("timestamp"), F.col("attributed_time")))
    df = attach_rates(df, campaign, "campaign_id", "campaign_conversion_rate")
    return attach_rates(df, publisher, "publisher_id", "publisher_conversion_rate")


def table_sink(
    path: str, keys: list[str], alerts: Callable[[DataFrame, int], None] | None = None,
    partition_by: list[str] = (),
) -> Callable[[DataFrame, int], None]:
    """Sink for scored micro-batches: idempotent table plus flagged rows as alerts.

    A replayed micro-batch adds no rows to the table; alerts are sent at least once. Name
    a column that follows from the key, such as the event's date, in ``partition_by``, so
    that a batch looks at its own partitions only.
    """
    def write(scored: DataFrame, batch_id: int) -> None:
        with stages(scored.sparkSession):
            scored = spill(scored, "scored")  # score once for both outputs
            upsert_insert_only(scored, path, keys, partition_by, prune=bool(partition_by))
            if alerts is not None:
                alerts(flagged(scored), batch_id)
    return write


def json_sink(path: str, alerts: Callable[[DataFrame, int], None] | None = None):
    """Sink of JSON files, one folder per micro-batch, overwritten when it is replayed."""
    def write(scored: DataFrame, batch_id: int) -> None:
        with stages(scored.sparkSession):
            scored = spill(scored, "scored")
            scored.write.mode("overwrite").json(f"{path}/batch={batch_id}")
            if alerts is not None:
                alerts(flagged(scored), batch_id)
    return write


def message_alerts(fmt: str = "kafka", key: str = "ip", **options):
    """Alert writer for a message topic."""
    def send(rows: DataFrame, batch_id: int) -> None:
        click_messages(rows, key).write.format(fmt).options(**options).mode("append").save()
    return send


def file_alerts(path: str, compression: str = "none"):
    """Alert writer for JSON files, one folder per micro-batch."""
    def send(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").option("compression", compression).json(f"{path}/batch={batch_id}")
    return send


def score_stream(
    enriched: DataFrame, model, checkpoint: str, sink: Callable[[DataFrame, int], None],
    threshold: float = schemas.CLICK_FLAG_THRESHOLD, campaign: DataFrame | None = None,
    publisher: DataFrame | None = None, names: list[str] = tuple(schemas.CLICK_FEATURES),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start scoring an enriched stream. Progress is stored every ten seconds unless
    ``trigger`` says otherwise."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        if "click_to_install_delta_seconds" in names:
            batch = add_static_features(batch, campaign, publisher)
        sink(score_batch(batch, model, threshold, names), batch_id)

    with short_shuffles(enriched.sparkSession):
        return enriched.writeStream.foreachBatch(handle).option(
            "checkpointLocation", checkpoint
        ).trigger(**(trigger or {"processingTime": EVERY})).start()


def enrich_with_history(
    batch: DataFrame, batch_id: int, history: str, device_scope: str = "global",
    campaign: DataFrame | None = None, publisher: DataFrame | None = None,
    keep_seconds: int = HISTORY_SECONDS,
) -> DataFrame:
    """Features of one micro-batch from a stored history of recent clicks.

    For use in ``foreachBatch`` when single IPs or devices are too heavy for keyed state:
    the batch operators split hot keys, and devices can be counted over all IPs. Of clicks of
    one time those of earlier micro-batches come first, whatever their ids. The
    history holds only the feature columns, in folders by hour, so that old hours are not
    read. A replayed micro-batch overwrites its own folder.
    """
    spark = batch.sparkSession
    batch = spill(batch, "micro-batch")
    columns = ["click_id", "ip", "device_id", "os", "timestamp"]
    start = batch.agg(F.min("timestamp").alias("t")).first()["t"]
    if start is None:
        return click_features(batch, campaign, publisher, device_scope)
    mine = f"{history.rstrip('/')}/batch={batch_id}"
    fresh = batch.select(*columns, F.date_format("timestamp", "yyyyMMddHH").cast("bigint").alias("hour"))
    fresh.write.mode("overwrite").partitionBy("hour").parquet(mine)
    since = batch.agg(
        (F.min("timestamp") - F.expr(f"interval {keep_seconds} seconds")).alias("t"))
    since = since.select("t", F.date_format("t", "yyyyMMddHH").cast("bigint").alias("h")).first()
    older = spark.read.option("basePath", history).parquet(history).where(
        (F.col("batch") < batch_id) & (F.col("hour") >= since["h"])
        & (F.col("timestamp") >= F.lit(since["t"])))
    both = batch.withColumn("_fresh", F.lit(1)).unionByName(
        older.select(*columns).withColumn("_fresh", F.lit(0)), allowMissingColumns=True)
    both = both.withColumn("_order", F.struct("_fresh", "click_id"))
    out = click_features(both, campaign, publisher, device_scope, tie="_order")
    return out.where(F.col("_fresh") == 1).drop("_fresh", "_order")


def transaction_stream(messages: DataFrame, schema=schemas.TRANSACTION, value: str = "value"
                       ) -> tuple[DataFrame, DataFrame]:
    """Scorable transactions of a JSON stream, and the texts that do not parse."""
    parsed = messages.select(F.from_json(value, schema).alias("_t"), F.col(value).alias("_raw"),
                             read_record(value).isNull().alias("_bad"))
    bad = parsed.where(F.col("_bad")).select(
        F.concat(F.lit("PARSE ERROR: "), F.coalesce("_raw", F.lit(""))).alias("value"))
    return filter_types(parsed.select("_t.*")), bad


def enrich_transactions(rows: DataFrame, order: list[str] = ("step", "nameOrig")) -> DataFrame:
    """Streaming scorable transactions with join key, ratio and the count of earlier
    transactions to their destination: what ``transaction_features`` gives a batch."""
    scorable = filter_types(rows)
    ready = transaction_columns(scorable)
    if not set(order) <= set(rows.columns):
        return count_so_far_stream(ready, "nameDest", list(order))
    # what follows from a row need not travel with it
    counted = count_so_far_stream(scorable, "nameDest", list(order))
    return transaction_columns(counted).select(*[f"`{c}`" for c in ready.columns], counted.columns[-1])


def monitored(messages: DataFrame, name: str = "contract", value: str = "value") -> DataFrame:
    """Contract check on a stream; the totals of each micro-batch are observed metrics."""
    checked = validate_clicks(messages, value)
    ok = ~F.col("is_malformed") & (F.size("errors") == 0)
    wrong = ~F.col("is_malformed") & (F.size("errors") > 0)
    return checked.observe(
        name, F.count_if(ok).alias("valid"), F.count_if(wrong).alias("invalid"),
        F.count_if(F.col("is_malformed")).alias("malformed_json"))


class _Ended(StreamingQueryListener):
    """Sets an event when the query of one run has ended, by itself or by a failure."""

    def __init__(self, over: threading.Event):
        self.over, self.run = over, None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if self.run is not None and str(event.runId) == self.run:
            self.over.set()


def check_contract_stream(
    messages: DataFrame, checkpoint: str, max_rows: int = 100, seconds: float = 20.0,
    value: str = "value",
) -> DataFrame:
    """Contract totals of a stream until ``max_rows`` messages or ``seconds`` have passed.

    The micro-batch that fills the number wakes the driver, which sleeps until then.
    """
    totals, started, over = Counter(), time.monotonic(), threading.Event()
    manager, listener = messages.sparkSession.streams, _Ended(over)

    def handle(batch: DataFrame, batch_id: int) -> None:
        room = max_rows - totals["total"]
        if room > 0:
            totals.update(check_contract_batch(batch, room, value).first().asDict())
        if totals["total"] >= max_rows:
            over.set()

    manager.addListener(listener)
    query = messages.writeStream.foreachBatch(handle).option(
        "checkpointLocation", checkpoint).start()
    listener.run = str(query.runId)
    try:
        if query.isActive:
            over.wait(max(0.0, seconds - (time.monotonic() - started)))
        if query.exception() is not None:
            raise query.exception()
    finally:
        query.stop()
        manager.removeListener(listener)
    spent = max(time.monotonic() - started, 1e-9)
    names = ["valid", "invalid", "malformed_json", "total"]
    row = (*[totals[n] for n in names], round(totals["total"] / spent, 2))
    return messages.sparkSession.createDataFrame(
        [row], ", ".join(f"{n} long" for n in names) + ", messages_per_second double")


class RunningTotals(StreamingQueryListener):
    """Adds up the observed metrics ``name`` over the micro-batches of all runs of the session.

    ``totals`` holds the sums and ``batches`` their number. A micro-batch that is told again, as after
    a restart, replaces its own figures, so each counts once. Add it with ``spark.streams.addListener``.
    """

    def __init__(self, name: str = "contract", enough: int | None = None):
        self.name, self.enough, self.batches = name, enough, 0
        self.totals: Counter = Counter()
        self.full, self.ended = threading.Event(), threading.Event()
        self._last: dict[str, tuple[int, dict]] = {}  # of each query only its newest batch

    def add(self, query: str, batch: int, figures: dict) -> None:
        number, before = self._last.get(query, (-1, {}))
        if batch < number:
            return
        if batch == number:
            self.totals.subtract(before)
        else:
            self.batches += 1
        self.totals.update(figures)
        self._last[query] = batch, figures
        if self.enough is not None and sum(self.totals.values()) >= self.enough:
            self.full.set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None and event.progress.numInputRows > 0:
            self.add(str(event.progress.id), event.progress.batchId, {k: int(v or 0) for k, v in row.asDict().items()})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()
        self.full.set()


def monitor_totals(
    messages: DataFrame, path: str, checkpoint: str, max_rows: int | None = None, seconds: float = 300.0,
    value: str = "value", trigger: dict | None = None,
) -> DataFrame:
    """Store the checked messages and return the totals over all micro-batches of this run.

    It ends when the stream does, after the micro-batch with which ``max_rows`` messages are reached, or
    after ``seconds``. The driver sleeps until one of them; whole micro-batches are counted.
    """
    spark, name = messages.sparkSession, f"contract-{uuid.uuid4().hex}"
    totals = RunningTotals(name, max_rows)
    spark.streams.addListener(totals)
    try:
        query = monitored(messages, name, value).writeStream.format("parquet").option("path", path).option(
            "checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
        try:
            if query.isActive:
                totals.full.wait(seconds)
            if query.exception() is not None:
                raise query.exception()
        finally:
            query.stop()
        totals.ended.wait(60)  # the events of a query come in order, its end last
    finally:
        spark.streams.removeListener(totals)
    names = ["valid", "invalid", "malformed_json"]
    row = (*[totals.totals[n] for n in names], sum(totals.totals[n] for n in names), totals.batches)
    return spark.createDataFrame([row], ", ".join(f"{n} long" for n in [*names, "total", "batches"]))


def drain(query: StreamingQuery, seconds: int | None = None) -> None:
    """Wait for a bounded stream to end, however long its source is; its own failure is raised.

    With ``seconds`` it is stopped and fails when it does not end in time.
    """
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"stream did not end within {seconds} s")


def to_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "json") -> StreamingQuery:
    """Write a bounded stream to files and stop when the source is exhausted."""
    return df.writeStream.format(fmt).option("path", path).option(
        "checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def read_file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                     files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option(
        "maxFilesPerTrigger", files_per_batch).format(fmt).load(path)
