from __future__ import annotations

import random
import time

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickwarden import schemas
from clickwarden.operators import features, models
from clickwarden.operators.models import assemble
from clickwarden.sources import readers, writers
from clickwarden.streaming import scoring, state

SEEN = [n for n in schemas.CLICK_FEATURES if n.startswith(("ip_", "device_"))]


@pytest.fixture()
def clicks(make_clicks):
    rng = random.Random(11)
    seconds = sorted(rng.choices(range(0, 6000, 20), k=240))
    return make_clicks([
        (f"c{i:04d}", f"2024-01-01 {t // 3600:02d}:{t // 60 % 60:02d}:{t % 60:02d}",
         rng.choice("ab"), rng.choice(["d1", "d2"]), rng.choice("xy"))
        for i, t in enumerate(seconds)])


def pieces(df, count=4):
    """Time-ordered pieces of the clicks."""
    edges = [f"c{240 * i // count:04d}" for i in range(count + 1)]
    return [df.where((F.col("click_id") >= a) & (F.col("click_id") < (b if b < "c0240" else "d")))
            for a, b in zip(edges, edges[1:])]


def test_stream_equals_batch_over_restarts(spark, clicks, tmp_path):
    """Four runs from one checkpoint give the features of one batch, each row once."""
    source, sink, checkpoint = (str(tmp_path / n) for n in ("source", "sink", "checkpoint"))
    for piece in pieces(clicks):
        piece.orderBy(F.rand(1)).write.mode("append").parquet(source)
        stream = readers_stream(spark, source, clicks.schema)
        scoring.drain(scoring.to_files(
            state.enrich_stream(stream, clock="event"), sink, checkpoint, "parquet"))
    got = {r["click_id"]: r for r in spark.read.parquet(sink).collect()}
    want = features.click_features(clicks, device_scope="per_ip").collect()
    assert len(got) == len(want) == spark.read.parquet(sink).count()
    for row in want:
        for name in SEEN:
            assert got[row["click_id"]][name] == pytest.approx(row[name], abs=1e-9), name


def readers_stream(spark, path, schema):
    return scoring.read_file_stream(spark, path, schema, files_per_batch=100)


def test_history_features_equal_batch(spark, clicks, tmp_path):
    history = str(tmp_path / "history")
    got = {}
    for number, piece in enumerate(pieces(clicks)):
        for _ in range(2):  # a replayed micro-batch changes nothing
            rows = scoring.enrich_with_history(piece, number, history).collect()
        got.update({r["click_id"]: r for r in rows})
    for row in features.click_features(clicks).collect():
        for name in SEEN:
            assert got[row["click_id"]][name] == pytest.approx(row[name], abs=1e-9), name


def test_late_clicks_count_as_they_arrive():
    ip = state.IpState([], None)
    assert ip.click(100_000_000, "d", "1")["ip_clicks_1m"] == 1
    late = ip.click(70_000_000, "d", "1")
    assert late["ip_clicks_1m"] == 2 and late["ip_inter_click_gap_seconds"] == 0.0
    assert ip.click(161_000_000, "d", "1")["ip_clicks_1m"] == 1


def test_state_drops_clicks_beyond_the_widest_window():
    ip = state.IpState([], None)
    for minute in range(0, 300, 10):
        ip.click(minute * 60_000_000, "d", "1")
    assert len(ip.kept()) == 7


@pytest.mark.parametrize("late", [(0,), (0, 0, 0, 200, 3000)])
def test_stored_blocks_give_the_same_features(late):
    """State put away in blocks after every batch and read again. With late clicks a device may
    miss rows that have left the IP's widest window."""
    names = [n for n in SEEN if late == (0,) or n.startswith("ip_")]
    rng, now, whole, blocks, last = random.Random(4), 0, state.IpState([], None), {}, None
    for _ in range(200):
        batch = []
        for _ in range(rng.randrange(1, 30)):
            now += rng.randrange(0, 40) * 1_000_000
            batch.append((now - rng.choice(late) * 1_000_000, rng.choice("pq"), rng.choice("xyz")))
        read = state.IpState([c for b in sorted(blocks) for c in blocks[b]], last, min(blocks, default=0) * state.BLOCK)
        for click in batch:
            got, want = read.click(*click), whole.click(*click)
            assert [got[n] for n in names] == [want[n] for n in names]
        written, removed = read.changes()
        assert len(written) <= len(batch) // state.BLOCK + 2  # by the batch, not by the hour
        blocks.update(written)
        for block in removed:
            blocks.pop(block, None)
        last = read.last
        assert len(blocks) <= len(read.kept()) // state.BLOCK + 2
    assert min(blocks) > 10


class Chunks:
    """A list state in memory."""

    def __init__(self):
        self.rows, self.puts = [], 0

    def get(self):
        return iter(list(self.rows))

    def appendValue(self, row):
        self.rows.append(row)

    def put(self, rows):
        self.rows, self.puts = list(rows), self.puts + 1


@pytest.mark.parametrize("late", [(0,), (0, 0, 0, 200, 3000)])
def test_a_bucket_of_ips_gives_what_each_ip_gives_alone(late):
    """All IPs of a bucket at once against ``IpState`` over blocks, also when what has left the window is dropped."""
    columns = ["_packed", "_bucket", state.US, "_key", "_device", "_os", "_tie", "_nulls"]
    one = state.BucketClickProcessor(
        T.StructType([T.StructField(n, T.StringType()) for n in ("_packed", *SEEN)]), state.Packing(T.StructType([])), "event", columns)
    one.chunks = Chunks()
    rng, now, number, alone = random.Random(5), 0, 0, {}
    for _ in range(90):
        rows = []
        for _ in range(rng.choice([1, 5, 60])):
            now, number = now + rng.choice([0, 0, 1, 20_000_000, 200_000_000]), number + 1
            rows.append((str(number), 0, now - rng.choice(late) * 1_000_000, rng.choice("abc"), rng.choice("xyz"), rng.choice("pq"), number, 0))
        parts = pd.DataFrame(rng.sample(rows, len(rows)), columns=columns)
        got = pd.concat(one.handleInputRows((0,), iter([parts[:2], parts[2:]]), None)).set_index("_packed")
        for ip in "abc":
            blocks, last = alone.get(ip, ({}, None))
            ip_state = state.IpState([c for b in sorted(blocks) for c in blocks[b]], last, min(blocks, default=0) * state.BLOCK)
            for row in sorted((r for r in rows if r[3] == ip), key=lambda r: (r[2], r[6])):
                want = ip_state.click(row[2], row[4], row[5])
                assert got.loc[row[0], list(want)].to_dict() == want
            written, removed = ip_state.changes()
            alone[ip] = {b: c for b, c in (blocks | written).items() if b not in removed}, ip_state.last
    held = sum(len(pa.ipc.open_stream(row[0]).read_all()) for row in one.chunks.rows)
    assert 0 < one.chunks.puts < 20 and held < number / 2


def test_clicks_of_plain_columns_pass_python_by_the_bucket(spark, make_clicks, tmp_path):
    """Many IPs, one of them null, with null devices, on a clock read for every click, over two runs."""
    rng = random.Random(12)
    seconds = sorted(rng.choices(range(7000), k=700))
    rows = [(f"c{i:04d}", f"2024-01-01 {t // 3600:02d}:{t // 60 % 60:02d}:{t % 60:02d}",
             rng.choice([None, "hot", "hot", *[f"ip{k}" for k in range(90)]]), rng.choice([None, "d1", "d2"]), rng.choice("xy"))
            for i, t in enumerate(seconds)]
    clicks = make_clicks(rows)
    assert "_bucket" in state.enrich_stream(clicks, clock="event")._jdf.queryExecution().analyzed().toString()
    feed = stream_of(spark, tmp_path, clicks.schema, clock=lambda c: c[state.US], ttl_ms=None)
    feed(clicks.where("click_id < 'c0300'"))
    got, _ = feed(clicks.where("click_id >= 'c0300'"))
    want = {r["click_id"]: r for r in features.click_features(
        clicks.fillna("None", ["device_id"]), device_scope="per_ip").collect()}
    assert got.keys() == want.keys()
    for key, row in want.items():
        for name in SEEN:
            assert got[key][name] == pytest.approx(row[name], abs=1e-9), (key, name)


def stream_of(spark, tmp_path, schema, **options):
    """Feeds clicks to a stream that goes on from one checkpoint; gives its rows and progress."""
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def feed(rows):
        rows.coalesce(1).write.mode("append").parquet(source)
        query = scoring.to_files(state.enrich_stream(readers_stream(spark, source, schema), **options), sink, checkpoint, "parquet")
        scoring.drain(query)
        return {r["click_id"]: r for r in spark.read.parquet(sink).collect()}, query.recentProgress
    return feed


def test_idle_state_falls_away_behind_the_watermark(spark, make_clicks, tmp_path):
    at = "2024-01-01 {}".format
    first = make_clicks([(f"a{i}", at(f"08:{i:02d}:00"), f"ip{i % 7}", "d", "x") for i in range(30)])
    feed = stream_of(spark, tmp_path, first.schema, clock="event", delay="10 minutes", once=True, ttl_ms=3_600_000)
    rows, progress = feed(first.unionByName(first))
    assert len(rows) == 30 and spark.read.parquet(str(tmp_path / "out")).count() == 30  # a replay adds nothing
    assert progress[-1].stateOperators[0].numRowsTotal > 0
    rows, _ = feed(make_clicks([("b", at("08:31:00"), "ip1", "d", "x"), ("late", at("08:15:00"), "ip1", "d", "x"),
                                ("later", at("08:24:30"), "ip1", "d", "x")]))
    assert "late" not in rows and rows["later"]["ip_inter_click_gap_seconds"] == 0.0
    assert rows["b"]["ip_clicks_1h"] >= 6
    rows, progress = feed(make_clicks([("c", at("12:00:00"), "new", "d", "x")]))
    rows, progress = feed(make_clicks([("d", at("12:00:01"), "new", "d", "x"), ("e", at("12:00:02"), "ip1", "d", "x")]))
    assert rows["e"]["ip_inter_click_gap_seconds"] == 0.0 and rows["e"]["ip_clicks_1h"] == 1
    rows, progress = feed(make_clicks([("f", at("18:00:00"), "last", "d", "x")]))
    rows, progress = feed(make_clicks([("g", at("23:00:00"), "last", "d", "x")]))
    held = [p.stateOperators[0] for p in progress if p.stateOperators]
    # of all IPs only the one with the latest clicks is left: its trail, last click and timer
    assert {r["ip"] for r in rows.values()} > {"ip1", "new"} and held[-1].numRowsTotal <= 6


def test_clicks_of_a_known_ip_leave_its_timer_alone(spark, make_clicks, tmp_path):
    """The timer moves on when it is due, and the state falls away behind the newest click."""
    at = "2024-01-01 {}".format
    first = make_clicks([("a", at("08:00:00"), "ip", "d", "x")])
    feed = stream_of(spark, tmp_path, first.schema, clock="event", delay="1 minute", ttl_ms=3_600_000)
    total = lambda progress, name: sum(
        o.customMetrics[name] for p in progress for o in p.stateOperators if name in o.customMetrics)
    assert total(feed(first)[1], "numRegisteredTimers") == 1
    _, progress = feed(make_clicks([("b", at("08:30:00"), "ip", "d", "x")]))
    assert total(progress, "numRegisteredTimers") == total(progress, "numDeletedTimers") == 0
    feed(make_clicks([("c", at("09:05:00"), "other", "d", "x")]))  # due, but not idle for so long
    rows, _ = feed(make_clicks([("d", at("09:20:00"), "ip", "d", "x")]))
    assert rows["d"]["ip_inter_click_gap_seconds"] == 3000.0 and rows["d"]["ip_clicks_1h"] == 2
    feed(make_clicks([("e", at("11:00:00"), "other", "d", "x")]))
    rows, _ = feed(make_clicks([("f", at("11:00:10"), "ip", "d", "x")]))
    assert rows["f"]["ip_inter_click_gap_seconds"] == 0.0


def minutes():
    """A clock that reads the place of a click in its id: a minute a click, and once back again."""
    def clock(row: dict) -> int:
        number = int(row["click_id"][1:])
        return (number if number != 3 else 0) * 60_000_000
    return clock


def test_every_click_has_its_own_time(spark, make_clicks, tmp_path):
    rows = make_clicks([(f"m{i}", f"2024-01-01 08:00:{i:02d}", "one", "d", "x") for i in range(6)])
    got, _ = stream_of(spark, tmp_path, rows.schema, clock=minutes(), ttl_ms=None)(rows)
    gaps = [got[f"m{i}"]["ip_inter_click_gap_seconds"] for i in range(6)]
    assert gaps == [0, 60, 60, 0, 120, 60]  # one batch, no going back
    assert [got[f"m{i}"]["ip_clicks_1m"] for i in range(6)] == [1, 2, 2, 3, 1, 2]


def test_state_expires_after_its_last_write(spark, make_clicks, tmp_path):
    """Written again within the time it lives on; left alone it is gone."""
    def click(number):
        return make_clicks([(f"m{number}", f"2024-01-01 08:00:{number:02d}", "one", "d", "x")])

    source, seen = str(tmp_path / "source"), []
    click(0).limit(0).write.parquet(source)
    stream = state.enrich_stream(readers_stream(spark, source, click(0).schema), clock=minutes(), ttl_ms=12_000)
    query = stream.writeStream.format("memory").queryName("expiring").option(
        "checkpointLocation", str(tmp_path / "cp")).outputMode("append").start()
    rows = spark.table("expiring")
    try:
        for number, wait in ((1, 7), (2, 7), (4, 14), (5, 0)):
            click(number).write.mode("append").parquet(source)
            deadline = time.monotonic() + 40
            while rows.where(F.col("click_id") == f"m{number}").isEmpty() and time.monotonic() < deadline:
                time.sleep(0.2)
            row = rows.where(F.col("click_id") == f"m{number}").first()
            seen.append((row["ip_inter_click_gap_seconds"], row["ip_clicks_1h"]))
            time.sleep(wait)
    finally:
        query.stop()
    # the third click comes when the first write alone would have expired
    assert seen == [(0, 1), (60, 2), (120, 3), (0, 1)]


def test_a_watermark_needs_the_event_clock(make_clicks):
    with pytest.raises(ValueError):
        state.enrich_stream(make_clicks(), clock="processing", delay="1 hour")
    with pytest.raises(ValueError):
        state.enrich_stream(make_clicks(), clock="event", once=True)


def test_processing_clock_with_ttl(spark, clicks, tmp_path):
    """Smoke test: this clock keeps running empty batches, so it is polled and stopped."""
    source = str(tmp_path / "source")
    clicks.write.parquet(source)
    stream = readers_stream(spark, source, clicks.schema)
    query = state.enrich_stream(stream, clock="processing", ttl_ms=60_000).writeStream.format(
        "memory").queryName("processing_clock").option(
        "checkpointLocation", str(tmp_path / "cp")).outputMode("append").start()
    rows, deadline = spark.table("processing_clock"), time.monotonic() + 60
    try:
        while rows.count() < 240 and time.monotonic() < deadline:
            time.sleep(0.5)
    finally:
        query.stop()
    assert rows.count() == 240
    # All clicks are read within a minute: those of an IP fall together.
    most = {r["ip"]: r["n"] for r in rows.groupBy("ip").agg(F.max("ip_clicks_1h").alias("n")).collect()}
    total = {r["ip"]: r["count"] for r in clicks.groupBy("ip").count().collect()}
    assert most == total


def test_scoring_stream_with_alerts(spark, clicks, tmp_path):
    names = ["ip_clicks_1m", "ip_clicks_5m"]
    train = features.click_features(clicks, device_scope="per_ip").withColumn(
        "y", (F.col("ip_clicks_5m") > 4).cast("int"))
    model = models.train_lr(assemble(train, names, "y"), 20)
    source, checkpoint = str(tmp_path / "source"), str(tmp_path / "cp")
    table, alerts = str(tmp_path / "table"), str(tmp_path / "alerts")
    for piece in pieces(clicks.withColumn("event_timestamp", F.current_timestamp()), 2):
        piece.write.mode("append").parquet(source)
        stream = readers_stream(spark, source, piece.schema)
        scoring.drain(scoring.score_stream(
            state.enrich_stream(stream, clock="event"), model, checkpoint,
            scoring.table_sink(table, ["click_id"], scoring.file_alerts(alerts)),
            threshold=0.5, names=names, trigger={"availableNow": True}))
    scored = readers.read_scored(spark, table)
    assert scored.count() == 240
    assert scored.where("latency_ms < 0").count() == 0
    flags = {r["click_id"] for r in scored.where("is_flagged = 1").collect()}
    sent = {r["click_id"] for r in readers.read_staging(spark, alerts).collect()}
    assert flags == sent and flags
    assert [r["rows"] for r in writers.commit_history(spark, table).collect()] == [120, 120]


def test_json_sink_is_overwritten_on_replay(spark, tmp_path):
    sink = scoring.json_sink(str(tmp_path / "out"), scoring.file_alerts(str(tmp_path / "alerts")))
    rows = spark.createDataFrame([("a", 1), ("b", 0)], "click_id string, is_flagged int")
    sink(rows, 3)
    sink(rows, 3)
    assert readers.read_staging(spark, str(tmp_path / "out")).count() == 2
    assert readers.read_staging(spark, str(tmp_path / "alerts")).count() == 1


def test_transaction_stream(spark, tmp_path):
    lines = ['{"step":1,"type":"TRANSFER","amount":5.0,"nameOrig":"a","oldbalanceOrg":1.0,'
             '"nameDest":"m","isFraud":0}',
             '{"step":1,"type":"PAYMENT","amount":5.0,"nameDest":"m"}', "broken {"]
    df = spark.createDataFrame([(t,) for t in lines], "value string")
    rows, bad = scoring.transaction_stream(df)
    assert [r["nameDest"] for r in rows.collect()] == ["m"]
    assert [r["value"] for r in bad.collect()] == ["PARSE ERROR: broken {"]


def test_count_so_far_stream(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("source", "sink", "checkpoint"))
    df = spark.createDataFrame([(i, "mn"[i % 2]) for i in range(20)], "i long, dest string")
    for part in (df.where("i < 9"), df.where("i >= 9")):
        part.write.mode("append").parquet(source)
        stream = readers_stream(spark, source, df.schema)
        scoring.drain(scoring.to_files(
            state.count_so_far_stream(stream, "dest", ["i"], "n"), sink, checkpoint, "parquet"))
    assert {r["i"]: r["n"] for r in spark.read.parquet(sink).collect()} == {
        i: i // 2 for i in range(20)}


def test_counts_of_plain_rows_pass_python_by_the_bucket(spark, tmp_path):
    """Keys share buckets, ties are broken by all order columns, nulls come first, and wide numbers stay exact."""
    source, sink, checkpoint = (str(tmp_path / n) for n in ("source", "sink", "checkpoint"))
    wide = (1 << 53) + 1
    rows = [(None if i % 11 == 0 else wide + i % 4, f"t{i % 3}" if i % 5 else None, float(i % 2), None if i % 7 == 0 else f"k{i % 300}", i)
            for i in range(1200)]
    df = spark.createDataFrame(rows, "at long, text string, `a real` double, dest string, i long")
    order = ["at", "text", "a real", "i"]
    seen, want = {}, {}
    for part in (rows[:500], rows[500:]):
        # nulls before all others
        for r in sorted(part, key=lambda r: [(v is not None, v if v is not None else 0) for v in (r[0], r[1], r[2], r[4])]):
            want[r[4]] = seen[r[3]] = seen.get(r[3], -1) + 1
        spark.createDataFrame(part, df.schema).write.mode("append").parquet(source)
        counted = state.count_so_far_stream(readers_stream(spark, source, df.schema), "dest", order, "n")
        scoring.drain(scoring.to_files(counted, sink, checkpoint, "parquet"))
    out = spark.read.parquet(sink)
    assert {r["i"]: r["n"] for r in out.select("i", "n").collect()} == want
    assert sorted(map(repr, out.drop("n").collect())) == sorted(map(repr, df.collect()))


def test_history_comes_before_clicks_of_its_time(spark, make_clicks, tmp_path):
    first = make_clicks([("z", "2024-01-01 00:00:10", "a", "d", "x")])
    then = make_clicks([("b", "2024-01-01 00:00:10", "a", "d", "x"), ("c", "2024-01-01 00:00:10", "a", "d", "x")])
    history = str(tmp_path / "history")
    seen = [scoring.enrich_with_history(part, number, history).select("click_id", "ip_clicks_1m", "device_clicks_1m").collect()
            for number, part in enumerate((first, then))]
    assert sorted(map(tuple, seen[0] + seen[1])) == [("b", 2, 2), ("c", 3, 3), ("z", 1, 1)]


def test_drain_waits_for_a_long_stream():
    class Long:
        """Ends only when nobody limits the wait, as a stream that takes ten minutes does."""
        stopped = False

        def awaitTermination(self, timeout=None):
            return timeout is None

        def stop(self):
            self.stopped = True

    scoring.drain(Long())
    limited = Long()
    with pytest.raises(TimeoutError):
        scoring.drain(limited, 1)
    assert limited.stopped


def test_packed_columns_come_back_as_they_were(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("source", "sink", "checkpoint"))
    df = spark.sql("""SELECT * FROM VALUES
      (1, 'm', 9007199254740993, double('NaN'), 'a "quoted" \\n text', timestamp'9999-12-31 23:59:59.999999', array(1), 1.50BD),
      (2, 'm', null, double('-Infinity'), '', null, null, null), (3, null, -1, 0.1, null, timestamp'0001-01-01 00:00:00', array(), 2.25BD),
      (4, null, 5, null, 'ü', timestamp'2024-01-01 00:00:00.000001', array(null), 0.00BD)
      AS t(i, dest, wide, `a real`, text, at, list, money)""")
    df.write.parquet(source)
    counted = state.count_so_far_stream(readers_stream(spark, source, df.schema), "dest", ["i"], "n")
    packing = state.Packing(df.schema, ["dest"])
    assert [f.name for f in packing.fields] == ["dest", "list", "money", state.Packing.NAME]  # six columns in one
    scoring.drain(scoring.to_files(counted, sink, checkpoint, "parquet"))
    out = spark.read.parquet(sink)
    assert out.dtypes == [*df.dtypes, ("n", "bigint")]
    text = lambda d: sorted(map(repr, d.withColumn("at", F.unix_micros("at")).collect()))
    assert text(out.drop("n")) == text(df)
    assert {r["i"]: r["n"] for r in out.select("i", "n").collect()} == {1: 0, 2: 1, 3: 0, 4: 1}


def test_monitor_reports_totals(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"ip":"1"}\nnot json\n')
    stream = readers.read_click_stream(spark, "text", path=str(tmp_path / "in"))
    query = scoring.to_files(scoring.monitored(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    scoring.drain(query)
    seen = [p.observedMetrics["contract"] for p in query.recentProgress
            if "contract" in p.observedMetrics]
    assert (seen[0]["invalid"], seen[0]["malformed_json"], seen[0]["valid"]) == (1, 1, 0)


def test_bounded_contract_check(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"ip":"1"}\nnot json\n{}\n')
    stream = readers.read_click_stream(spark, "text", path=str(tmp_path / "in"))
    row = scoring.check_contract_stream(stream, str(tmp_path / "cp"), 2, 60.0).first()
    assert (row["total"], row["valid"]) == (2, 0) and row["messages_per_second"] > 0
    row = scoring.check_contract_stream(stream, str(tmp_path / "cp2"), 100, 4.0).first()
    assert (row["invalid"], row["malformed_json"]) == (2, 1)


def test_bounded_contract_read_raises_what_the_stream_raised(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.createDataFrame([("{}",)], "value string").write.text(source)
    stream = readers.read_click_stream(spark, "text", path=source)
    started = time.monotonic()
    with pytest.raises(Exception, match="no_such_column"):
        scoring.check_contract_stream(stream, str(tmp_path / "cp"), 2, 60.0, value="no_such_column")
    assert time.monotonic() - started < 50
