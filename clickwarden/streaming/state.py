"""Keyed state for streams: click features per IP and counts per key."""

from __future__ import annotations

import json
import time as wall
from collections import Counter
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from math import log2

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickwarden import schemas

MICROS = 1_000_000
US = "_us"
BLOCK = 64  # clicks per entry of the stored trail
BUCKETS = 4096  # of keys counted together; a checkpoint depends on it
CLICK_BUCKETS = 1024  # of IPs whose clicks are kept together; a checkpoint depends on it
LOOK_CHUNKS, MOST_CHUNKS = 8, 32  # of one bucket's kept clicks, before old ones are looked for and all become one
STATE_FEATURES = [name for name in schemas.CLICK_FEATURES if name.startswith(("ip_", "device_"))]


@lru_cache(maxsize=65536)
def _weight(count: int) -> int:
    """``count * log2(count)`` in the whole-number scale of the batch operators."""
    return round(count * log2(count) * 1e8) if count > 1 else 0


class Trail:
    """Times of one key's clicks in arrival order, with one head per window.

    A head only moves forward, past times older than the window. Late clicks therefore
    join the window as they arrive and are not sorted in.
    """

    def __init__(self, widths: list[int]):
        self.times: list[int] = []
        self.heads = dict.fromkeys(widths, 0)

    def add(self, now: int) -> dict[int, int]:
        self.times.append(now)
        sizes = {}
        for width, head in self.heads.items():
            while self.times[head] < now - width * MICROS:
                head += 1
            self.heads[width] = head
            sizes[width] = len(self.times) - head
        return sizes


class IpState:
    """Features of one IP's clicks, rebuilt from the stored recent clicks.

    ``first`` is the place of the first recent click in the stored trail, at a block's start.
    """

    def __init__(self, recent: list[tuple[int, str, str]], last: int | None, first: int = 0):
        self.widths = list(schemas.WINDOW_SECONDS.values())
        self.recent: list[tuple[int, str, str]] = []
        self.ip = Trail(self.widths)
        self.devices: dict[str, Trail] = {}
        self.prints: Counter = Counter()
        self.weight = 0
        self.oldest_print = 0
        self.last, self.first = last, first
        for click in recent:
            self._take(*click)
        self.stored = len(self.recent)

    def _take(self, now: int, device: str, os: str) -> tuple[dict, dict]:
        self.recent.append((now, device, os))
        trail = self.devices.setdefault(device, Trail(self.widths))
        sizes = self.ip.add(now), trail.add(now)
        self._count((device, os), 1)
        edge = now - schemas.ENTROPY_SECONDS * MICROS
        while self.recent[self.oldest_print][0] < edge:
            self._count(self.recent[self.oldest_print][1:], -1)
            self.oldest_print += 1
        return sizes

    def _count(self, fingerprint: tuple[str, str], change: int) -> None:
        before = self.prints[fingerprint]
        self.prints[fingerprint] = before + change
        self.weight += _weight(before + change) - _weight(before)
        if before + change == 0:
            del self.prints[fingerprint]

    def click(self, now: int, device: str, os: str) -> dict[str, float]:
        gap = 0.0 if self.last is None else max(0.0, (now - self.last) / MICROS)
        self.last = now
        ip_sizes, device_sizes = self._take(now, device, os)
        total = len(self.recent) - self.oldest_print
        out = {"ip_inter_click_gap_seconds": gap,
               "ip_fingerprint_entropy_5m": max(
                   0.0, (_weight(total) - self.weight) / (total * 1e8))}
        for name, width in schemas.WINDOW_SECONDS.items():
            out[f"ip_clicks_{name}"] = ip_sizes[width]
            out[f"device_clicks_{name}"] = device_sizes[width]
        return out

    def kept(self) -> list[tuple[int, str, str]]:
        """Clicks that a later click can still see."""
        return self.recent[self.ip.heads[max(self.widths)]:]

    def changes(self) -> tuple[dict[int, list[tuple[int, str, str]]], list[int]]:
        """Blocks of ``BLOCK`` places to write, and blocks to remove, since the state was read.

        Written are the blocks that new clicks fall into; removed those that lie wholly before
        the widest window. All others stay as they are.
        """
        head = self.first + self.ip.heads[max(self.widths)]
        written = {}
        for block in range((self.first + self.stored) // BLOCK, -(-(self.first + len(self.recent)) // BLOCK)):
            if (block + 1) * BLOCK > head:
                written[block] = self.recent[max(0, block * BLOCK - self.first):(block + 1) * BLOCK - self.first]
        stored = range(self.first // BLOCK, -(-(self.first + self.stored) // BLOCK))
        return written, [block for block in stored if (block + 1) * BLOCK <= head]


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.BooleanType)
_REAL = (T.FloatType, T.DoubleType)
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


class Packing:
    """Carries the plain columns of a row through Python as one JSON text.

    Python reads a row column by column, so many columns cost more than the work on them. Text,
    whole numbers, floats, flags and times (as microseconds) are packed; columns of other types and
    those in ``keep`` travel beside the text. ``restore`` gives back the columns as they were.
    """

    NAME = "_packed"

    def __init__(self, schema: T.StructType, keep: list[str] = ()):
        self.names = schema.fieldNames()
        self.packed = [f for f in schema.fields if f.name not in keep and isinstance(
            f.dataType, (*_WHOLE, *_REAL, T.TimestampType))]
        inside = {f.name for f in self.packed}
        self.beside = [f for f in schema.fields if f.name not in inside]
        self.fields = [*self.beside, T.StructField(self.NAME, T.StringType())]
        self.reals = [(f"c{i}", f.name) for i, f in enumerate(self.packed) if isinstance(f.dataType, _REAL)]
        self.times = [(f"c{i}", f.name) for i, f in enumerate(self.packed) if isinstance(f.dataType, T.TimestampType)]

    def pack(self, df: DataFrame, *extra: str) -> DataFrame:
        values = [(F.unix_micros(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)).alias(f"c{i}")
                  for i, f in enumerate(self.packed)]
        text = F.to_json(F.struct(*values)) if values else F.lit("{}")
        return df.select(*[f.name for f in self.beside], text.alias(self.NAME), *extra)

    def read(self, row: Row) -> dict:
        """The row as a dict with the values of its columns."""
        return self.opened(row.asDict())

    def opened(self, out: dict) -> dict:
        """The same for a row that is a dict."""
        found = json.loads(out[self.NAME])
        for i, field in enumerate(self.packed):
            out[field.name] = found.get(f"c{i}")
        for short, name in self.reals:  # NaN and the infinities are texts
            if short in found:
                out[name] = float(found[short])
        for short, name in self.times:
            if short in found:
                out[name] = _EPOCH + timedelta(microseconds=found[short])
        return out

    def restore(self, df: DataFrame, added: list[str]) -> DataFrame:
        if not self.packed:
            return df.select(*self.names, *added)
        kinds = T.StructType([
            T.StructField(f"c{i}", T.LongType() if isinstance(f.dataType, T.TimestampType) else f.dataType)
            for i, f in enumerate(self.packed)])
        # a generator, so that the text is parsed once for all columns
        opened = df.select("*", F.inline(F.array(F.from_json(self.NAME, kinds))))
        back = {f.name: (F.timestamp_micros(f"c{i}") if isinstance(f.dataType, T.TimestampType) else F.col(f"c{i}")).alias(f.name)
                for i, f in enumerate(self.packed)}
        return opened.select(*[back.get(name, name) for name in self.names], *added)


def _ordered(rows, packing: Packing, order: list[str]) -> list[dict]:
    return sorted(map(packing.read, rows), key=lambda r: tuple(r[c] for c in order))


_TRAIL = T.StructType([
    T.StructField("us", T.ArrayType(T.LongType())), T.StructField("device", T.ArrayType(T.StringType())),
    T.StructField("os", T.ArrayType(T.StringType())),
])


class ClickFeatureProcessor(StatefulProcessor):
    """Adds the IP and per-IP device features to every click of one IP.

    ``clock="event"`` takes the click time, so that a replay gives the same values.
    ``clock="processing"`` reads the wall clock for every click, as a live scorer does; it never
    runs backwards within an IP. A function from the click (a dict) to microseconds is a clock
    of one's own.

    The trail of recent clicks lies in a map of blocks in arrival order: a micro-batch writes
    the blocks its clicks fall into and removes those that have left the widest window. With
    ``idle_us`` an event-time timer drops the whole state of an IP that has had no click for so
    long when the watermark passes. An IP has one timer, set by its first click: clicks that come
    since are noted beside the last one and only looked at when the timer is due, which then moves on.
    """

    def __init__(self, out: T.StructType, packing: Packing, clock: str | Callable[[dict], int], tie: str,
                 ttl_ms: int | None, idle_us: int | None = None):
        self.packing = packing
        self.fields, self.clock, self.tie, self.ttl_ms, self.idle_us = out.fieldNames(), clock, tie, ttl_ms, idle_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        place = T.StructType([T.StructField("block", T.LongType())])
        last = T.StructType([T.StructField(n, T.LongType()) for n in ("us", "newest", "timer")])
        self.trail = handle.getMapState("trail", place, _TRAIL, self.ttl_ms)
        self.last = handle.getValueState("last", last, self.ttl_ms)

    def _read(self, last: int | None) -> IpState:
        # the oldest blocks may have expired already
        blocks = sorted((key[0], value) for key, value in self.trail.iterator())
        recent = [click for _, block in blocks for click in zip(*block)]
        return IpState(recent, last, blocks[0][0] * BLOCK if blocks else 0)

    def _due(self, newest: int) -> int:
        return (newest + self.idle_us) // 1000 + 1

    def _now(self, row: dict, last: int | None) -> int:
        if self.clock == "event":
            return row[US]
        now = wall.time_ns() // 1000 if self.clock == "processing" else self.clock(row)
        return now if last is None else max(now, last)

    def handleInputRows(self, key, rows, timerValues):
        last, newest, timer = self.last.get() or (None, None, None)
        state = self._read(last)
        # Micro-batches do not promise an order inside one key.
        for row in _ordered(rows, self.packing, [US, self.tie]):
            newest = row[US] if newest is None else max(newest, row[US])
            row.update(state.click(self._now(row, state.last), str(row["device_id"]), str(row["os"])))
            yield Row(**{name: row[name] for name in self.fields})
        written, removed = state.changes()
        for block, clicks in written.items():
            self.trail.updateValue((block,), tuple(list(column) for column in zip(*clicks)))
        for block in removed:
            self.trail.removeKey((block,))
        if self.idle_us is not None and timer is None and newest is not None:
            timer = self._due(newest)
            self.handle.registerTimer(timer)
        self.last.update((state.last, newest, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        last, newest, _ = self.last.get()
        due = self._due(newest)
        if due > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(due)
            self.last.update((last, newest, due))
            return
        self.trail.clear()
        self.last.clear()
        yield from ()

    def close(self) -> None:
        pass


def _starts(codes: np.ndarray) -> np.ndarray:
    """True at the first row of each run of one code."""
    return np.r_[True, codes[1:] != codes[:-1]] if len(codes) else np.zeros(0, bool)


def _paced(codes: np.ndarray, times: np.ndarray, widest: int) -> np.ndarray:
    """Times of runs of one code, ascending in each, on one axis: steps longer than the ``widest`` window are
    cut to just beyond it, and runs lie as far apart. So no window over the axis reaches another run, and
    nothing overflows."""
    steps = np.clip(np.diff(times, prepend=times[:1]), 0, widest + 1)
    return np.cumsum(np.where(_starts(codes), widest + 1, steps))


def _window_counts(codes: np.ndarray, times: np.ndarray) -> dict[str, np.ndarray]:
    """Rows of the code in each window that ends with the row; in runs as ``_paced`` takes them."""
    axis = _paced(codes, times, max(schemas.WINDOW_SECONDS.values()) * MICROS)
    at = np.arange(1, len(axis) + 1)
    return {name: at - np.searchsorted(axis, axis - width * MICROS, "left")
            for name, width in schemas.WINDOW_SECONDS.items()}


def _entropies(codes: np.ndarray, times: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Entropy of the fingerprints in the window of each click.

    As ``IpState`` adds it up: a click arrives, then those that have left the window depart, and each changes
    the sum of the weights by whole numbers.
    """
    n, at = len(codes), np.arange(len(codes))
    width = schemas.ENTROPY_SECONDS * MICROS
    axis = _paced(codes, times, width)
    head = np.searchsorted(axis, axis - width, "left")
    start = np.maximum.accumulate(np.where(_starts(codes), at, 0))
    kinds = pd.factorize(codes * (prints.max() + 1) + prints)[0]
    order = np.argsort(kinds, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = at
    keys = kinds[order] * n + order  # the clicks of one kind in order, one kind after the other
    weight = np.array([_weight(c) for c in range(int(np.bincount(kinds).max()) + 2)], np.int64)
    before = np.where(at == start, at, np.r_[0, head[:-1]])  # the window's first click when this one arrives
    there = place - np.searchsorted(keys, kinds * n + before, "left")
    arrived = np.cumsum(weight[there + 1] - weight[there])
    leaves = np.searchsorted(head, at, "right")  # the click with which this one departs
    gone = np.flatnonzero(leaves < n)
    gone = gone[codes[leaves[gone]] == codes[gone]]
    there = np.searchsorted(keys, kinds[gone] * n + leaves[gone], "right") - place[gone]
    departed = np.zeros(n + 1, np.int64)
    departed[gone + 1] = weight[there - 1] - weight[there]
    departed = np.cumsum(departed)
    total = at - head + 1
    held = arrived - np.r_[0, arrived][start] + departed[head] - departed[start]
    whole = np.array([_weight(c) for c in range(int(total.max()) + 1)], np.int64)[total]
    return np.maximum(0.0, (whole - held) / (total * 1e8))


class BucketClickProcessor(StatefulProcessor):
    """As ``ClickFeatureProcessor`` without expiry, for all IPs of one bucket at once, column by column.

    Rows come as ``columns``: the packed text, ``_us``, ``_key`` (the IP as a text), ``_device``, ``_os`` and
    ``_tie``, with nulls of the first and the last marked in ``_nulls``. The kept clicks of a bucket are a list
    of chunks in arrival order: a micro-batch reads them all, uses those of its IPs and adds one of its own.
    Once more than half of them can be dropped, or the chunks are many, they become one chunk.
    IPs whose clicks are not in the order of time go through ``IpState``.
    """

    def __init__(self, out: T.StructType, packing: Packing, clock: str | Callable[[dict], int], columns: list[str]):
        self.fields, self.packing, self.clock, self.columns = out.fieldNames(), packing, clock, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.chunks = handle.getListState("chunks", T.StructType([T.StructField("data", T.BinaryType())]))

    def _now(self, part: dict[str, np.ndarray]) -> np.ndarray:
        if self.clock == "processing":
            return np.array([wall.time_ns() // 1000 for _ in part[US]], np.int64)
        timed = part["_nulls"] & 1 == 0
        if self.clock == "event":
            if not timed.all():
                raise ValueError("a click without a time needs another clock")
            return part[US]
        return np.array([self.clock(self.packing.opened({self.packing.NAME: text, US: us if known else None}))
                         for text, us, known in zip(part[self.packing.NAME], part[US].tolist(), timed)], np.int64)

    def handleInputRows(self, key, rows, timerValues):
        rows = list(rows)
        rows = rows[0] if len(rows) == 1 else pd.concat(rows, ignore_index=True)
        part = {name: rows.iloc[:, i].to_numpy() for i, name in enumerate(self.columns)}  # pandas may have renamed them
        stored = [pa.ipc.open_stream(row[0]).read_all() for row in self.chunks.get()]
        codes, ips = pd.factorize(part["_key"])
        nulls, tie = part["_nulls"], part["_tie"]
        tie = pd.factorize(tie, sort=True)[0] if tie.dtype == object else tie
        at = np.lexsort([tie, (nulls >> 1 & 1) == 0, part[US], (nulls & 1) == 0, codes])
        part, codes = {name: values[at] for name, values in part.items()}, codes[at]
        fresh = {"ip": part["_key"], "us": self._now(part), "device": part["_device"], "os": part["_os"]}
        kept = _columns(pa.concat_tables(stored)) if stored else {name: values[:0] for name, values in fresh.items()}
        of = pd.Index(ips).get_indexer(kept["ip"]) if stored else codes[:0]
        mine, of = {name: values[of >= 0] for name, values in kept.items()}, of[of >= 0]
        if self.clock != "event":  # never runs backwards within an IP
            last = np.full(len(ips), np.iinfo(np.int64).min)
            last[of] = mine["us"]
            times = np.maximum(fresh["us"], last[codes])
            if len(_backwards(codes, times)):
                times = pd.Series(times).groupby(codes).cummax().to_numpy()
            fresh["us"] = times
        by = np.r_[of, codes]
        order = np.argsort(by, kind="stable")
        both = {name: np.concatenate([mine[name], fresh[name]])[order] for name in fresh}
        found = _trail_features(by[order], both, order >= len(of))
        yield pd.DataFrame({self.packing.NAME: part[self.packing.NAME], **found})[self.fields]
        self._store(len(stored), kept, fresh)

    def _store(self, chunks: int, kept: dict[str, np.ndarray], fresh: dict[str, np.ndarray]) -> None:
        if chunks >= LOOK_CHUNKS:
            whole = {name: np.concatenate([kept[name], fresh[name]]) for name in fresh}
            needed = _needed(whole["ip"], whole["us"])
            if chunks >= MOST_CHUNKS or 2 * int(needed.sum()) < len(needed):
                self.chunks.put([(_chunk({name: values[needed] for name, values in whole.items()}),)])
                return
        self.chunks.appendValue((_chunk(fresh),))

    def close(self) -> None:
        pass


def _chunk(clicks: dict[str, np.ndarray]) -> bytes:
    batch = pa.RecordBatch.from_arrays([pa.array(values) for values in clicks.values()], list(clicks))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _columns(table: pa.Table) -> dict[str, np.ndarray]:
    return {name: table.column(name).to_numpy() for name in table.column_names}


def _backwards(codes: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The codes, which lie in runs, of rows that are older than the one before in their run."""
    return codes[1:][(codes[1:] == codes[:-1]) & (times[1:] < times[:-1])]


def _places(codes: np.ndarray) -> np.ndarray:
    """The place of each row in its run."""
    at = np.arange(len(codes))
    return at - np.maximum.accumulate(np.where(_starts(codes), at, 0))


def _heads(codes: np.ndarray, times: np.ndarray) -> np.ndarray:
    """For runs of one code each: the place of the first row that a later one can still see."""
    ends = np.flatnonzero(np.r_[codes[1:] != codes[:-1], True])
    widest = max(schemas.WINDOW_SECONDS.values())
    axis = _paced(codes, times, widest * MICROS)
    head = np.searchsorted(axis, axis[ends] - widest * MICROS, "left") - np.flatnonzero(_starts(codes))
    for run in np.unique(_backwards(codes, times)):
        mine = np.flatnonzero(codes == run)
        trail = Trail([widest])
        for now in times[mine].tolist():
            trail.add(now)
        head[np.searchsorted(codes[ends], run)] = trail.heads[widest]
    return head


def _needed(ips: np.ndarray, times: np.ndarray) -> np.ndarray:
    """False for clicks, given in arrival order, in blocks of ``BLOCK`` that lie wholly before their IP's widest window."""
    codes = pd.factorize(ips)[0]
    order = np.argsort(codes, kind="stable")
    runs = codes[order]
    head = _heads(runs, times[order])
    needed = np.zeros(len(codes), bool)
    needed[order] = _places(runs) >= (head // BLOCK * BLOCK)[runs]
    return needed


def _trail_features(codes: np.ndarray, clicks: dict[str, np.ndarray], fresh: np.ndarray) -> dict[str, np.ndarray]:
    """The features of the ``fresh`` clicks; the clicks of an IP, as ``codes`` has it, lie together in arrival order."""
    times = clicks["us"]
    kinds = {name: pd.factorize(clicks[name])[0] for name in ("device", "os")}
    out = {name: np.zeros(len(codes), float if name.endswith(("entropy_5m", "seconds")) else np.int64) for name in STATE_FEATURES}
    back = np.zeros(int(codes.max()) + 1, bool)
    back[_backwards(codes, times)] = True
    plain = np.flatnonzero(~back[codes])
    if len(plain):
        c, t = codes[plain], times[plain]
        device = kinds["device"][plain]
        for name, values in _window_counts(c, t).items():
            out[f"ip_clicks_{name}"][plain] = values
        pairs = pd.factorize(c * (device.max() + 1) + device)[0]
        order = np.argsort(pairs, kind="stable")
        for name, values in _window_counts(pairs[order], t[order]).items():
            out[f"device_clicks_{name}"][plain[order]] = values
        out["ip_fingerprint_entropy_5m"][plain] = _entropies(c, t, device * (kinds["os"].max() + 1) + kinds["os"][plain])
        out["ip_inter_click_gap_seconds"][plain] = np.where(_starts(c), 0.0, np.diff(t, prepend=t[:1]) / MICROS)
    for run in np.flatnonzero(back):
        mine = np.flatnonzero(codes == run)
        trail = [(now, *pair) for now, *pair in zip(
            times[mine].tolist(), kinds["device"][mine].tolist(), kinds["os"][mine].tolist())]
        old = int(len(mine) - fresh[mine].sum())
        # of the stored clicks those that are still kept
        first = int(_heads(codes[mine[:old]], times[mine[:old]])[0]) // BLOCK * BLOCK if old else 0
        state = IpState(trail[first:old], trail[old - 1][0] if old else None)
        for place, click in zip(mine[old:].tolist(), trail[old:]):
            for name, value in state.click(*click).items():
                out[name][place] = value
    return {name: values[fresh] for name, values in out.items()}


class CountProcessor(StatefulProcessor):
    """Adds the number of the key's earlier rows."""

    def __init__(self, out: T.StructType, packing: Packing, name: str, order: list[str]):
        self.fields, self.packing, self.name, self.order = out.fieldNames(), packing, name, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState(
            "count", T.StructType([T.StructField("n", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues):
        stored = self.count.get()
        count = stored[0] if stored else 0
        for row in _ordered(rows, self.packing, self.order):
            row[self.name] = count
            count += 1
            yield Row(**{name: row[name] for name in self.fields})
        self.count.update((count,))

    def close(self) -> None:
        pass


class BucketCountProcessor(StatefulProcessor):
    """As ``CountProcessor``, for all keys of one bucket at once, column by column.

    Rows come as ``columns``: ``_key``, the key as a text, the ``orders`` columns, of which the null ones
    are bits in ``_nulls``, and those that pass through.
    """

    def __init__(self, out: T.StructType, name: str, columns: list[str], orders: list[str]):
        self.fields, self.name, self.columns, self.orders = out.fieldNames(), name, columns, orders

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState(
            "counts", T.StructType([T.StructField("key", T.StringType())]), T.StructType([T.StructField("n", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues):
        part = pd.concat(list(rows), ignore_index=True)
        part.columns = self.columns  # pandas may have renamed them on the way
        codes, keys = pd.factorize(part["_key"])
        nulls, by = part["_nulls"].to_numpy(), []
        for i in reversed(range(len(self.orders))):  # the last counts most
            values = part[self.orders[i]].to_numpy()
            by += [pd.factorize(values, sort=True)[0] if values.dtype == object else values, (nulls >> i & 1) == 0]
        at = np.lexsort([*by, codes])
        sizes = np.bincount(codes, minlength=len(keys))
        stored = [self.counts.getValue((k,)) for k in keys]
        before = np.array([s[0] if s else 0 for s in stored], np.int64)
        part = part.iloc[at]
        part[self.name] = np.arange(len(at)) + np.repeat(before - (np.cumsum(sizes) - sizes), sizes)
        yield part[self.fields]
        for k, n in zip(keys, (before + sizes).tolist(), strict=True):
            self.counts.updateValue((k,), (n,))

    def close(self) -> None:
        pass


def _sort_value(field: T.StructField) -> Column | None:
    """A value that pandas sorts as Spark sorts the column; nulls become one value. None if there is none."""
    column, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.StringType):
        return F.coalesce(column, F.lit(""))
    if isinstance(kind, (*_WHOLE, T.TimestampType, T.DateType)):
        whole = F.unix_micros(column) if isinstance(kind, T.TimestampType) else F.unix_date(column) if isinstance(
            kind, T.DateType) else column
        return F.coalesce(whole.cast("long"), F.lit(0).cast("long"))
    if isinstance(kind, _REAL):
        return F.coalesce(column.cast("double"), F.lit(0.0))
    return None


_BUCKET_COLUMNS = {"_bucket", "_key", "_device", "_os", "_tie", "_nulls"}


def _key_text(field: T.StructField) -> Column:
    """A text for each key, as groups have them."""
    value = F.col(f"`{field.name}`")  # the zeros are one key
    return F.to_json(F.struct((value + 0.0 if isinstance(field.dataType, _REAL) else value).alias("k")))


def enrich_stream(
    clicks: DataFrame, clock: str | Callable[[dict], int] = "processing", time: str = "timestamp",
    tie: str = "click_id", ttl_ms: int | None = schemas.STATE_TTL_MS, delay: str | None = None,
    once: bool = False,
) -> DataFrame:
    """Streaming clicks with the IP, per-IP device, entropy and gap features.

    With the processing clock or one of your own, state expires ``ttl_ms`` after its last
    write; such a stream runs until it is stopped, and ends with its source only when
    ``ttl_ms`` is None. The event clock trims state by the widest window. With ``delay`` it also sets a
    watermark on the click time: clicks later than the delay are dropped, others join the
    windows as they arrive, and an IP without clicks for ``ttl_ms`` of event time loses its
    state when the watermark passes. ``once`` drops replays of a ``tie`` within the delay first.
    """
    if delay is not None and clock != "event":
        raise ValueError("a watermark needs clock='event'")
    if delay is not None and ttl_ms is None:
        raise ValueError("a watermark needs ttl_ms, the time after which an IP is idle")
    if once and delay is None:
        raise ValueError("replays are dropped within a delay")
    if delay is not None:
        clicks = clicks.withWatermark(time, delay)
    if once:
        clicks = clicks.dropDuplicatesWithinWatermark([tie])
    timed = clicks.withColumn(US, F.unix_micros(F.col(time).cast("timestamp")))
    kinds = {
        n: T.DoubleType() if n.endswith(("entropy_5m", "seconds")) else T.LongType()
        for n in STATE_FEATURES
    }
    live = clock != "event" and ttl_ms is not None
    order = _sort_value(clicks.schema[tie]) if tie in clicks.columns else None
    plain = not Packing(clicks.schema).beside and not _BUCKET_COLUMNS & set(clicks.columns)
    if not live and delay is None and order is not None and plain:
        return _enrich_buckets(clicks, timed, clock, order, tie, kinds)
    packing = Packing(clicks.schema, ["ip", *([time] if delay is not None else [])])
    out = T.StructType([*packing.fields, *[T.StructField(n, k) for n, k in kinds.items()]])
    mode = "ProcessingTime" if live else "None" if delay is None else "EventTime"
    enriched = packing.pack(timed, US).groupBy("ip").transformWithState(
        ClickFeatureProcessor(
            out, packing, clock, tie, ttl_ms if live else None, None if delay is None else ttl_ms * 1000),
        out, "Append", mode,
    )
    return packing.restore(enriched, list(kinds))


def _enrich_buckets(clicks: DataFrame, timed: DataFrame, clock: str | Callable[[dict], int], order: Column, tie: str,
                    kinds: dict[str, T.DataType]) -> DataFrame:
    """``enrich_stream`` where no state expires and all columns are plain: IPs in buckets, which Python takes at once."""
    packing = Packing(clicks.schema)
    out = T.StructType([T.StructField(Packing.NAME, T.StringType()), *[T.StructField(n, k) for n, k in kinds.items()]])
    ready = timed.withColumns({
        "_key": _key_text(clicks.schema["ip"]), US: F.coalesce(US, F.lit(0).cast("long")), "_tie": order,
        "_nulls": F.when(F.col(US).isNull(), 1).otherwise(0) + F.when(F.col(f"`{tie}`").isNull(), 2).otherwise(0),
        **{name: F.coalesce(F.col(column).cast("string"), F.lit("None"))
           for name, column in (("_device", "device_id"), ("_os", "os"))}})
    ready = ready.withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(CLICK_BUCKETS)).cast("int"))
    packed = packing.pack(ready, "_bucket", US, "_key", "_device", "_os", "_tie", "_nulls")
    enriched = packed.groupBy("_bucket").transformWithStateInPandas(
        BucketClickProcessor(out, packing, clock, packed.columns), out, "Append", "None")
    return packing.restore(enriched, list(kinds))


def count_so_far_stream(
    df: DataFrame, key: str, order: list[str], name: str = "dest_txn_count_so_far"
) -> DataFrame:
    """Streaming rows with the number of earlier rows of their key.

    Keys are counted in buckets, so that Python takes many rows at once. Rows with columns of other
    than plain types go one by one, key by key.
    """
    packing = Packing(df.schema)
    sorting = [_sort_value(df.schema[c]) for c in order]
    if packing.beside or any(s is None for s in sorting):
        packing = Packing(df.schema, [key])
        out = T.StructType([*packing.fields, T.StructField(name, T.LongType())])
        counted = packing.pack(df).groupBy(key).transformWithState(
            CountProcessor(out, packing, name, order), out, "Append", "None")
        return packing.restore(counted, [name])
    orders, nulls = [f"_o{i}" for i in range(len(order))], F.lit(0).cast("long")
    for i, c in enumerate(order):
        nulls = nulls + F.when(F.col(f"`{c}`").isNull(), 1 << i).otherwise(0)
    ready = df.withColumns({"_key": _key_text(df.schema[key]), "_nulls": nulls, **dict(zip(orders, sorting, strict=True))})
    ready = ready.withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(BUCKETS)).cast("int"))
    out = T.StructType([T.StructField(Packing.NAME, T.StringType()), T.StructField(name, T.LongType())])
    packed = packing.pack(ready, "_bucket", "_key", "_nulls", *orders)
    counted = packed.groupBy("_bucket").transformWithStateInPandas(
        BucketCountProcessor(out, name, packed.columns, orders), out, "Append", "None")
    return packing.restore(counted, [name])
