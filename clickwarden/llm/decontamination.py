"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are compared as bytes of lower-cased UTF-8 in which every run of ASCII characters other
than letters and digits is one space. A benchmark item gives patterns: itself if it has at
most ``window`` bytes, else overlapping windows of that length. A pattern of w bytes may
differ by e = floor(rate * w) edits. By the q-gram lemma a region within e edits shares at
least w - q + 1 - q * e q-grams with the pattern, on diagonals that differ by e at most.

Per document, in numpy: look up all q-grams of the whole text in the patterns' q-grams; keep
only stretches that are dense enough for some pattern; count the hits of the rest by pattern
in overlapping diagonal bands of twice the width e + 1; and verify the bands that meet the
bound by an alignment inside the band with free ends in the document. A document leaks when
a pattern lies in it within its budget.

The benchmark is a stated query set of any size: it is read in blocks of at most
``block_bytes`` (a proven bound on what is sent to the tasks), and the documents pass once for
each block, carrying what was found so far.

Items with fewer than ``least`` bytes of letters and digits leave no room for edits: a document leaks
one where all its words stand one after the other, as whole words and in any case (one automaton a
block finds all of them in one pass of a text). Items without a letter or digit are in no document.
Null and empty texts leak nothing; a null item is ignored. Rows that repeat get one
result each. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwarden.llm.common import column_batches, memo_of, spill
from clickwarden.llm.quality import keep_rows

Q = 8
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                  for b in range(256)], np.uint8)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BITS = 20  # least; the filter has eight slots for a gram
_BLOCK = 32
PASSES = 4
STATE = "doc_id long, text string, leaks long, item_id long, edits int, place long"


def folded(text: str | None) -> np.ndarray:
    raw = _FOLD[np.frombuffer((text or "").lower().encode("utf-8", "replace"), np.uint8)]
    space = raw == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    return raw[keep]


def grams(data: np.ndarray) -> np.ndarray:
    """All q-grams of eight bytes as numbers."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    data = np.ascontiguousarray(data)
    return np.ndarray((len(data) - Q + 1,), "<u8", data, 0, (1,)).copy()


def slots(codes: np.ndarray, bits: int) -> np.ndarray:
    return (codes * _MIX >> np.uint64(64 - bits)).view(np.int64)


def phrase(data: np.ndarray) -> str:
    """The words of a folded text, one byte a character, with a space on either side."""
    return f" {data.tobytes().decode('latin-1').strip(' ')} "


@dataclass
class Patterns:
    """Patterns of a block of items, and their q-grams in sorted order; short items as ``phrases``."""

    texts: list[np.ndarray]
    items: list[int]
    budget: np.ndarray
    bound: np.ndarray
    codes: np.ndarray
    first: np.ndarray
    owner: np.ndarray
    place: np.ndarray
    flags: np.ndarray
    bits: int
    classes: list[tuple[int, int]]
    phrases: ahocorasick.Automaton | None = None

    @classmethod
    def of(cls, items: list[tuple[int, str]], window: int, rate: float, least: int) -> Patterns:
        texts, ids, short = [], [], {}
        for item, text in items:
            data = folded(text)
            if (symbols := int((data != 32).sum())) < least:
                if symbols:
                    short.setdefault(phrase(data), set()).add(item)
                continue
            starts = [0] if len(data) <= window else [*range(0, len(data) - window, window // 2), len(data) - window]
            for at in starts:
                texts.append(data[at:at + window])
                ids.append(item)
        length = np.array([len(t) for t in texts], np.int64)
        budget = (length * rate).astype(np.int64)
        codes = [grams(t) for t in texts]
        flat = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(texts)), [len(c) for c in codes])
        place = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        unique, first = np.unique(flat[order], return_index=True)
        bits = max(_BITS, (8 * len(unique)).bit_length())
        flags = np.zeros(1 << bits, bool)
        flags[slots(unique, bits)] = True
        bound = length - Q + 1 - Q * budget
        # patterns of like length share the longest stretch and the least number of hits
        classes = [(int((length + budget)[kind == k].max()), int(max(1, bound[kind == k].min())))
                   for kind in [length // 16] for k in np.unique(kind)]
        phrases = ahocorasick.Automaton() if short else None
        for words, ids_of in short.items():
            phrases.add_word(words, (len(words) - 2, tuple(sorted(ids_of))))
        if short:
            phrases.make_automaton()
        return cls(texts, ids, budget, bound, unique,
                   np.append(first, len(flat)), owner[order], place[order], flags, bits, classes, phrases)


def edits_in_band(pattern: np.ndarray, text: np.ndarray, low: int, width: int, budget: int) -> int:
    """Fewest edits that turn ``pattern`` into a stretch of ``text`` on diagonals low..low+width-1.

    Row i holds the costs on the band's diagonals d, where text position i + d is reached.
    Returns budget + 1 when there is none within the budget.
    """
    big = len(pattern) + len(text) + 1
    d = np.arange(width) + low
    at = d
    cost = np.where((at >= 0) & (at <= len(text)), 0, big)
    for i, symbol in enumerate(pattern):
        at = i + d
        valid = (at >= 0) & (at < len(text))
        same = np.zeros(width, bool)
        same[valid] = text[at[valid]] == symbol
        change = np.where(valid, cost + ~same, big)
        drop = np.append(cost[1:], big) + 1
        new = np.minimum(change, drop)
        # an inserted text byte moves to the next diagonal in the same row
        new = np.minimum.accumulate(new - np.arange(width)) + np.arange(width)
        cost = np.where((i + 1 + d >= 0) & (i + 1 + d <= len(text)), new, big)
        if cost.min() > budget:
            return budget + 1
    return int(min(cost.min(), budget + 1))


def leaks_in(text: str | None, patterns: Patterns) -> dict[int, tuple[int, int]]:
    """item -> (edits, place) of the items that have a pattern in the text, or all of whose words stand there."""
    data = folded(text)
    return {**short_leaks(data, patterns), **long_leaks(data, patterns)}


def short_leaks(data: np.ndarray, patterns: Patterns) -> dict[int, tuple[int, int]]:
    out: dict[int, tuple[int, int]] = {}
    if patterns.phrases is None:
        return out
    padded = f" {data.tobytes().decode('latin-1')} "
    for last, (size, items) in patterns.phrases.iter(padded):  # places rise, the first one counts
        for item in items:
            out.setdefault(item, (0, last - 1 - size))
    return out


def long_leaks(data: np.ndarray, patterns: Patterns) -> dict[int, tuple[int, int]]:
    if not patterns.texts:
        return {}
    codes = grams(data)
    if not len(codes):
        return {}
    hit = patterns.flags[slots(codes, patterns.bits)]
    # first by blocks: a stretch of ``reach`` lies in ``span`` of them
    blocks = np.add.reduceat(hit, np.arange(0, len(hit), _BLOCK), dtype=np.int32)
    sums, dense, ends = None, [], []
    for reach, least in patterns.classes:
        span = min((reach - 1) // _BLOCK + 2, len(blocks))
        if np.convolve(blocks, np.ones(span, np.int32)).max() < least:
            continue
        sums = np.r_[0, np.cumsum(hit)] if sums is None else sums
        until = np.minimum(np.arange(len(codes)) + reach, len(codes))
        from_ = np.flatnonzero(sums[until] - sums[:-1] >= least)
        dense.append(from_)
        ends.append(until[from_])
    if not any(len(d) for d in dense):
        return {}
    dense, ends = np.concatenate(dense), np.concatenate(ends)
    reach = max(r for r, _ in patterns.classes)
    near = np.zeros(len(codes) + 1, np.int32)
    np.add.at(near, dense, 1)
    np.add.at(near, ends, -1)
    where = np.flatnonzero(hit & (np.cumsum(near[:-1]) > 0))
    at = np.minimum(np.searchsorted(patterns.codes, codes[where]), len(patterns.codes) - 1)
    real = patterns.codes[at] == codes[where]
    where, at = where[real], at[real]
    n = patterns.first[at + 1] - patterns.first[at]
    spread = np.repeat(patterns.first[at] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(int(n.sum()))
    owner, diagonal = patterns.owner[spread], np.repeat(where, n) - patterns.place[spread]
    step = patterns.budget[owner] + 1
    shifted = diagonal + len(data) + reach  # not negative
    band = shifted // step
    key = np.r_[owner * (1 << 40) + band, owner * (1 << 40) + band - 1]  # a band reaches over two steps
    found, count = np.unique(key, return_counts=True)
    owners, bands = found >> 40, found & (1 << 40) - 1
    full = count >= np.maximum(1, patterns.bound[owners])
    out: dict[int, tuple[int, int]] = {}
    whole = data.tobytes()
    for o, b in zip(owners[full].tolist(), bands[full].tolist(), strict=True):
        item, pattern, e = patterns.items[o], patterns.texts[o], int(patterns.budget[o])
        if item in out and out[item][0] == 0:
            continue
        low = b * (e + 1) - len(data) - reach
        exact = whole.find(pattern.tobytes(), max(0, low), max(0, low) + 2 * (e + 1) + len(pattern))
        if exact >= 0:
            edits, place = 0, exact
        else:
            left = max(0, low - e - 1)
            piece = data[left:max(0, low) + 3 * (e + 1) + len(pattern) + e]
            edits, place = edits_in_band(pattern, piece, low - left - e, 2 * (e + 1) + 2 * e, e), max(0, low)
        if edits <= e and (item not in out or edits < out[item][0]):
            out[item] = (edits, place)
    return out


def benchmark_blocks(benchmark: DataFrame, block_bytes: int):
    """Lists of (item_id, text), each of at most ``block_bytes`` or a single item."""
    block, held = [], 0
    rows = benchmark.filter("item_id is not null and text is not null").select(
        F.col("item_id").cast("long"), F.col("text").cast("string")).orderBy("item_id", "text")
    for item, text in rows.toLocalIterator():
        size = len(text.encode("utf-8", "replace"))
        if block and held + size > block_bytes:
            yield block
            block, held = [], 0
        block.append((item, text))
        held += size
    if block:
        yield block


def search_block(rows: DataFrame, block: list[tuple[int, str]], window: int, rate: float, least: int) -> DataFrame:
    """``rows`` (STATE) with the leaks of one more block of items."""

    def search(batches):
        patterns = Patterns.of(block, window, rate, least)
        memo_of("decontamination")
        for batch in column_batches(batches):
            leaks, item, edits, place = (batch.column(i).to_pylist() for i in range(2, 6))
            for at, text in enumerate(batch.column(1).to_pylist()):
                found = leaks_in(text, patterns)
                if not found:
                    continue
                leaks[at] += len(found)
                best = min((e, i, p) for i, (e, p) in found.items())
                if item[at] is None or best[:2] < (edits[at], item[at]):
                    edits[at], item[at], place[at] = best
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(leaks, pa.int64()), pa.array(item, pa.int64()),
                pa.array(edits, pa.int32()), pa.array(place, pa.int64())], batch.schema.names)

    return rows.mapInArrow(search, STATE)


def benchmark_leaks(docs: DataFrame, benchmark: DataFrame, window: int = 128, rate: float = 0.06,
                    least: int = 40, block_bytes: int = 1_000_000) -> DataFrame:
    """For every row of ``docs``: number of leaked items, the nearest of them, its edits and place."""
    none = F.lit(None)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.lit(0).cast("long").alias("leaks"),
        none.cast("long").alias("item_id"), none.cast("int").alias("edits"), none.cast("long").alias("place"))
    for number, block in enumerate(benchmark_blocks(benchmark, block_bytes), 1):
        rows = search_block(rows, block, window, rate, least)
        if number % PASSES == 0:  # so that a task never holds more searches than these
            rows = spill(rows, "leaks")
    return rows.drop("text")


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = 128, rate: float = 0.06,
                    least: int = 40, block_bytes: int = 1_000_000) -> DataFrame:
    """The rows of ``docs`` whose text leaks no item, with all their columns."""
    for number, block in enumerate(benchmark_blocks(benchmark, block_bytes), 1):
        docs = keep_rows(docs, _leak_free(block, window, rate, least))
        if number % PASSES == 0:
            docs = spill(docs, "leak_free")
    return docs


def _leak_free(block: list[tuple[int, str]], window: int, rate: float, least: int):
    made: list[Patterns] = []  # once in a task

    def decide(texts: pa.Array) -> list[bool]:
        if not made:
            made.append(Patterns.of(block, window, rate, least))
        return [not leaks_in(t, made[0]) for t in texts.to_pylist()]

    return decide
