"""Best-fit packing of documents into sequences of a fixed number of tokens.

Documents are tokenised where they are read; only (id, piece, length, checksum) rows go on.
Pieces are dealt evenly into groups of bounded size, independent of any key, and each group
is packed by best-fit decreasing: the longest piece first, always into the open sequence
with the least room that still holds it, which a segment tree over room sizes finds in
logarithmic time. Full pieces make a sequence of their own. A group leaves at most a few
sequences that are not full, so the loss against one global packing is a handful of
sequences per ``group_pieces`` pieces.

Nulls and empty texts are documents with the closing id alone. Rows that repeat are packed
once for each row. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwarden.llm.common import column_batches, memo_of, spill
from clickwarden.llm.tokens import default_path, encoder

# Fewer than an operator on its own remembers: in the pipeline its stage comes last, when executors are fullest.
MOST_CHUNKS = 500_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, deal long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class RoomTree:
    """Segment tree over room sizes 0..capacity; a leaf counts open bins with that room."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, room: int, change: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += change
            node >>= 1

    def tightest(self, need: int) -> int:
        """The smallest room of at least ``need`` that an open bin has, or -1."""
        count, node = self.count, need + self.size
        if count[node]:
            return need
        while node > 1:
            if not node & 1 and count[node + 1]:
                node += 1
                break
            node >>= 1
        else:
            return -1
        while node < self.size:
            node *= 2
            if not count[node]:
                node += 1
        return node - self.size


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of every length (each from 1 to ``capacity``)."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree = RoomTree(capacity)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        room = tree.tightest(need) if need < capacity else -1
        if room < 0:
            number, room, made = made, capacity, made + 1
        else:
            number = open_bins[room].pop()
            tree.add(room, -1)
        bins[i], offsets[i] = number, capacity - room
        if room > need:
            open_bins[room - need].append(number)
            tree.add(room - need, 1)
    return bins, offsets


def pieces(docs: DataFrame, capacity: int, tokenizer_path: str | None = None, end_id: int = 0) -> DataFrame:
    """One row per piece of at most ``capacity`` tokens; longer documents are cut."""
    path = tokenizer_path or default_path()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        from pyspark import TaskContext

        encode, seen = encoder(path, MOST_CHUNKS).encode, TaskContext.get().partitionId() * 2654435761
        for batch in column_batches(batches):
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    seen += 0x9E3779B97F4A7C15
                    mixed = (seen ^ seen >> 29) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
                    out.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), mixed >> 33))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(
                    zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "deal"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def pack(docs: DataFrame, capacity: int = 2048, group_pieces: int = 50_000,
         tokenizer_path: str | None = None, end_id: int = 0) -> DataFrame:
    """Sequence and offset of every piece of ``docs`` (doc_id, text)."""
    stored = spill(pieces(docs, capacity, tokenizer_path, end_id), "pieces")
    groups = max(1, -(-stored.count() // group_pieces))

    def place(key, group: pd.DataFrame) -> pd.DataFrame:
        memo_of("packing")
        group = group.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        bins, offsets = best_fit_decreasing(group["length"].to_numpy(np.int64), capacity)
        return group.assign(sequence_id=bins + (int(key[0]) << 32), offset=offsets)[
            ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    return stored.withColumn("bin_group", F.col("deal") % groups).groupBy("bin_group").applyInPandas(place, PACKED)
