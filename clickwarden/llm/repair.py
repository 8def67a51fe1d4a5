"""Token-id output as Re-Pair grammars, one file per shard, with random-access decoding.

Documents are laid out by range of doc_id, so the shards follow each other in ascending
order. A task streams its range: it encodes documents, closes each with the end id, and
writes a shard whenever the ids reach ``shard_ids``, so memory does not grow with the range.
Each shard is compressed by Re-Pair: in every round the most frequent pairs of neighbouring
symbols become nonterminals and are replaced from left to right; rounds go on until no pair
stands in ``least`` places. Pairs never reach over a document's end, so a
document can be decoded alone. Nonterminals carry their expansion lengths, which lead any
range of ids to the symbols that hold it.

A shard file, little-endian: ``RPTK``, version, rules n, end id as unsigned 32 bit; number
of documents, of symbols and of ids as unsigned 64 bit; then the arrays doc_id (int64), null
flag of the id (uint8), first symbol (uint64, one more than documents), first id (uint64, one
more), rule pairs (uint32, n by 2), expansion lengths of the rules (uint32), symbols (uint32).
Nonterminal k is symbol 2^31 + k.

Files are written under another name and renamed, so a repeated task leaves the same file.
Null and empty texts hold the end id alone. Rows with one doc_id keep any order among
themselves. Extra columns are ignored; an empty table gives no files and no rows.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickwarden.llm.common import column_batches, fresh_folder, memo_of, spill
from clickwarden.llm.tokens import default_path, encoder

HEAD = struct.Struct("<4sIIIQQQ")
BASE = np.uint32(1 << 31)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BITS = 19
SHARDS_PER_TASK = 4  # read one after the other where there are many
MANIFEST = "shard string, partition int, part int, n_docs long, n_ids long, n_symbols long, n_rules long"
DECODED = "shard string, place int, doc_id long, start long, n_tokens long, ids_crc32 long"


def frequent_pairs(seq: np.ndarray, live: np.ndarray, most: int,
                   least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The commonest pairs (codes), the places where they stand, which pair stands there, and
    the places that may still hold a frequent pair.

    Pairs at the ``live`` places are counted in hashed bins. One pair stands for each of the
    fullest bins and is then counted exactly; another pair in its bin has its turn in a later
    round. Where no standing pair is frequent enough, all pairs of the full bins are counted.
    """
    code = seq[live].astype(np.uint64) << np.uint64(32) | seq[live + 1]
    bins = (code * _MIX >> np.uint64(64 - _BITS)).view(np.int64)
    full = np.bincount(bins, minlength=1 << _BITS)
    held = np.flatnonzero((full >= least)[bins])
    live, bins, code = live[held], bins[held], code[held]
    none = np.zeros(0, np.int64)
    if not len(live):
        return none, none, none, live
    fullest = np.sort(full[full >= least])[-2 * most:]
    at = np.flatnonzero((full >= fullest[0])[bins])
    stands = np.zeros(1 << _BITS, np.uint64)
    own, pair = bins[at], code[at]
    stands[own] = pair
    same = stands[own] == pair
    at, own = at[same], own[same]
    count = np.bincount(own, minlength=1 << _BITS)
    chosen = np.flatnonzero(count >= least)
    codes = stands[chosen]
    if not len(chosen):
        codes, own, count = np.unique(code, return_inverse=True, return_counts=True)
        at, chosen = np.arange(len(code)), np.flatnonzero(count >= least)
        codes = codes[chosen]
    if len(chosen) > most:
        best = np.sort(np.argsort(-count[chosen], kind="stable")[:most])
        chosen, codes = chosen[best], codes[best]
    number = np.full(len(count), -1, np.int64)
    number[chosen] = np.arange(len(chosen))
    which = number[own]
    return codes, live[at[which >= 0]], which[which >= 0], live


def repair(ids: np.ndarray, end_id: int, pairs_per_round: int = 4096,
           least: int = 32) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, rule pairs and expansion lengths of the rules.

    A pair of symbols only grows rarer once both are there, so places of pairs found rare
    are not looked at again; a round adds those next to its new symbols.
    """
    seq, rules, lengths = ids.astype(np.uint32), np.zeros((0, 2), np.uint32), np.zeros(0, np.uint32)
    ends = seq == end_id
    live = np.flatnonzero(~(ends[:-1] | ends[1:]))  # no pair reaches over a document's end
    while True:
        pairs, at, rule, live = frequent_pairs(seq, live, pairs_per_round, least)
        if not len(pairs):
            break
        # of pairs that overlap, every second one counted from the left of its run is kept
        first = np.flatnonzero(np.r_[True, np.diff(at) != 1])
        in_run = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
        at, rule = at[in_run % 2 == 0], rule[in_run % 2 == 0]
        new = np.stack([(pairs >> np.uint64(32)).astype(np.uint32), pairs.astype(np.uint32)], 1)
        seq[at] = BASE + np.uint32(len(rules)) + rule.astype(np.uint32)
        touched = np.zeros(len(seq), bool)
        touched[at] = touched[at + 1] = True
        live = live[~(touched[live] | touched[live + 1])]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        place = np.cumsum(keep, dtype=np.int32) - 1
        seq = seq[keep]
        mark = np.zeros(len(seq) + 1, bool)
        at = place[at]
        mark[at] = mark[at - 1] = True  # before the first symbol: the spare last place
        near = np.flatnonzero(mark[:len(seq) - 1])
        mark[near[(seq[near] == end_id) | (seq[near + 1] == end_id)]] = False
        mark[place[live]] = True
        live = np.flatnonzero(mark[:len(seq) - 1])
        rules = np.concatenate([rules, new])
        lengths = np.concatenate([lengths, lengths_of(new[:, 0], lengths) + lengths_of(new[:, 1], lengths)])
    return seq, rules, lengths


def lengths_of(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    out = np.ones(len(symbols), np.uint32)
    inner = symbols >= BASE
    out[inner] = lengths[symbols[inner] - BASE]
    return out


def expand(symbols: np.ndarray, rules: np.ndarray) -> np.ndarray:
    """The ids that a run of symbols stands for."""
    while True:
        inner = symbols >= BASE
        if not inner.any():
            return symbols
        first = np.cumsum(1 + inner) - (1 + inner)
        out = np.empty(len(symbols) + int(inner.sum()), np.uint32)
        out[first[~inner]] = symbols[~inner]
        pairs = rules[symbols[inner] - BASE]
        out[first[inner]], out[first[inner] + 1] = pairs[:, 0], pairs[:, 1]
        symbols = out


def expand_whole(symbols: np.ndarray, rules: np.ndarray) -> np.ndarray:
    """As ``expand``, for many symbols: every rule is expanded once, then copied by length."""
    base = int(BASE)
    lengths: list[int] = []
    for a, b in rules.tolist():
        lengths.append((lengths[a - base] if a >= base else 1) + (lengths[b - base] if b >= base else 1))
    ends = np.cumsum(lengths, dtype=np.int64).tolist()
    flat = np.empty(ends[-1] if ends else 0, np.uint32)
    for k, (a, b) in enumerate(rules.tolist()):
        at = ends[k] - lengths[k]
        for part in (a, b):
            if part >= base:
                size, stop = lengths[part - base], ends[part - base]
                flat[at:at + size] = flat[stop - size:stop]
                at += size
            else:
                flat[at] = part
                at += 1
    inner = np.flatnonzero(symbols >= BASE)
    rule = (symbols[inner] - BASE).astype(np.int64)
    own = np.array(lengths, np.int64)[rule] if len(rule) else np.zeros(0, np.int64)
    size = np.ones(len(symbols), np.int64)
    size[inner] = own
    first = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint32)
    plain = symbols < BASE
    out[first[plain]] = symbols[plain]
    # place k of an expansion comes from place k of its rule
    step = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
    source = np.repeat(np.array(ends, np.int64)[rule] - own if len(rule) else own, own) + step
    out[np.repeat(first[inner], own) + step] = flat[source]
    return out


def shard_bytes(doc_ids: list, parts: list[bytes], end_id: int, **options) -> tuple[bytes, dict]:
    ids = np.frombuffer(b"".join(parts), "<u4")
    starts = np.r_[0, np.cumsum([len(p) // 4 for p in parts])].astype(np.uint64)
    symbols, rules, lengths = repair(ids, end_id, **options)
    reach = np.r_[0, np.cumsum(lengths_of(symbols, lengths), dtype=np.uint64)].astype(np.uint64)
    first = np.searchsorted(reach, starts).astype(np.uint64)
    absent = np.array([d is None for d in doc_ids], np.uint8)
    keys = np.array([0 if d is None else d for d in doc_ids], np.int64)
    head = HEAD.pack(b"RPTK", 1, len(rules), end_id, len(parts), len(symbols), len(ids))
    arrays = (keys, absent, first, starts, rules, lengths, symbols)
    counts = {"n_docs": len(parts), "n_ids": len(ids), "n_symbols": len(symbols), "n_rules": len(rules)}
    return head + b"".join(a.tobytes() for a in arrays), counts


class Shard:
    """A shard file that is read by document or by range of ids."""

    def __init__(self, data: bytes):
        magic, version, n_rules, self.end_id, n_docs, n_symbols, self.n_ids = HEAD.unpack_from(data)
        if magic != b"RPTK" or version != 1:
            raise ValueError("not a token shard of this version")
        at = HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        self.doc_ids, self.absent = take("<i8", n_docs), take("u1", n_docs)
        self.first, self.starts = take("<u8", n_docs + 1), take("<u8", n_docs + 1)
        self.rules, self.lengths = take("<u4", 2 * n_rules).reshape(-1, 2), take("<u4", n_rules)
        self.symbols = take("<u4", n_symbols)

    def document(self, place: int) -> np.ndarray:
        return expand(self.symbols[int(self.first[place]):int(self.first[place + 1])], self.rules)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to ``stop``; only the symbols that hold them are expanded."""
        start, stop = max(0, start), min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        place = int(np.searchsorted(self.starts, start, "right")) - 1
        last = int(np.searchsorted(self.starts, stop, "left"))
        low, high = int(self.first[place]), int(self.first[last])
        reach = int(self.starts[place]) + np.r_[0, np.cumsum(lengths_of(self.symbols[low:high], self.lengths), dtype=np.int64)]
        a, b = int(np.searchsorted(reach, start, "right")) - 1, int(np.searchsorted(reach, stop, "left"))
        out = expand(self.symbols[low + a:low + b], self.rules)
        return out[start - int(reach[a]):stop - int(reach[a])]


def write_token_shards(docs: DataFrame, folder: str, end_id: int = 2, shard_ids: int = 2_000_000,
                       tokenizer_path: str | None = None, **options) -> DataFrame:
    """Write the shards below ``folder``; returns the stored manifest, one row per shard."""
    path = tokenizer_path or default_path()
    end = np.array([end_id], "<u4").tobytes()

    def write(batches):
        from pyspark import TaskContext

        encode, number = encoder(path).encode, TaskContext.get().partitionId()
        files, root = arrow_fs.FileSystem.from_uri(folder)
        doc_ids: list = []
        parts: list[bytes] = []
        held = part = 0

        def flush() -> pa.RecordBatch:
            name = f"{root}/shard-{number:06d}-{part:06d}.rptk"
            data, counts = shard_bytes(doc_ids, parts, end_id, **options)
            own = f"{name}.{TaskContext.get().taskAttemptId()}"
            with files.open_output_stream(own) as out:
                out.write(data)
            files.move(own, name)
            return pa.RecordBatch.from_arrays([
                pa.array([name]), pa.array([number], pa.int32()), pa.array([part], pa.int32()),
                *(pa.array([counts[k]], pa.int64()) for k in ("n_docs", "n_ids", "n_symbols", "n_rules"))],
                ["shard", "partition", "part", "n_docs", "n_ids", "n_symbols", "n_rules"])

        for batch in column_batches(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text) + end
                doc_ids.append(doc_id)
                parts.append(ids)
                held += len(ids) // 4
                if held >= shard_ids:
                    yield flush()
                    doc_ids, parts, held, part = [], [], 0, part + 1
        if parts:
            yield flush()

    files, root = arrow_fs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)
    laid = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).repartitionByRange(
        "doc_id").sortWithinPartitions("doc_id")
    return spill(laid.mapInArrow(write, MANIFEST), "token_manifest")


def read_token_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document of the shards (shard, shard_start): id, start, length and checksum of the decoded ids."""

    def read(batches):
        memo_of("token_reader")
        files, _ = arrow_fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with files.open_input_file(name) as source:
                    shard = Shard(source.read())
                data = memoryview(expand_whole(shard.symbols, shard.rules).astype("<u4", copy=False).tobytes())
                edges = (4 * shard.starts).astype(np.int64).tolist()
                sums = [zlib.crc32(data[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
                n = len(sums)
                yield pa.RecordBatch.from_arrays([
                    pa.array([name] * n), pa.array(range(n), pa.int32()),
                    pa.array(shard.doc_ids, mask=shard.absent.astype(bool)),
                    pa.array(shard.starts[:-1].astype(np.int64) + before), pa.array(np.diff(shard.starts).astype(np.int64)),
                    pa.array(sums, pa.int64())],
                    ["shard", "place", "doc_id", "start", "n_tokens", "ids_crc32"])

    shards, cores = manifest.count(), manifest.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(shards, 2 * cores), -(-shards // SHARDS_PER_TASK))
    return manifest.select("shard", "shard_start").repartition(min(tasks, 20_000), "shard").mapInArrow(read, DECODED)


def token_documents(docs: DataFrame, end_id: int = 2, tokenizer_path: str | None = None,
                    **options) -> DataFrame:
    """Write ``docs`` and read them back, with each document's place in the whole output."""
    folder = fresh_folder(docs.sparkSession, "token_shards")
    manifest = write_token_shards(docs, folder, end_id, tokenizer_path=tokenizer_path, **options)
    # one row per shard of millions of ids; summed by partition first, so no window sees all shards
    totals = manifest.groupBy("partition").agg(F.sum("n_ids").alias("n"))
    before = totals.select("partition", (F.sum("n").over(Window.orderBy("partition")) - F.col("n")).alias("before"))
    within = Window.partitionBy("partition").orderBy("part")
    places = manifest.join(before, "partition").select(
        "shard", (F.col("before") + F.sum("n_ids").over(within) - F.col("n_ids")).alias("shard_start"))
    return read_token_shards(spill(places, "token_places"), folder).select(
        "doc_id", "start", "n_tokens", "ids_crc32", "shard", "place")
