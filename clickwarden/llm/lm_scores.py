"""Log probabilities of whole documents under a recurrent language model of the corpus.

Words are runs of anything but ASCII white space, A-Z lower-cased, held as bytes; every
document ends in one end token. Words over 64 bytes are held by their SHA-256.

1. Words are counted over all documents, in the tasks first and then by Spark, for the training
   rows and for all rows. Histograms of the counts (512 bins at most) choose the words that the
   tasks look up by themselves: at most ``listed`` by training count, and as many by count over
   all rows, so that no word outside the list can be a hot key of the join in step 5.
2. The ``words`` commonest training words get outputs of the network. The other listed training
   words form frequency bands, all words below the list one more, which has room for one
   unseen word. Within a band a word has its share of the band's counts. So every text has a
   proper probability: class from the network, word from the network or from the counts.
3. Every document becomes ids of two bytes a token, sums over its listed words, and a list
   of the other words with their numbers, in a stored table.
4. The network is trained where the ids lie: in every round each task reads its share of the
   training documents chosen for it, from the common weights, by truncated backpropagation;
   the weights are averaged by tokens in two steps in Spark. The rounds together read every training row
   once, or one in ``share`` where a larger ``share`` is asked for (by hash of the row). The driver
   holds one network (0.3 MB) and the list of words.
5. Tasks score every document whole, in lanes of many documents. The words that were not looked
   up join the counts, and sums per document complete both scores.

A null text is empty: one end token. A null doc_id counts as a training row. Rows that repeat
are scored each, extra columns are ignored, and an empty table gives no rows. Without training
rows every word is unseen.
"""

from __future__ import annotations

from collections import Counter
from hashlib import sha256
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickwarden.llm.common import column_batches, crc_of_id, spill
from clickwarden.llm.recurrent import Shape, Trainer, flat, initial, score, unflat

END = b""
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
LONGEST = 64
BANDS = (4, 16, 64)  # band edges as multiples of the network's words, by rank
ENCODED = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()),
    ("band", pa.float64()), ("others", pa.int64()), ("ids", pa.binary()),
    ("rest", pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))),
])


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text; ``bytes.split`` cuts at just the six ASCII blanks."""
    return text.translate(LOWER).split() if text else []


def key_of(word: bytes) -> bytes:
    return word if len(word) <= LONGEST else b"\0" + sha256(word).digest()


def held_out_rows(fold: int = 1, folds: int = 5) -> Column:
    return F.coalesce(crc_of_id() % folds == fold, F.lit(False))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out_rows().alias("held_out"),
                       F.col("text").cast("binary").alias("text"))


def word_counts(docs: DataFrame, most: int = 300_000) -> DataFrame:
    """word, its number in the training rows (``learn``) and in all rows (``every``)."""
    def count(batches):
        seen = Counter(), Counter()  # training rows, held-out rows

        def rows():
            for held, counter in enumerate(seen):
                short = Counter()
                for word, n in counter.items():
                    short[key_of(word)] += n
                items = iter(short.items())
                while part := list(islice(items, 20_000)):
                    n = pa.array([n for _, n in part], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([w for w, _ in part], pa.binary()), pa.array(np.zeros(len(part), np.int64)) if held else n, n],
                        ["word", "learn", "every"])
                counter.clear()

        for batch in batches:
            for small in column_batches([batch], 200):
                for held, text in zip(small.column(0).to_pylist(), small.column(1).to_pylist()):
                    words = words_of(text)
                    for at in range(0, len(words), 100_000):
                        seen[held].update(words[at:at + 100_000])
                        if len(seen[0]) + len(seen[1]) > most:
                            yield from rows()
                    seen[held][END] += 1
        yield from rows()

    found = _texts(docs).select("held_out", "text").mapInArrow(count, "word binary, learn long, every long")
    return spill(found.groupBy("word").agg(F.sum("learn").alias("learn"), F.sum("every").alias("every")), "lm_words")


def _bin(column: str) -> Column:
    return F.floor(F.log2(F.col(column)) * 8).cast("int")


def _lowest_bin(counts: DataFrame, column: str, most: int) -> int:
    """The lowest bin of counts such that at most ``most`` words lie in it or above."""
    bins = counts.filter(F.col(column) > 0).groupBy(_bin(column).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    total, lowest = 0, 1 << 20
    for row in sorted(bins, key=lambda r: -r["b"]):
        total += row["n"]
        if total > most:
            break
        lowest = row["b"]
    return lowest


class Vocabulary:
    """The listed words with their ids and logarithms, and what is needed for the others."""

    def __init__(self, rows: list[tuple[bytes, int, int]], learn_bin: int, tokens: int, distinct: int, words: int):
        """``rows``: word, training count, bin of it; ``tokens`` and ``distinct`` of the training rows."""
        self.tokens, self.distinct = tokens, distinct
        learned = sorted((r for r in rows if r[1] and (r[2] >= learn_bin or r[0] == END)), key=lambda r: (-r[1], r[0]))
        own = [r for r in learned if r[0] != END][:words - 1]
        own = sorted([*own, (END, *next(((r[1], r[2]) for r in rows if r[0] == END), (0, 0)))], key=lambda r: (-r[1], r[0]))
        mine = {r[0] for r in own}
        tail = [r for r in learned if r[0] not in mine]
        edges = [0, *(m * words for m in BANDS), len(tail)]
        bands = [tail[a:b] for a, b in zip(edges, edges[1:]) if tail[a:b]]
        self.shape = Shape(len(own), len(bands) + 1)
        self.below = len(own) + len(bands)  # id of the words below the list
        self.rest_tokens = tokens - sum(r[1] for r in learned)
        self.rest_room = self.rest_tokens + 0.5 * (distinct - len(learned) + 1) if tokens else 0.5
        self.room = tokens + 0.5 * (distinct + 1)
        self.word_weights = np.array([r[1] + 0.5 for r in own])
        self.band_weights = np.array([sum(r[1] + 0.5 for r in b) for b in bands] + [self.rest_room])
        ids, inside = {r[0]: n for n, r in enumerate(own)}, {}
        for number, band in enumerate(bands):
            for r in band:
                ids[r[0]], inside[r[0]] = len(own) + number, np.log10((r[1] + 0.5) / self.band_weights[number])
        for r in rows:
            if r[0] not in ids:
                ids[r[0]], inside[r[0]] = self.below, np.log10((r[1] + 0.5) / self.rest_room)
        counts = {END: 0, **{r[0]: r[1] for r in rows}}
        self.place = {word: n for n, word in enumerate(ids)}
        self.ids = np.array([*ids.values(), self.below], np.uint16)  # the last entry stands for all other words
        self.known = np.array([counts[w] > 0 for w in ids] + [False])
        self.base = np.array([np.log10((counts[w] + 0.5) / self.room) for w in ids] + [0.0])
        self.band = np.array([inside.get(w, 0.0) for w in ids] + [0.0])


def vocabulary(counts: DataFrame, words: int, listed: int) -> Vocabulary:
    learn_bin, every_bin = (_lowest_bin(counts, c, listed) for c in ("learn", "every"))
    sums = counts.agg(F.sum("learn").alias("n"), F.count_if(F.col("learn") > 0).alias("v")).first()
    rare = F.when(F.col("learn") > 0, _bin("learn")).otherwise(-1)
    # at most 2 * listed + 1 words of at most 64 bytes
    rows = counts.filter((rare >= learn_bin) | (_bin("every") >= every_bin) | (F.octet_length("word") == 0)).select(
        "word", "learn", rare.alias("bin")).toLocalIterator()
    return Vocabulary([(bytes(r[0]), r[1], r[2]) for r in rows], learn_bin, sums["n"] or 0, sums["v"] or 0, words)


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """The stored table of step 3; ``row`` numbers the rows."""
    def rows(batches):
        place, miss = vocab.place, len(vocab.place)
        for batch in batches:
            for small in column_batches([batch], 500):
                out: dict[str, list] = {name: [] for name in ENCODED.names if name != "rest"}
                others, numbers, ends = [], [], [0]
                for doc_id, held, text in zip(*(c.to_pylist() for c in small.columns)):
                    words = words_of(text)
                    words.append(END)
                    at = np.array([place.get(w, miss) for w in words])
                    rest: Counter = Counter()
                    missed = np.flatnonzero(at == miss).tolist()
                    found = [words[i] for i in missed]
                    if found and len(max(found, key=len)) > LONGEST:
                        found = [key_of(w) for w in found]
                        at[missed] = [place.get(w, miss) for w in found]
                        found = [w for w in found if w not in place]
                    rest.update(found)
                    others += rest.keys()
                    numbers += rest.values()
                    ends.append(len(others))
                    out["doc_id"].append(doc_id)
                    out["held_out"].append(held)
                    out["n_tokens"].append(len(words))
                    out["known"].append(int(vocab.known[at].sum()))
                    out["base"].append(float(vocab.base[at].sum()))
                    out["band"].append(float(vocab.band[at].sum()))
                    out["others"].append(rest.total())
                    out["ids"].append(vocab.ids[at].tobytes())
                pairs = pa.StructArray.from_arrays([pa.array(others, pa.binary()), pa.array(numbers, pa.int64())], ["word", "n"])
                arrays = [pa.array(out[f.name], f.type) for f in ENCODED if f.name != "rest"]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)], names=ENCODED.names)

    schema = ("doc_id long, held_out boolean, n_tokens long, known long, base double, band double, others long, ids binary, "
              "rest array<struct<word: binary, n: long>>")
    return spill(_texts(docs).mapInArrow(rows, schema).withColumn("row", F.monotonically_increasing_id()), "lm_encoded")


def _buffers(batches, column: str, tokens: int):
    """Lists of batches with about so many tokens, or one longer document."""
    held, size = [], 0
    for small in column_batches(batches, 50):
        held.append(small)
        size += (pc.sum(pc.binary_length(small.column(small.schema.get_field_index(column)))).as_py() or 0) // 2
        if size >= tokens:
            yield held
            held, size = [], 0
    if held:
        yield held


def _documents(held: list[pa.RecordBatch]) -> list[np.ndarray]:
    return [np.frombuffer(v.as_py(), np.uint16).astype(np.int64) for b in held for v in b.column(b.schema.get_field_index("ids"))]


def mean_weights(rows: DataFrame) -> DataFrame:
    """Means of the weights by tokens, part by part: first within groups of tasks, then of all."""
    def mean(part: pd.DataFrame) -> pd.DataFrame:
        stack = np.stack([np.frombuffer(v, np.float32) for v in part["weights"]]).astype(np.float64)
        total = part["tokens"].to_numpy()
        return pd.DataFrame({"part": part["part"].iloc[:1].tolist(), "team": [0], "tokens": [int(total.sum())],
                             "weights": [np.average(stack, axis=0, weights=total).astype(np.float32).tobytes()]})

    schema = "part int, team int, tokens long, weights binary"
    return rows.groupBy("part", "team").applyInPandas(mean, schema).groupBy("part").applyInPandas(mean, schema)


def training_rows(encoded: DataFrame, share: int, rounds: int, number: int) -> DataFrame:
    """The training rows of one round; with a ``share`` of 1 every row has its round."""
    mine = F.pmod(F.xxhash64("row"), F.lit(share * rounds)) == number
    return encoded.filter(~F.col("held_out") & mine)


def train(encoded: DataFrame, vocab: Vocabulary, share: int, rounds: int, rate: float, teams: int = 64,
          parts: int = 16, buffer_tokens: int = 200_000) -> np.ndarray:
    """Flat weights of the network after all rounds."""
    shape = vocab.shape
    weights = flat(initial(shape, vocab.word_weights, vocab.band_weights))
    for number in range(rounds):
        chosen = training_rows(encoded, share, rounds, number).select("ids")

        def learn(batches, common=weights, speed=rate / (1 + number)):
            trainer = Trainer(unflat(common, shape), shape, speed)
            for held in _buffers(batches, "ids", buffer_tokens):
                trainer.read(_documents(held))
            if trainer.tokens:
                team = TaskContext.get().partitionId() % teams
                for part, values in enumerate(np.array_split(flat(trainer.p), parts)):
                    yield pa.RecordBatch.from_pydict({
                        "part": pa.array([part], pa.int32()), "team": pa.array([team], pa.int32()),
                        "tokens": pa.array([trainer.tokens], pa.int64()), "weights": pa.array([values.tobytes()], pa.binary())})

        learned = mean_weights(chosen.mapInArrow(learn, "part int, team int, tokens long, weights binary")).collect()
        if learned:
            weights = np.concatenate([np.frombuffer(r["weights"], np.float32) for r in sorted(learned, key=lambda r: r["part"])])
    return weights


def network_scores(encoded: DataFrame, vocab: Vocabulary, weights: np.ndarray, buffer_tokens: int = 1_000_000) -> DataFrame:
    """``network``: log10 of the network's part of every row's probability."""
    shape, kept = vocab.shape, ["row", "doc_id", "held_out", "n_tokens", "known", "base", "band", "others"]

    def rows(batches):
        params = unflat(weights, shape)
        for held in _buffers(batches, "ids", buffer_tokens):
            total = score(params, shape, _documents(held)) / np.log(10)
            at = 0
            for b in held:
                part, at = total[at:at + b.num_rows], at + b.num_rows
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(b.schema.get_field_index(c)) for c in kept), pa.array(part)], [*kept, "network"])

    return encoded.select(*kept, "ids").mapInArrow(
        rows, "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, band double, others long, "
              "network double")


def lm_scores(docs: DataFrame, words: int = 1024, listed: int = 131_072, share: int = 1, rounds: int = 4,
              rate: float = 0.02) -> DataFrame:
    """Unigram and network log10 probabilities of every document; the model learns from the rows
    that are not held out."""
    counts = word_counts(docs)
    vocab = vocabulary(counts, words, listed)
    encoded = encode(docs, vocab)
    weights = train(encoded, vocab, share, rounds, rate)
    room, rest_room = F.lit(vocab.room), F.lit(vocab.rest_room)
    pairs = encoded.select("row", F.inline("rest"))
    log = F.log10(F.col("learn") + 0.5)
    found = pairs.join(counts.filter("learn > 0").select("word", "learn"), "word").groupBy("row").agg(
        F.sum("n").alias("_known"), F.sum(F.col("n") * log).alias("_log"))
    scored = network_scores(encoded, vocab, weights).join(found, "row", "left")
    known = F.coalesce("_known", F.lit(0))
    # words outside the list: those found in the counts, and the unseen ones
    logs = F.coalesce("_log", F.lit(0.0)) + (F.col("others") - known) * F.log10(F.lit(0.5))
    return scored.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + known).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("others") * F.log10(room)).alias("base_score"),
        (F.col("network") + F.col("band") + logs - F.col("others") * F.log10(rest_room)).alias("score"))
