from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from clickwarden.llm import recurrent as net
from clickwarden.llm.lm_scores import key_of, lm_scores, training_rows, vocabulary, word_counts

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def tokens(text) -> list[bytes]:
    return (text or "").encode().translate(LOWER).split() + [b""]


def brute(rows) -> Counter:
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    counts: Counter = Counter()
    for i, text in rows:
        if not held(i):
            counts.update(tokens(text))
    n, v = counts.total(), len(counts)
    out: Counter = Counter()
    for i, text in rows:
        words = tokens(text)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        out[(i, held(i), len(words), sum(counts[w] > 0 for w in words), n, round(base, 5))] += 1
    return out


def check(df, rows) -> list:
    got = df.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    assert Counter((*r[:5], round(r[5], 5)) for r in got) == brute(rows)
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)
    return got


@pytest.mark.parametrize("listed", [4, 1000])
def test_base_scores_equal_brute_force(spark, odd_docs, odd_rows, listed):
    """With a list of four words nearly all words go through the join."""
    check(lm_scores(odd_docs, words=8, listed=listed, share=2, rounds=1), odd_rows)


def test_no_rows_and_no_training_rows(spark, no_docs):
    assert lm_scores(no_docs).count() == 0
    alone = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    rows = [(i, "a b a") for i in alone]
    assert {r["n_known"] for r in check(lm_scores(spark.createDataFrame(rows, "doc_id long, text string")), rows)} == {0}


def test_learns_order_of_words(spark):
    """Words follow one another in a fixed circle: the network must see that, counts can't."""
    circle = [f"w{n}" for n in range(12)]
    rows = []
    for i in range(1500):
        at = random.Random(i).randrange(12)
        rows.append((i, " ".join(circle[(at + k) % 12] for k in range(40))))
    got = check(lm_scores(spark.createDataFrame(rows, "doc_id long, text string"), words=16, share=1, rounds=3, rate=0.1), rows)
    held = [r for r in got if r["held_out"]]
    assert len(held) > 50 and sum(r["score"] for r in held) > 0.6 * sum(r["base_score"] for r in held)


def test_probabilities_sum_to_one(spark):
    rows = [(i, " ".join(f"v{random.Random(i * 50 + k).randrange(1 + k)}" for k in range(50))) for i in range(80)]
    counts = word_counts(spark.createDataFrame(rows, "doc_id long, text string"))
    vocab = vocabulary(counts, 6, 20)
    listed = [(vocab.ids[n], vocab.band[n]) for word, n in vocab.place.items() if vocab.known[n]]
    inside = Counter()
    for number, log in listed:
        inside[number] += 10 ** log
    rest = {bytes(r["word"]): r["learn"] for r in counts.collect() if r["learn"] and bytes(r["word"]) not in vocab.place}
    inside[vocab.below] += (sum(rest.values()) + 0.5 * len(rest) + 0.5) / vocab.rest_room
    assert rest and all(inside[number] == pytest.approx(1) for number in range(vocab.shape.words, vocab.below + 1))
    params = net.initial(vocab.shape, vocab.word_weights, vocab.band_weights)
    every = np.arange(vocab.shape.words + vocab.shape.bands)
    states = np.repeat(np.random.default_rng(0).standard_normal((1, vocab.shape.hidden)).astype(np.float32), len(every), 0)
    assert np.exp(net.log_probabilities(params, vocab.shape, states, every)).sum() == pytest.approx(1, abs=1e-4)


def network(seed: int = 0):
    shape, r = net.Shape(20, 2, per_class=6, hidden=5), np.random.default_rng(seed)
    params = net.initial(shape, r.random(20) + 0.1, np.array([1.0, 2.0]))
    params = {k: v + (0 if k == "word_bias" else r.standard_normal(v.shape) * 0.3) for k, v in params.items()}
    return shape, params, [r.integers(0, 22, n) for n in (7, 3, 1, 12, 2, 30)]


def one_by_one(shape, p, doc) -> float:
    """The equations written out for a single document, a token at a time."""
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    h, last, total, width = np.zeros(shape.hidden), shape.start, 0.0, shape.hidden
    for goal in doc.tolist():
        x, a = p["embed"][last] @ p["inward"] + p["inward_bias"], h @ p["gates"]
        z, r = sigmoid(x[:width] + a[:width]), sigmoid(x[width:2 * width] + a[width:2 * width])
        h = (1 - z) * np.tanh(x[2 * width:] + r * a[2 * width:]) + z * h
        kind = goal // 6 if goal < 20 else goal - 20 + 4
        logits = h @ p["class_out"] + p["class_bias"]
        total += logits[kind] - np.log(np.exp(logits).sum())
        if goal < 20:
            logits = h @ p["word_out"][kind] + p["word_bias"][kind]
            total += logits[goal % 6] - np.log(np.exp(logits).sum())
        last = goal
    return total


@pytest.mark.parametrize("count,steps", [(1, 4), (3, 5), (50, 32)])
def test_lanes_and_windows_change_nothing(count, steps):
    shape, params, docs = network()
    single = {k: v.astype(np.float32) for k, v in params.items()}
    assert net.score(single, shape, docs, count, steps) == pytest.approx([one_by_one(shape, params, d) for d in docs], abs=1e-3)


def test_gradients_equal_differences():
    shape, params, docs = network(3)
    x, y, _, _ = net.lanes(docs, 2, shape.start)
    state = np.random.default_rng(1).standard_normal((2, shape.hidden))
    _, grads, _ = net.gradients(params, shape, x, y, state)
    r = np.random.default_rng(2)
    for name in net.PARTS:
        for _ in range(4):
            at = tuple(int(r.integers(n)) for n in params[name].shape)
            change = []
            for step in (1e-3, -1e-3):
                moved = {k: v.copy() for k, v in params.items()}
                moved[name][at] += step
                change.append(net.gradients(moved, shape, x, y, state)[0])
            assert grads[name][at] == pytest.approx((change[0] - change[1]) / 2e-3, abs=1e-4), name


def test_long_words_are_held_by_digest():
    assert key_of(b"x" * 64) == b"x" * 64 and len(key_of(b"x" * 65)) == 33


def test_every_training_row_has_its_round(spark):
    import inspect

    given = {n: p.default for n, p in inspect.signature(lm_scores).parameters.items()}
    rows = spark.range(400).selectExpr("id as row", "id % 5 = 1 as held_out")
    read = [r["row"] for n in range(given["rounds"])
            for r in training_rows(rows, given["share"], given["rounds"], n).collect()]
    assert sorted(read) == [i for i in range(400) if i % 5 != 1]
