from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickwarden.llm.negatives import hard_negatives, primes_for, residue_products, residues

SCHEMA = "vec_id long, embedding array<float>, label int, score long, target long, rank int"


def brute(rows, every, k_pos, k_neg, scale, share=(80, 100)) -> Counter:
    usable = [(i, [math.floor(scale * float(np.float32(x))) for x in e], label) for i, e, label in rows
              if i is not None and label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    anchors = {}
    for i, e, label in usable:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (label, e)), (label, e))
    out = Counter()
    for a, (label, e) in anchors.items():
        others = sorted((-sum(x * y for x, y in zip(e, f)), i, other == label) for i, f, other in usable if i != a)
        for place, (score, positive, _) in enumerate([r for r in others if r[2]][:k_pos]):
            fit = [r for r in others if not r[2] and share[0] * -score <= share[1] * -r[0] <= share[1] * -score][:k_neg]
            for rank, (negative, i, _) in enumerate(fit, 1):
                out[(a, positive, rank, i, -score, -negative)] += 1
    return out


def vectors(n: int, seed: int, width: int = 6) -> list[tuple]:
    r = random.Random(seed)
    rows = [(i, [r.choice([-0.5, -0.25, 0.1, 0.3, 0.5, 0.9]) for _ in range(width)], r.randrange(3)) for i in range(n)]
    rows += [(i, [0.5] * width, 1) for i in range(n, n + n // 3)]  # a hot vector
    return rows


def run(spark, rows, **options) -> Counter:
    extra = (1, 2, 3)
    df = spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA)
    found = hard_negatives(df, **options)
    return Counter(tuple(r) for r in found.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_equals_brute_force(spark):
    rows = vectors(240, 5)
    got = run(spark, rows, every=10, sample=4)
    assert got == brute(rows, 10, 5, 5, 256) and len(got) > 100


def test_odd_rows(spark):
    rows = vectors(60, 9)
    rows += [(None, [0.1] * 6, 1), (600, None, 1), (610, [0.1, None], 1), (620, [float("nan")] * 6, 0), (630, [float("inf")] * 6, 0),
             (640, [0.5] * 6, None), (650, [], 1), (660, [0.9, 0.9], 2), (10, [0.5] * 6, 2), (10, [0.5] * 6, 2), (7, [0.3] * 6, 0),
             (7, [0.3] * 6, 0), (670, [-4.0] * 6, 0), (680, [30000.5] * 9, 1), (690, [-30000.25] * 9, 2)]
    assert run(spark, rows, every=10, sample=3) == brute(rows, 10, 5, 5, 256)
    assert run(spark, [], every=10) == Counter()
    assert run(spark, [(0, [1.0], 1)], every=1) == Counter()


def test_small_slices_and_files_change_nothing(spark, monkeypatch):
    from clickwarden.llm import negatives

    rows = vectors(900, 2)
    scan = negatives.scan
    monkeypatch.setattr(negatives, "scan", lambda *a: scan(*a, slice_bytes=1, file_bytes=500))
    assert run(spark, rows, every=30, sample=8) == brute(rows, 30, 5, 5, 256)


def test_relabel(spark):
    rows = vectors(150, 3)
    changed = [(i, e, (label + 1) % 3 if i % 7 == 0 else label) for i, e, label in rows]
    relabel = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 3).otherwise(F.col("label"))
    assert run(spark, rows, every=10, relabel=relabel) == brute(changed, 10, 5, 5, 256)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.sampled_from([1, 300, 40_000, 10 ** 6, 10 ** 8]), st.integers(0, 10 ** 6))
def test_residue_products_are_exact(width, size, seed):
    r = np.random.default_rng(seed)
    a, b = r.integers(-size, size + 1, (7, width)), r.integers(-size, size + 1, (9, width))
    a[0], b[0], b[1] = size, size, -size  # the largest scores there can be
    primes = primes_for(float(size) ** 2 * width)
    exact = [[sum(x * y for x, y in zip(p, q)) for q in b.tolist()] for p in a.tolist()]
    assert residue_products(residues(a, primes), residues(b, primes), primes).tolist() == exact
