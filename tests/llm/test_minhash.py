from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from clickwarden.llm.components import components
from clickwarden.llm.minhash import first_of_groups, near_duplicates, ranked_ring, shingle_hashes, signature

from .conftest import prose


def sets_of(rows):
    out = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        out.setdefault(d, []).append(frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    return out


def brute(rows):
    sets = {d: s for d, s in sets_of(rows).items() if d is not None}
    top = {d: d for d in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = find(a), find(b)
                top[max(p, q)] = min(p, q)
    return {d: find(d) for d in sets}


def edited(text, seed, edits):
    r, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[r.randrange(len(words))] = f"new{r.randrange(999)}"
    return " ".join(words)


def check(docs, rows):
    want, sizes = brute(rows), {d: {len(x) for x in s} for d, s in sets_of(rows).items()}
    got = near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_shingles in sizes[r.doc_id]
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id] and r.kept == (r.doc_id == want[r.doc_id])


def test_odd_rows(odd_docs, odd_rows):
    check(odd_docs, odd_rows)


def test_near_copies_chains_and_shared_passages(spark):
    base, rows = prose(1, 150), []
    rows += [(n, edited(base, n, 2)) for n in range(60)]
    chain = prose(2, 120)
    for n in range(60, 90):
        chain = edited(chain, n, 2)
        rows.append((n, chain))
    passage = prose(3, 80)
    rows += [(n, f"{passage} {prose(n, 60)}") for n in range(90, 150)]
    rows += [(n, prose(n, 30)) for n in range(150, 180)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(docs, rows)
    want = brute(rows)
    for small in (2, 8):  # buckets above this size are dealt again
        got = near_duplicates(docs, small_bucket=small).collect()
        assert {r.doc_id: r.component_id for r in got} == want


def test_one_row_of_each_group_stays(odd_docs, odd_rows, no_docs):
    kept = first_of_groups(odd_docs)
    assert kept.columns == odd_docs.columns
    want = brute(odd_rows)
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({d for d, c in want.items() if d == c})
    assert ids.count(None) == sum(d is None for d, _ in odd_rows)
    assert near_duplicates(no_docs).count() == 0 and first_of_groups(no_docs).count() == 0


def test_signature_is_circulant():
    h = shingle_hashes(prose(4, 400))
    ring, places = ranked_ring(16), (h >> np.uint64(46)).astype(int)
    assert signature(h, 16).tolist() == [min(ring[p + k] for p in places) for k in range(16)]


@pytest.mark.parametrize("seed", range(4))
def test_components(spark, seed):
    r = random.Random(seed)
    pairs = [(r.randrange(60), r.randrange(60)) for _ in range(40)] + [(n, n + 1) for n in range(100, 160)]
    top = defaultdict(set)
    for a, b in pairs:
        if a != b:
            group = top[a] | top[b] | {a, b}
            for x in group:
                top[x] = group
    got = {x.node: x.component for x in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: min(g) for x, g in top.items() if g}
