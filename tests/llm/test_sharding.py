from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from clickwarden.llm.kd_shards import DIMENSIONS, TIE_BITS, kd_leaves, kd_shards, narrow


def test_odd_rows(odd_docs, odd_rows):
    got = kd_shards(odd_docs, shards=3).collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in odd_rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sizes_near_equal_with_a_hot_source(spark):
    rows = [(n, "w" * (1 + n * 7919 % 400), "hot" if n % 3 else f"s{n % 11}", "en") for n in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    sizes = Counter()
    for r in kd_shards(docs, shards=7).collect():
        sizes[r.shard] += r.size
    assert sorted(sizes) == list(range(7))
    assert max(sizes.values()) - min(sizes.values()) < 0.03 * sum(sizes.values()) / 7


def test_equal_rows_are_cut_too(spark):
    docs = spark.createDataFrame([(5, "same text")] * 4000, "doc_id long, text string")
    counts = Counter(r.shard for r in kd_shards(docs, shards=4).collect())
    assert max(counts.values()) < 1.05 * min(counts.values())


def test_target_bytes_and_empty(spark, no_docs):
    docs = spark.createDataFrame([(n, "abc" * 33) for n in range(50)], "doc_id long, text string")
    assert len({r.shard for r in kd_shards(docs, target_bytes=1000).collect()}) == 5
    assert kd_shards(no_docs, shards=8).count() == 0


def _split(rows: list, count: int, first: int, total: list, out: dict) -> None:
    """The tree by sorting: every node along its widest dimension, at the weighted median."""
    if count == 1 or not rows:
        out.update({r["k_doc_id"]: first for r in rows})
        return

    def spread(part: list, d: str) -> int:
        values = [r[f"k_{d}"] >> TIE_BITS for r in part]
        return max(values) - min(values)

    dim = max(DIMENSIONS, key=lambda d: spread(rows, d) / max(1, spread(total, d)))
    rows = sorted(rows, key=lambda r: r[f"k_{dim}"])
    goal, before, at = round(sum(r["size"] for r in rows) * (count // 2) / count), 0, 0
    while before + rows[at]["size"] < goal:
        before, at = before + rows[at]["size"], at + 1
    if (goal - before) * 2 >= rows[at]["size"]:
        at += 1
    _split(rows[:at], count // 2, first, total, out)
    _split(rows[at:], count - count // 2, first + count // 2, total, out)


def test_leaves_equal_a_tree_built_by_sorting(spark):
    rows = [(n * n % 7001, "w" * (1 + n * 7919 % 400), f"s{n * n % 7}", ("en", "de", None)[n % 3]) for n in range(900)]
    keys = narrow(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"))
    every = [r.asDict() for r in keys.collect()]
    want: dict = {}
    _split(every, 6, 0, every, want)
    assert len(want) == len(every)  # keys differ
    assert {r.k_doc_id: r.shard for r in kd_leaves(keys, 6, tolerance=0.0).collect()} == want


def test_each_cut_divides_one_text_at_most(spark):
    rows = [(n, "hot" if n % 3 == 0 else f"text {n * n % 1009}", f"s{n % 11}", "en") for n in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    shards = defaultdict(set)
    for r in kd_shards(docs, shards=8).collect():
        shards[r.text_crc32].add(r.shard)
    assert sum(len(s) > 1 for s in shards.values()) <= 7
    assert len(shards[zlib.crc32(b"hot")]) > 1
