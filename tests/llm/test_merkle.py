from __future__ import annotations

import zlib
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from clickwarden.llm.merkle import merkle_manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(doc_id, text, lang, source, n_chars) -> str:
    return h("".join(map(field, (doc_id, source, lang, n_chars, text))))


def climb(nodes: list[str], keep=lambda level, nodes: None) -> str:
    while len(nodes) > 1:
        keep(nodes)
        nodes = [h("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
    return nodes[0]


def brute(rows: list[tuple]) -> Counter:
    """Every tree built whole, every leaf folded by hand."""
    byte = lambda lang: (lang is not None, (lang or "").encode())
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(*row), row))
    order = sorted(trees, key=byte)
    upper, levels = [], {}
    for lang in order:
        trees[lang].sort(key=lambda r: r[:3])
        levels[lang] = []
        upper.append(climb([r[2] for r in trees[lang]], levels[lang].append))
    tops: list[list[str]] = []
    root = climb(upper, tops.append)
    out = Counter()
    for t, lang in enumerate(order):
        for i, (_, _, own, row) in enumerate(trees[lang]):
            now = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[4] is not None:
                now = leaf(*row[:4], row[4] + 1)
            proof = ""
            for nodes, at in [*((n, i >> k) for k, n in enumerate(levels[lang])), *((n, t >> k) for k, n in enumerate(tops))]:
                run = nodes[at & ~1:(at & ~1) + 2]
                other = "".join(run[:at & 1] + run[(at & 1) + 1:])
                proof += other
                now = h(other + now if at & 1 else now + other)
            out[(row[0], own, upper[t], root, h(proof), now, now == root)] += 1
    return out


def rows_of(df) -> Counter:
    return Counter(map(tuple, df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()))


@pytest.mark.parametrize("bits", [2, 10])
def test_all_proofs_equal_whole_trees(spark, bits):
    langs = ["en", "en", "en", "de", None, "", "日本", "zé", "en"]
    rows = [(n, f"text {n}" if n % 11 else None, langs[n % 9] if n != 77 else "alone", None if n % 13 == 0 else "s:1",
             None if n % 17 == 0 else n) for n in range(1, 160)]
    rows += [(5, "again", "en", "s", 1)] * 3 + [(None, "no id", "en", "s", 2), (None, None, None, None, None), (2**60 + 1, "", "de", "", 2**63 - 1)]
    got = rows_of(merkle_manifest(spark.createDataFrame(rows, DOCS), bits))
    assert got == brute(rows)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_lone_leaves(spark):
    for rows in ([(7, "one", "en", "s", 3)], [(n, "t", f"l{n}", "s", None) for n in range(5)]):
        assert rows_of(merkle_manifest(spark.createDataFrame(rows, DOCS), 2)) == brute(rows)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    docs = odd_docs.withColumn("n_chars", F.length("text").cast("long"))
    rows = [(r[0], r[1], "en", "s", None if r[1] is None else len(r[1])) for r in odd_rows]
    assert rows_of(merkle_manifest(docs, 4)) == brute(rows)
    assert merkle_manifest(no_docs.withColumn("n_chars", F.lit(1).cast("long"))).count() == 0
