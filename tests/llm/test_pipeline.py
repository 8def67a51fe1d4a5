from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from clickwarden.llm import decontamination as decon
from clickwarden.llm import quality, queries, toxicity
from clickwarden.llm.tokens import default_path, encoder

from .conftest import prose
from .test_minhash import brute, edited

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Small tables with junk, insults, copies, near copies and benchmark items."""
    r, docs, labels, items = random.Random(2), [], [], [(n, prose(5000 + n, 22)) for n in range(8)]
    for n in range(600):
        text = prose(n, 50)
        poor, toxic = n % 7 == 0, n % 6 == 1
        if poor:
            text = " ".join(w.upper() + "!!" for w in text.split())
        if toxic:
            words = text.split()
            for _ in range(4):
                words.insert(r.randrange(len(words)), r.choice(["grobbel", "grobtan", "vexer", "vexling"]))
            text = " ".join(words)
        if n % 19 == 3:
            text = f"{prose(n, 10)} {items[n % 8][1]} {text}"
        docs.append((n, text))
        if n % 2:
            labels.append((n, int(not poor), int(toxic)))
    docs += [(1000 + n, docs[2 + 3 * (n % 9)][1]) for n in range(60)]
    docs += [(2000 + n, edited(docs[5][1], n, 1)) for n in range(20)]
    docs += [(3000, None), (3001, ""), (None, prose(77, 40)), (5, docs[5][1])]
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in docs], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, docs, items


def test_pipeline_equals_one_document_at_a_time(spark, tables):
    folder, docs, items = tables
    frame = lambda rows: spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], SCHEMA)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "toxicity", "near_dedup", "decontamination", "packing"]

    trees = quality.fit_quality(frame(docs), labels)
    good = [(d, t) for d, t in docs if trees.score(np.array([quality.document_statistics(t)]))[0] >= 0.3]
    grammar = toxicity.fit_grammar(frame(good), labels)
    civil = [(d, t) for d, t in good if grammar.score(np.array([toxicity.describe(t, grammar.insults)]))[0] < 0.5]
    groups, kept, seen = brute(civil), [], set()
    for d, t in civil:
        if d is None or groups[d] == d and d not in seen:
            kept.append((d, t))
            seen.add(d)
    patterns = decon.Patterns.of(items, 128, 0.06, 40)
    clean = [(d, t) for d, t in kept if not decon.leaks_in(t, patterns)]
    assert len(docs) > len(good) > len(civil) > len(kept) > len(clean) > 100

    rows = frame(docs)
    for name, want in (("quality", good), ("toxicity", civil), ("near_dedup", kept), ("decontamination", clean)):
        rows = stages[name](spark, rows, folder)
        assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert sorted((r.doc_id or -1, r.text or "") for r in rows.collect()) == sorted((d or -1, t or "") for d, t in want), name

    packed = corpus_pipeline.run(spark, folder).collect()
    e, end = encoder(default_path()), np.array([0], "<u4").tobytes()
    assert sorted((r.doc_id or -1, r.length, r.ids_crc32) for r in packed) == sorted(
        (d or -1, len(e.encode(t) + end) // 4, zlib.crc32(e.encode(t) + end)) for d, t in clean)


def test_stages_on_empty_tables(spark, tables, tmp_path):
    folder, _, _ = tables
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES) and corpus_pipeline.ORACLE_SQL is None
