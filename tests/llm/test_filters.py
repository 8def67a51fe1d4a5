from __future__ import annotations

import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickwarden.llm import decontamination as decon
from clickwarden.llm.license_scan import base_places, detections, resolve, rules, scan_licenses, scan_text, word_line
from clickwarden.llm.quality import FEATURES, document_statistics, fit_trees, good_documents, quality_scores
from clickwarden.llm.toxicity import (
    Insults, clean_documents, clause_strength, describe, describe_at, fit_logistic, learn_insults, matched_clauses,
    toxicity_scores,
)

from .conftest import prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def base_brute(text):
    words = WORD.findall(lower(text))
    places = sorted((i, label) for phrase, label in PHRASES.items() for i in range(len(words))
                    if words[i:i + len(phrase.split())] == phrase.split())
    return len(words), places


def test_license_base_equals_brute_force(spark, odd_docs, odd_rows, no_docs):
    texts = ["CC BY cc-by CC BY", "The MIT License (MIT license)", "GNU General Public License, Apache\nLicense 2.0 apache licenses",
             "cc éby cc by", "gnu general public license" * 2, "Apache License " * 300]
    for text in [*texts, *(t for _, t in odd_rows)]:
        n, places = base_brute(text)
        got = scan_text(text)
        assert got[:2] == (n, len(places))
        assert got[2:4] == ((places[0][0], places[-1][0]) if places else (None, None))
        assert got[4] == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, got[4].split(","))) <= set(filter(None, got[5].split(","))) and 0 <= got[6] <= 1
    got = scan_licenses(odd_docs).collect()
    assert Counter((r.doc_id, r.n_words) for r in got) == Counter((d, base_brute(t)[0]) for d, t in odd_rows)
    assert scan_licenses(no_docs).count() == 0
    assert base_places(word_line("cc by cc by")[0]) == [(0, "cc-by"), (2, "cc-by")]


def test_license_resolve_equals_pairwise_comparison():
    pool = sorted(rules(), key=lambda r: r.priority)[::40]
    rng = np.random.default_rng(5)
    for _ in range(300):
        found = []
        for k, a, n in zip(rng.integers(0, len(pool), 12), rng.integers(0, 30, 12), rng.integers(1, 10, 12), strict=True):
            found.append((int(a), int(a + n), int(k), pool[k]))
        kept = []
        for a, b, order, rule in sorted(found, key=lambda d: (-d[3].priority, d[0] - d[1], d[0], d[2])):
            if not any((c <= a and b <= d) or (a < d and c < b and rule.priority < r.priority) for c, d, r in kept):
                kept.append((a, b, rule))
        assert Counter(resolve(found)) == Counter(kept)


def test_license_scan_of_five_megabytes_is_linear():
    started = time.monotonic()
    got = scan_text("see cc by terms and words " * 200_000)
    assert got[1] == 200_000 and got[2:4] == (1, 6 * 199_999 + 1) and len(got[-1]) == 200_000
    assert time.monotonic() - started < 10  # about 2 s; all pairs took over an hour



def test_license_rules_and_suppression():
    assert len(rules()) > 250
    line = word_line("Licensed under the Apache License, Version 2.0 (the 'License')")[0]
    assert [r.label for *_, r in detections(line)] == ["apache-2.0"]  # the bare title inside is suppressed
    assert [r.label for *_, r in detections(word_line("SPDX-License-Identifier: BSD-3-Clause")[0])] == ["bsd-3-clause"]
    assert detections(word_line("a license to kill")[0]) == []
    low, high = min(rules(), key=lambda r: r.priority), max(rules(), key=lambda r: r.priority)
    assert [r for *_, r in resolve([(0, 9, 0, low), (4, 6, 1, high)])] == [high]
    assert [r for *_, r in resolve([(0, 9, 0, high), (4, 6, 1, low), (20, 25, 2, low)])] == [high, low]
    every = [(m.start(), m.end(), k, r) for k, r in enumerate(rules()) for m in r.pattern.finditer(line)]
    assert resolve(every) == detections(line)  # gates and keywords lose nothing here


def edit_distance_within(pattern: bytes, text: bytes) -> int:
    row = np.zeros(len(text) + 1, int)
    for i, c in enumerate(pattern, 1):
        new = np.empty_like(row)
        new[0] = i
        for j, d in enumerate(text, 1):
            new[j] = min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1)
        row = new
    return int(row.min())


def spoil(text, seed, edits):
    r, out = random.Random(seed), list(text)
    for _ in range(edits):
        at = r.randrange(len(out))
        out[at:at + 1] = r.choice([["z"], [], [out[at], "q"]])
    return "".join(out)


@pytest.mark.parametrize("seed", range(12))
def test_leaks_equal_brute_force(seed):
    item = prose(1000 + seed, 20)
    patterns = decon.Patterns.of([(1, item)], 128, 0.06, 40)
    text = f"{prose(seed, 40)} {spoil(item, seed, seed)} {prose(seed + 50, 30)}"
    whole = decon.folded(text).tobytes()
    fits = [edit_distance_within(p.tobytes(), whole) <= e for p, e in zip(patterns.texts, patterns.budget, strict=True)]
    assert bool(decon.leaks_in(text, patterns)) == any(fits)


def test_leaks_of_rows(spark, odd_docs, odd_rows, no_docs):
    items = [(1, prose(7, 60)), (2, prose(5, 25).upper()), (3, None), (None, prose(9, 20)), (4, "too short"), (5, ""), (6, prose(99, 30))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = Counter()
    for d, t in odd_rows:
        found = [i for i, b in items if i and b and len(b) > 40 and decon.folded(b).tobytes()[:128] in decon.folded(t).tobytes()]
        want[d, len(found)] += 1
    for block_bytes in (1_000_000, 200):
        got = decon.benchmark_leaks(odd_docs, benchmark, block_bytes=block_bytes).collect()
        assert Counter((r.doc_id, r.leaks) for r in got) == want
        clean = decon.clean_documents(odd_docs, benchmark, block_bytes=block_bytes)
        assert clean.columns == odd_docs.columns and clean.count() == sum(n for (_, leaks), n in want.items() if not leaks)
    none = benchmark.limit(0)
    assert decon.benchmark_leaks(odd_docs, none).filter("leaks > 0").isEmpty()
    assert decon.benchmark_leaks(no_docs, benchmark).count() == 0 and decon.clean_documents(no_docs, benchmark).count() == 0


def test_short_items_are_found_as_whole_words(spark):
    items = [(1, "Red fox"), (2, "fox, and hen!"), (3, "e"), (4, " ... "), (5, "RED FOX"), (6, "Größe 7"), (7, "7 7"), (8, prose(3, 30))]
    texts = ["A red -- fox and hen.", "red foxes", "e", "the red", "große größe: 7", "7 7 7", "", None, "fox and hen" * 2, prose(3, 30) + " e",
             "redfox red fo x", " ".join(["red fox"] * 50_000)]
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")

    def words(text):
        return decon.folded(text).tobytes().split()

    def leaked(text):
        have = b" " + b" ".join(words(text)) + b" "
        return [i for i, t in items if words(t) and b" " + b" ".join(words(t)) + b" " in have]

    for block_bytes in (1_000_000, 10):
        got = {r.doc_id: r for r in decon.benchmark_leaks(docs, benchmark, block_bytes=block_bytes).collect()}
        for n, text in enumerate(texts):
            assert got[n].leaks == len(leaked(text)) and got[n].item_id == min(leaked(text), default=None), text
        kept = {r.doc_id for r in decon.clean_documents(docs, benchmark, block_bytes=block_bytes).collect()}
        assert kept == {n for n, text in enumerate(texts) if not leaked(text)}
    assert (got[0].edits, got[0].place) == (0, 2)


def test_filter_grows_with_its_block():
    """Few slots are taken even by a megabyte of items, so that clean texts are passed over."""
    def item(n):
        r = random.Random(n)
        return " ".join(f"{r.getrandbits(32):x}" for _ in range(12))

    big = decon.Patterns.of([(n, item(n)) for n in range(8000)], 128, 0.06, 40)
    assert big.flags.mean() <= 1 / 8 and len(big.flags) > 1 << 20
    assert decon.leaks_in(f"see {item(17)}, as said", big) == {17: (0, 4)}
    assert decon.leaks_in(item(9000), big) == {}


def test_trees_learn_and_walk_as_one_by_one():
    r = np.random.default_rng(0)
    x = r.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = fit_trees(x, y, trees=30)
    assert ((model.score(x) > 0.5) == y).mean() > 0.97

    def walk(row):
        total = model.base
        for t in range(len(model.feature)):
            node = 0
            while node < model.feature.shape[1]:
                node = 2 * node + 1 + (row[model.feature[t, node]] > model.threshold[t, node])
            total += model.leaf[t, node - model.feature.shape[1]]
        return total

    assert np.allclose(model.margin(x[:20]), [walk(row) for row in x[:20]])
    assert fit_trees(x, np.ones(len(x))).score(x).min() > 0.99 and len(document_statistics(None)) == len(FEATURES)


@pytest.fixture(scope="module")
def labelled(spark):
    """Junk is poor, insults are toxic; stems 'grob' and 'vex' are insults in every form."""
    r, rows, labels = random.Random(4), [], []
    for n in range(900):
        text = prose(n, 60)
        poor, toxic = n % 7 == 0, n % 5 == 1
        if poor:
            text = " ".join(w.upper() + "!!" for w in text.split())
        if toxic:
            words = text.split()
            for _ in range(4):
                words.insert(r.randrange(len(words)), r.choice(["grobbel", "grobtan", "vexer", "vexling", "grobster"]))
            text = " ".join(words)
        rows.append((n, text))
        if n % 3:
            labels.append((n, int(not poor), int(toxic)))
    labels += [(None, 1, 1), (5000, None, None), (1, int(1 % 7 != 0), 1)]
    return (rows, spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_quality_on_held_out_rows(labelled, odd_docs, odd_rows, no_docs):
    rows, docs, labels = labelled
    scores = {r.doc_id: r.score for r in quality_scores(docs, labels, trees=20).collect()}
    held = [n for n, _ in rows if zlib.crc32(str(n).encode()) % 5 == 0]
    assert np.mean([(scores[n] >= 0.3) == (n % 7 != 0) for n in held]) > 0.97
    assert quality_scores(odd_docs, labels.limit(0)).filter("score < 0 or score > 1 or score is null").count() == 0
    assert quality_scores(odd_docs, labels).count() == len(odd_rows) and quality_scores(no_docs, labels).count() == 0
    good = good_documents(docs, labels, trees=20)
    assert {r.doc_id for r in good.collect()} == {n for n in scores if scores[n] >= 0.3} and good.columns == docs.columns


def test_toxicity_on_held_out_rows(labelled, odd_docs, odd_rows, no_docs):
    rows, docs, labels = labelled
    got = {r.doc_id: r for r in toxicity_scores(docs, labels).collect()}
    held = [n for n, _ in rows if zlib.crc32(str(n).encode()) % 5 == 0]
    assert np.mean([(got[n].score >= 0.5) == (n % 5 == 1) for n in held]) > 0.97
    assert toxicity_scores(odd_docs, labels).count() == len(odd_rows) and toxicity_scores(no_docs, labels).count() == 0
    assert toxicity_scores(odd_docs, labels.limit(0)).filter("score > 0.01").isEmpty()
    clean = clean_documents(docs, labels)
    assert {r.doc_id for r in clean.collect()} == {n for n in got if got[n].score < 0.5}


def test_toxicity_under_one_header(labelled, spark):
    rows, docs, labels = labelled
    header = "Published by the northern garden society, all rights reserved, page one of one. "
    known = labels.filter("doc_id is not null").join(docs, "doc_id").selectExpr("doc_id", "text", "toxic as label")
    plain = learn_insults(known)
    headed = learn_insults(known.withColumn("text", F.concat(F.lit(header), "text")))
    assert {s for s in plain.weights if s.startswith(("grob", "vex"))} <= headed.weights.keys()
    assert learn_insults(known.union(known)).weights == plain.weights  # copies count once
    got = {r.doc_id: r.score for r in toxicity_scores(docs.withColumn("text", F.concat(F.lit(header), "text")), labels).collect()}
    held = [n for n, _ in rows if zlib.crc32(str(n).encode()) % 5 == 0]
    assert np.mean([(got[n] >= 0.5) == (n % 5 == 1) for n in held]) > 0.97


def test_rare_insults_count_under_even_labels(spark):
    """With as many toxic as clean rows a word of seven toxic texts is evidence, too."""
    words = [a + b + c + "ugg" for a in "bdgk" for b in "aeiou" for c in "zx"]
    rows = [(n, f"{prose(n, 20)} {words[n // 2 % 40]} {prose(n + 900, 20)}" if n % 2 else prose(n, 40), n % 2) for n in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    scores = {r.doc_id: r.score for r in toxicity_scores(docs.drop("toxic"), docs.drop("text")).collect()}
    held = [n for n, *_ in rows if zlib.crc32(str(n).encode()) % 5 == 0]
    assert np.mean([(scores[n] >= 0.5) == (n % 2 == 1) for n in held]) > 0.97


def test_cut_is_relative_to_the_mix():
    even, few = Insults({"grob": 2.0}, prior=0.0).cut_at(1.0), Insults({"grob": 2.0}, prior=2.2).cut_at(1.0)
    assert even.weight("grobbel") == 2.0 and few.weight("grobbel") == 0
    cuts = [Insults({"grob": 3.0, "vex": 1.0}).cut_at(c) for c in (0.0, 2.0)]
    for text in ("You grobbel. A vexer, fine words", "vexer", None):
        assert describe_at(text, cuts) == [*describe(text, cuts[0]), *describe(text, cuts[1])]


def test_grammar_registers():
    insults = Insults({"grob": 3.0, "grobian$": 0.1})
    plain = clause_strength("a grobbel here".split(), insults)
    assert plain == 3.0 and clause_strength(["grobian"], insults) == 0  # the whole word overrules its beginning
    assert clause_strength("you grobbel".split(), insults) > plain
    assert clause_strength("not a grobbel".split(), insults) < plain
    assert clause_strength("she said a big ugly long old grobbel".split(), insults) < plain
    assert clause_strength("i will kill you".split(), insults) > clause_strength("i will never kill you".split(), insults) > 0
    assert clause_strength("kill the engine".split(), insults) == 0
    assert matched_clauses("Fine words. You Grobbel! Kill him", insults)[0][0] == "you grobbel"
    assert matched_clauses(None, insults) == [] and matched_clauses("", insults) == []


def test_logistic():
    x = np.random.default_rng(1).normal(size=(500, 2))
    w, b = fit_logistic(x, (x[:, 0] > 0).astype(float))
    assert (((x @ w + b) > 0) == (x[:, 0] > 0)).mean() > 0.98
