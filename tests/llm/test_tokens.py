from __future__ import annotations

import sys
import tempfile
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickwarden.llm import minhash, tokens
from clickwarden.llm.common import memo_of
from clickwarden.llm.packing import best_fit_decreasing, pack
from clickwarden.llm.repair import Shard, expand, expand_whole, repair, shard_bytes, token_documents
from clickwarden.llm.tokens import default_path, encoder


def ids_of(text, end):
    whole = encoder(default_path()).whole(text) if text else b""
    return whole + np.array([end], "<u4").tobytes()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(
    ["Don't", "stop", "a.", "b,", "Über", "é", "İx", "\x1c", "\x85", "　", " ", "  ", "\n", "<|endoftext|>", "<|ENDOFTEXT|>",
     "1234", "½", "x_y", "日本", "é", "'s", "...", "~", "\x01", "A.B", "ª"]), max_size=12), st.sampled_from(["", " "]))
def test_chunks_equal_whole_texts(parts, between):
    e, text = encoder(default_path()), between.join(parts)
    assert e.encode(text) == (e.whole(text) if text else b"")


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    e = encoder(default_path())
    assert e.encode(text) == (e.whole(text) if text else b"")


def test_best_fit_takes_the_tightest_bin():
    bins, offsets = best_fit_decreasing(np.array([7, 6, 3, 4, 10]), 10)
    assert bins[4] not in bins[:4] and bins[0] == bins[2] and bins[1] == bins[3]
    assert offsets.tolist() == [0, 0, 7, 6, 0]


def naive_best_fit(lengths, capacity):
    rooms = []
    for need in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= need]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - need)
        else:
            rooms.append(capacity - need)
    return len(rooms)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_best_fit_equals_naive(lengths):
    bins, offsets = best_fit_decreasing(np.array(lengths, np.int64), 50)
    assert len(set(bins.tolist())) == naive_best_fit(lengths, 50)
    for b in set(bins.tolist()):
        mine = sorted((offsets[i], lengths[i]) for i in np.flatnonzero(bins == b))
        assert mine[0][0] == 0 and all(a + n == c for (a, n), (c, _) in zip(mine, mine[1:], strict=False))
        assert mine[-1][0] + mine[-1][1] <= 50


def test_pack_odd_rows(odd_docs, odd_rows, no_docs):
    got = pack(odd_docs, capacity=256, group_pieces=40).collect()
    want = Counter()
    for d, t in odd_rows:
        ids = ids_of(t, 0)
        for k in range(0, len(ids), 1024):
            part = ids[k:k + 1024]
            want[d, k // 1024, k // 4, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert ends.get(r.sequence_id, 0) == r.offset
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 256
    assert pack(no_docs).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([1, 1, 1, 5, 6, 7]), max_size=60), min_size=1, max_size=8), st.integers(2, 5))
def test_repair_round_trip(docs, least):
    parts = [np.array([*d, 2], "<u4").tobytes() for d in docs]
    data, counts = shard_bytes(list(range(len(docs))), parts, 2, least=least, pairs_per_round=4)
    shard, flat = Shard(data), b"".join(parts)
    assert counts["n_ids"] == len(flat) // 4
    assert [shard.document(k).tobytes() for k in range(len(docs))] == parts
    assert expand(shard.symbols, shard.rules).tobytes() == flat == expand_whole(shard.symbols, shard.rules).tobytes()
    for a in range(0, counts["n_ids"], 3):
        assert shard.ids(a, a + 5).tobytes() == flat[4 * a:4 * a + 20]


def test_repair_shortens_repeats():
    ids = np.array(([3, 4, 5, 6] * 200 + [2]) * 3, np.uint32)
    symbols, rules, lengths = repair(ids, 2, least=4)
    assert len(symbols) < len(ids) / 8 and lengths.max() >= 8 and len(rules) == len(lengths)


def test_repair_ends_when_no_pair_is_frequent():
    rng = np.random.default_rng(3)
    passage = rng.integers(3, 40_000, 700)
    ids = np.concatenate([np.r_[rng.integers(3, 900, 300), passage, 2] for _ in range(80)]).astype(np.uint32)
    symbols, rules, lengths = repair(ids, 2)
    assert (expand_whole(symbols, rules) == ids).all()
    pairs = Counter((a, b) for a, b in zip(symbols.tolist(), symbols[1:].tolist(), strict=False) if 2 not in (a, b))
    assert max(pairs.values()) < 32
    assert lengths.max() >= 512  # a passage that repeats becomes a few symbols


def test_token_documents_odd_rows(odd_docs, odd_rows, no_docs):
    got = token_documents(odd_docs, shard_ids=3000).collect()
    assert sorted((r.doc_id is not None, r.doc_id, r.n_tokens, r.ids_crc32) if r.doc_id is not None else (False, 0, r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (d is not None, d or 0, len(ids_of(t, 2)) // 4, zlib.crc32(ids_of(t, 2))) for d, t in odd_rows)
    at, last = 0, None
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and (last is None or r.doc_id >= last)
        at, last = at + r.n_tokens, r.doc_id
    assert token_documents(no_docs).count() == 0


def test_scratch_is_not_needed_to_read_a_shard(tmp_path):
    parts = [ids_of("hello world", 2)]
    data, _ = shard_bytes([9], parts, 2)
    with tempfile.TemporaryFile(dir=tmp_path) as f:
        f.write(data)
        f.seek(0)
        shard = Shard(f.read())
    assert shard.doc_ids.tolist() == [9] and shard.document(0).tobytes() == parts[0]


def test_the_memo_fills_its_table():
    """More chunks would double the dict's table, fewer are forgotten although there is room."""
    held = dict.fromkeys(range(tokens.MOST_CHUNKS))
    size = sys.getsizeof(held)
    held.update(dict.fromkeys(range(tokens.MOST_CHUNKS + 20_000)))
    assert tokens.encoder(tokens.default_path()).max_chunks == tokens.MOST_CHUNKS
    assert sys.getsizeof(held) > size == sys.getsizeof(dict.fromkeys(range(tokens.MOST_CHUNKS - 400_000)))


def test_a_task_reads_several_of_many_shards(spark):
    rows = [(i, "one two three") for i in range(100)]
    cores = spark.sparkContext.defaultParallelism
    out = token_documents(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), shard_ids=1)
    assert out.rdd.getNumPartitions() == max(2 * cores, 25) and out.count() == 100


def test_a_worker_keeps_the_memo_of_one_operator():
    """In a job of several operators a Python worker held the memos of all of them."""
    encoder = tokens.encoder(tokens.default_path())
    encoder.encode("some words")
    memo_of("tokens")
    assert encoder.memo
    memo_of("minhash", minhash._forget)
    assert not encoder.memo and not encoder.older
    minhash.shingle_hashes("some words")
    assert encoder.encode("some words") and tokens.encoder(tokens.default_path()).memo
    assert not minhash._words


def test_a_full_memo_keeps_what_is_met_again():
    encoder, asked = tokens.ChunkEncoder(tokens.default_path(), 40), []
    words = encoder.encode_words
    encoder.encode_words = lambda found: asked.extend(found) or words(found)
    texts = ["usual words " + " ".join(f"rare{chr(97 + i % 26)}{chr(97 + k)}," for k in range(9)) for i in range(40)]
    assert [encoder.encode(t) for t in texts] == [encoder.whole(t) for t in texts]
    assert asked.count("usual") == asked.count("words") == 1
    assert len(encoder.memo) + len(encoder.older) <= 40


@pytest.mark.parametrize("text", [
    "done... done.%%% It's$$$ it'%%% A1%%% a+b=c; $$$ x$$$y (x) <|endoftext|> <|endoftext|>. <|x|>! e\u0301!? \u00df## \u03a3. \u00bd%",
    "a'$$$'s 's's' don't!! WON'T?! caf\u00e9*** na\u00efve,., 12%% 1.2.3.", "\u7f8e\u3002 \u0130.. \u01c5!! \u2126$ 3\u20ac$ \u0130. \u0958, \ufb1d.."])
def test_closing_punctuation_is_encoded_for_itself(text):
    encoder = tokens.ChunkEncoder(tokens.default_path())
    assert encoder.encode(text) == encoder.whole(text) and encoder.encode(text) == encoder.whole(text)
