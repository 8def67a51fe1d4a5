from __future__ import annotations

import gzip
import hashlib
import io
import math
import random
from collections import Counter

import pytest

from clickwarden.llm.topk import top_inner_products
from clickwarden.llm.warc import (
    archive_pages, archived_pages, gzip_member, page_records, read_archive, read_gzip_records, read_records, record_bytes,
)

PAGES = "page_id long, url string, html string, payload string, kept long, n long"


def page_rows():
    big, other = "<p>café</p>" * 200, "y" * 1000
    rows = [(n, f"http://x/{n}", big) for n in range(1, 30)]
    rows += [(40, "http://x/ä b\r\nWARC-Type: fake", other), (41, None, other), (42, "u", "z" * 999), (43, "u", "z" * 999),
             (44, "u", None), (45, "u", ""), (46, "u", "WARC/1.1\r\n\r\n" * 200), (None, "u", big), (47, "u", "a\r\n\r\nb"), (48, "u", "q" * 300_000)]
    rows += [(49, "u", "r" * 2000), (49, "u", "r" * 2000)]
    return rows


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame([(*r, "c", 5, 6) for r in page_rows()], PAGES)


def expected():
    rows, kept = page_rows(), {}
    for p, _, h in rows:
        data = (h or "").encode()
        if len(data) >= 1000 and p is not None:
            kept[data] = max(p, kept.get(data, p))
    out = Counter()
    for p, _, h in rows:
        data = (h or "").encode()
        again = data in kept and p != kept[data]
        out[p, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", kept[data] if again else None] += 1
    return out


def test_round_trip(pages):
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in archived_pages(pages).collect())
    assert got == expected()


def test_only_pages_without_payloads_and_one_payload_a_digest_are_shuffled(pages):
    plan = page_records(pages)._jdf.queryExecution().executedPlan().toString()
    joined = plan.split("Join", 1)[1]
    assert "partial_first(payload" in joined and "partial_max(page_id" in joined
    assert page_records(pages).filter("record_type = 'revisit' and payload is not null").isEmpty()


def test_pushed_predicates_and_payloads(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/w"
    archive_pages(pages, folder)
    responses = read_archive(spark, folder, verify="true").filter("record_type = 'response'")
    plan = responses._jdf.queryExecution().toString()
    assert "Filter (record_type" not in plan.split("== Physical Plan ==")[1]
    texts = {(h or "").encode() for _, _, h in page_rows()}
    assert {bytes(r.payload) for r in responses.collect()} == texts
    heads = read_archive(spark, folder, payload="false").filter("record_id in ('urn:page:48', 'urn:page:1')").collect()
    assert {(r.record_id, r.payload_bytes, r.payload) for r in heads} == {
        ("urn:page:48", 300_000, None), ("urn:page:1", len("<p>café</p>".encode()) * 200, None)}
    with pytest.raises(Exception, match="appended"):
        pages.selectExpr("'response' record_type", "'a' record_id", "url target_uri", "null refers_to", "'d' payload_digest",
                         "1L payload_bytes", "cast(html as binary) payload").write.format("warc").mode("overwrite").save(folder)


def test_no_pages(spark, pages):
    assert archived_pages(pages.limit(0)).count() == 0


def test_own_members_are_valid_gzip_and_skipped(tmp_path):
    from clickwarden.llm.warc import gzip_member, read_gzip_records

    bodies = [bytes([65 + n]) * (n * 40_000) for n in range(5)]
    long_uri = "http://x/" + "u" * 9000
    one = [record_bytes("response", f"urn:page:{n}", long_uri if n == 2 else "u", None, hashlib.sha1(b).hexdigest(), len(b), b, "d")
           for n, b in enumerate(bodies)]
    data = b"".join(map(gzip_member, one))
    assert gzip.decompress(data) == b"".join(one)

    class Counting(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            out = super().read(n)
            self.taken += len(out)
            return out

    for payload in (True, False):
        rows = list(read_gzip_records(io.BytesIO(data), {}, payload, True))
        assert [(r["record_id"], r["payload_bytes"]) for r in rows] == [(f"urn:page:{n}", len(b)) for n, b in enumerate(bodies)]
        assert [r["payload"] for r in rows] == (bodies if payload else [None] * 5)
    noise = random.Random(3).randbytes(500_000)
    big = gzip_member(record_bytes("response", "urn:page:9", "u", None, "x", len(noise), noise, "d"))
    stream = Counting(big * 3 + gzip_member(one[1]))
    rows = list(read_gzip_records(stream, {"record_id": frozenset(["urn:page:1"])}, True, True))
    assert [r["payload"] for r in rows] == [bodies[1]] and stream.taken < 20_000
    foreign = gzip.compress(one[0]) + gzip.compress(one[1])
    assert [r["payload"] for r in read_gzip_records(io.BytesIO(foreign), {}, True, True)] == bodies[:2]


@pytest.mark.parametrize("gz", ["true", "false"])
def test_plain_and_gzip_folders(spark, tmp_path, gz):
    from clickwarden.llm.warc import register

    register(spark)
    rows = spark.createDataFrame([(n, "u", "h" * n * 700) for n in range(4)], "page_id long, url string, html string")
    page_records(rows).write.format("warc").option("gzip", gz).mode("append").save(f"file://{tmp_path}/a")
    got = read_archive(spark, f"file://{tmp_path}/a", verify="true").collect()
    assert sorted(len(r.payload) for r in got) == [0, 700, 1400, 2100]
    assert len([f for f in (tmp_path / "a").iterdir() if f.name.endswith(".gz")]) == (len(list((tmp_path / "a").iterdir())) if gz == "true" else 0)


def test_gzip_members_are_skipped_and_read():
    one = [record_bytes("response", f"urn:page:{n}", "u", None, hashlib.sha1(b"x" * n).hexdigest(), n, b"x" * n, "d") for n in range(5)]
    stream = gzip.GzipFile(fileobj=io.BytesIO(b"".join(map(gzip.compress, one))))
    rows = list(read_records(stream, {"record_id": frozenset(["urn:page:3"])}, True, True))
    assert [r["payload"] for r in rows] == [b"xxx"]
    broken = io.BytesIO(one[4].replace(b"xxxx", b"xxxy"))
    with pytest.raises(ValueError, match="digest"):
        list(read_records(broken, {}, True, True))


def foreign_record(kind, content_type, block):
    return (f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:{kind}>\r\n" + (f"Content-Type: {content_type}\r\n" if content_type else "")
            + f"Content-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


def test_blocks_of_other_writers():
    text = b"first part\r\n\r\nsecond part"
    cookies = b"".join(b"Set-Cookie: a%d=%s\r\n" % (n, b"v" * 90) for n in range(90))
    http = b"HTTP/1.1 200 OK\r\n" + cookies + b"Content-Length: 28\r\n\r\nbody\r\n\r\n" + b"b" * 20
    ask = b"GET / HTTP/1.1\r\nHost: x\r\n\r\n"
    made = [("conversion", "text/plain", text), ("warcinfo", "application/warc-fields", b"software: x\r\n"), ("resource", None, b""),
            ("metadata", "text/plain", text * 3), ("response", "application/http; msgtype=response", http), ("request", "application/http", ask)]
    want = [(k, len(b), b) for k, _, b in made[:4]] + [("response", 28, http[-28:]), ("request", 0, b"")]
    one = [foreign_record(*m) for m in made]
    streams = [lambda: (read_records, io.BufferedReader(io.BytesIO(b"".join(one)))), lambda: (read_gzip_records, io.BytesIO(b"".join(map(gzip.compress, one)))),
               lambda: (read_gzip_records, io.BytesIO(b"".join(map(gzip_member, one))))]
    for make in streams:
        for payload in (True, False):
            read, stream = make()
            rows = [(r["record_type"], r["payload_bytes"], r["payload"]) for r in read(stream, {}, payload, False)]
            assert rows == [(k, n, b if payload else None) for k, n, b in want]


def brute(rows, k):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in ok:
        if i % 20 == 0:
            queries[i] = min(v, queries.get(i, v))
    out = Counter()
    for q, v in queries.items():
        best = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in ok if i != q)[:k]
        out.update((q, n, i, -s) for n, (s, i) in enumerate(best, 1))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_topk_equals_brute_force(spark, seed):
    r = random.Random(seed)
    rows = [(n, [r.gauss(0, 1) * (3 if n % 7 == 0 else 0.3) for _ in range(8)]) for n in range(700)]
    rows += [(n, [0.5] * 8) for n in range(700, 1000)]  # one vector holds a third of the rows
    rows += [(n, [x * 1.01 for x in rows[n - 1000][1]]) for n in range(1000, 1100)]
    rows += [(2000, None), (2020, [1.0, None] * 4), (2040, [math.nan] * 8), (2060, [math.inf] * 8), (2080, [0.0] * 8),
             (None, [1.0] * 8), (2100, [9.0, 9.0]), (2101, []), (20, [0.1] * 8), (2120, [-1.0] * 8)]
    vectors = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, score int, rank int")
    stored = [(x.vec_id, x.embedding) for x in vectors.collect()]
    got = Counter((x.query_id, x.rank, x.vec_id, x.score) for x in top_inner_products(
        vectors, k=5, block_queries=30, seed_vectors=64).collect())
    assert got == brute(stored, 5)


def test_topk_few_rows_and_none(spark):
    vectors = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, -2.0]), (20, [0.0, 0.0])], "vec_id long, embedding array<double>")
    assert Counter((x.query_id, x["rank"], x.vec_id, x.score) for x in top_inner_products(vectors).collect()) == brute(
        [(x.vec_id, x.embedding) for x in vectors.collect()], 20)
    assert top_inner_products(vectors.limit(0)).count() == 0
    assert top_inner_products(vectors.filter("vec_id = 0")).count() == 0


def test_topk_holds_one_block_of_queries(spark, monkeypatch):
    import clickwarden.llm.topk as topk

    vectors = spark.createDataFrame([(n, [float(n % 37), float(n % 11 + 1)]) for n in range(2000)], "vec_id long, embedding array<double>")
    laid_rows, sizes, real = [], [], topk.block_hits

    def watched(laid, block, *more):
        laid_rows.append([r["norm"] for r in laid.collect()] if not sizes else None)
        sizes.append(len(block))
        return real(laid, block, *more)

    monkeypatch.setattr(topk, "block_hits", watched)
    out = topk.top_inner_products(vectors, k=3, block_queries=10)
    assert sum(sizes) == 100 and len(sizes) == 10 and out.count() == 300
    assert "Union" not in out._jdf.queryExecution().toString()  # the plan does not grow with the queries
    assert laid_rows[0] == sorted(laid_rows[0], reverse=True)
