"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwarden.llm.common import held_out, read_table
from clickwarden.llm.decontamination import benchmark_leaks
from clickwarden.llm.kd_shards import kd_shards
from clickwarden.llm.license_scan import scan_licenses
from clickwarden.llm.lm_scores import lm_scores
from clickwarden.llm.merkle import merkle_manifest
from clickwarden.llm.minhash import near_duplicates
from clickwarden.llm.negatives import hard_negatives
from clickwarden.llm.packing import pack
from clickwarden.llm.quality import quality_scores
from clickwarden.llm.repair import token_documents
from clickwarden.llm.topk import top_inner_products
from clickwarden.llm.toxicity import toxicity_scores
from clickwarden.llm.warc import archived_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str):
    def register(function):
        QUERIES[name] = function
        return function
    return register


@query("op1_kd_shards")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(read_table(spark, sf_dir, "documents"), shards=8)


@query("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


@query("op3_benchmark_leaks")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that leak, with their number of items and the nearest of them."""
    found = benchmark_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.filter("leaks > 0")


def judged(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


@query("op4_quality_trees")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")), 0.3)


@query("op5_toxicity_grammar")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")), 0.5)


@query("op6_best_fit_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))


@query("op7_circulant_minhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


@query("op8_token_shards")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_documents(read_table(spark, sf_dir, "documents")).drop("shard", "place")


@query("op9_warc_archive")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(read_table(spark, sf_dir, "pages"))


@query("op10_norm_bucketed_topk")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(read_table(spark, sf_dir, "embeddings"))


@query("op11_merkle_manifest")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(read_table(spark, sf_dir, "documents"))


# crc32 is written out bit by bit, as DuckDB has no such function
ORACLE["op11_merkle_manifest"] = r"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, lang, text) AS r, doc_id, source, lang, n_chars, text,
           coalesce(~list_reduce(list_prepend(4294967295, list_transform(
               range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ord(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))),
               lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]),
                   lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))) & 4294967295, 1) % 7 = 0 AS hit
    FROM documents
), f AS (
    SELECT r, doc_id, lang, hit, n_chars, sha256(concat(
        coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-'),
        coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
        coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-'),
        coalesce(strlen(text) || ':' || text, '-'))) AS leaf, sha256(concat(
        coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-'),
        coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
        coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || CAST(n_chars + 1 AS VARCHAR), '-'),
        coalesce(strlen(text) || ':' || text, '-'))) AS changed
    FROM d
), p AS (
    SELECT r, doc_id, leaf, CASE WHEN hit THEN changed ELSE leaf END AS used, lang,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
           dense_rank() OVER (ORDER BY lang NULLS FIRST) AS t
    FROM f
), below AS (
    SELECT t, 0 AS l, i, leaf AS h, count(*) OVER (PARTITION BY t) AS n FROM p
    UNION ALL
    SELECT t, l + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (min(n) + 1) // 2 FROM below WHERE n > 1 GROUP BY t, l, i // 2
), top AS (
    SELECT 0 AS l, t - 1 AS i, h, count(*) OVER () AS n FROM below WHERE n = 1
    UNION ALL
    SELECT l + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (min(n) + 1) // 2 FROM top WHERE n > 1 GROUP BY l, i // 2
), every_node AS (
    SELECT t, l, i, h, n FROM below WHERE n > 1
    UNION ALL SELECT 0, l, i, h, n FROM top
), depth AS (
    SELECT t, max(l) AS depth, max(h) FILTER (n = 1) AS subroot FROM below GROUP BY t
), walk AS (
    SELECT r, t, 0 AS l, i, used AS h, '' AS proof, false AS upper, t AS t0 FROM p
    UNION ALL
    SELECT w.r, CASE WHEN w.upper OR w.l = d.depth THEN 0 ELSE w.t END,
           CASE WHEN w.upper OR w.l < d.depth THEN w.l + 1 ELSE 0 END,
           CASE WHEN w.upper OR w.l < d.depth THEN w.i // 2 ELSE w.t0 - 1 END,
           CASE WHEN NOT w.upper AND w.l = d.depth THEN w.h WHEN s.h IS NULL THEN sha256(w.h)
                WHEN w.i % 2 = 0 THEN sha256(w.h || s.h) ELSE sha256(s.h || w.h) END,
           w.proof || CASE WHEN NOT w.upper AND w.l = d.depth THEN '' ELSE coalesce(s.h, '') END,
           w.upper OR w.l = d.depth, w.t0
    FROM walk w JOIN depth d ON d.t = w.t0
    LEFT JOIN every_node s ON s.t = w.t AND s.l = w.l AND s.i = xor(w.i, 1) AND (w.upper OR w.l < d.depth)
    WHERE NOT (w.upper AND w.l = (SELECT max(l) FROM top))
)
SELECT p.doc_id, p.leaf, d.subroot, root.h AS root, sha256(w.proof) AS proof_sha256, w.h AS folded_root, w.h = root.h AS verified
FROM p JOIN depth d USING (t) JOIN walk w ON w.r = p.r AND w.upper AND w.l = (SELECT max(l) FROM top)
JOIN (SELECT h FROM top WHERE n = 1) root ON true
"""
@query("op12_recurrent_lm")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read_table(spark, sf_dir, "documents"))


@query("op13_hard_negatives")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read_table(spark, sf_dir, "embeddings"), relabel=label)


ORACLE["op13_hard_negatives"] = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike,
           CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""
ORACLE["op10_norm_bucketed_topk"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
ORACLE["op9_warc_archive"] = """
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), d AS (
    SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS payload_digest FROM p
), k AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS kept FROM d
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN kept END AS refers_to
FROM k
"""
ORACLE["op7_circulant_minhash"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
), g AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM w
), n AS (
    SELECT w.doc_id, count(g.s) AS n FROM w LEFT JOIN g USING (doc_id) GROUP BY 1
), p AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2
), e AS (
    SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)
), r AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a
)
SELECT n.doc_id, n.n AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept
FROM n JOIN (SELECT doc_id, min(other) AS component_id FROM r GROUP BY 1) c USING (doc_id)
"""
