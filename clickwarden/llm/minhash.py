"""Near-duplicate groups by circulant MinHash, banding and exact verification.

A document's set holds its distinct shingles of ``width`` words as 64-bit hashes. Circulant
MinHash needs two permutations of a ring of positions: the first scatters the shingles over
the ring, the second ranks the positions, and coordinate k of the signature is the smallest
rank over the scattered positions shifted by k. A shift reads the next place of the ranked
ring, so all coordinates of a shingle are one contiguous slice, and a signature is the
element-wise minimum of such slices. Two documents are candidates when they agree in all
coordinates of a band.

Documents with equal sets form a class and only the class's smallest doc_id goes on. Copies
are not expanded into pairs. First, over a few bands, every member of a bucket is compared
with the leader it meets most often; another round with other leaders follows for those that
are not in their leader's group yet. This joins groups of any size with a few pairs a
document. Then all bands are looked at, but only in buckets that still hold several groups:
each member's nearest members of other groups by sketch, and at last all pairs of different
groups whose sketches are alike enough to allow a link. Buckets above ``small_bucket`` are
dealt by two bands at once first, which leaves similar pairs together and scatters chance
meetings; what is still larger goes through a join that Spark can split. Every link is
confirmed on the full sets.

A sketch is two bits of each of 1024 coordinates. A pair at similarity 0.75 shares none of 40
bands with probability 3e-7, fewer than two with 5e-6, and is estimated 0.07 too low with
about 1e-5; a link is lost only if its groups do not meet in any other way either.
Null ids keep their own class; null texts, empty texts and texts without words have size 0,
link with nothing and are kept. Fewer than ``width`` words count as one shingle. Rows with
one doc_id stand for one document. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickwarden.llm.common import column_batches, memo_of, spill
from clickwarden.llm.components import components

RING_BITS = 18
_STEP = np.uint64(0x9E3779B97F4A7C15)
_words: dict[bytes, int] = {}
_rings: dict[int, np.ndarray] = {}


def _forget() -> None:
    _words.clear()
    _rings.clear()


def mixed(h: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers."""
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def shingle_hashes(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of lower-cased words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    try:
        codes = list(map(_words.__getitem__, words))
    except KeyError:
        if len(_words) > 300_000:
            _words.clear()
        for word in set(words).difference(_words):
            _words[word] = xxhash.xxh3_64_intdigest(word)
        codes = list(map(_words.__getitem__, words))
    h = np.array(codes, np.uint64)
    n = max(1, len(h) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(width, len(h))):
        out = (out * _STEP) + h[k:k + n]
    return np.unique(mixed(out + np.uint64(min(width, len(h)))))


def ranked_ring(coordinates: int, seed: int = 11) -> np.ndarray:
    """Ranks of the ring's positions, with the first ones again at the end."""
    if coordinates not in _rings:
        ranks = np.random.default_rng(seed).permutation(1 << RING_BITS).astype(np.uint32)
        _rings[coordinates] = np.concatenate([ranks, ranks[:coordinates]])
    return _rings[coordinates]


def signature(hashes: np.ndarray, coordinates: int) -> np.ndarray:
    """Coordinate k is the least rank over the shingles' positions shifted by k."""
    ring = np.lib.stride_tricks.sliding_window_view(ranked_ring(coordinates), coordinates)
    # the first permutation: bits of a mixed hash scatter the shingles over the ring
    places = (hashes >> np.uint64(64 - RING_BITS)).astype(np.int64)
    out = ring[places[:2048]].min(0)
    for at in range(2048, len(places), 2048):
        np.minimum(out, ring[places[at:at + 2048]].min(0), out=out)
    return out


def signatures(docs: DataFrame, bands: int = 40, rows: int = 4, width: int = 5, coordinates: int = 1024) -> DataFrame:
    """doc_id, number of shingles, a 128-bit name of the set, hashes of the bands, and two bits of every coordinate."""
    names = ["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch"]

    def sign(batches):
        weights = np.random.default_rng(5).integers(1, 1 << 62, rows).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        memo_of("minhash", _forget)
        for batch in column_batches(batches):
            sizes, a, b, keys, offsets, brief = [], [], [], [], [0], []
            for text in batch.column(1).to_pylist():
                h = shingle_hashes(text, width)
                sizes.append(len(h))
                a.append(h.sum(dtype=np.uint64) if len(h) else np.uint64(0))
                b.append(mixed(h + _STEP).sum(dtype=np.uint64) if len(h) else np.uint64(0))
                brief.append(None)
                if len(h):
                    s = signature(h, coordinates)
                    low = (s & 3).astype(np.uint8).reshape(-1, 4)
                    brief[-1] = (low[:, 0] | low[:, 1] << 2 | low[:, 2] << 4 | low[:, 3] << 6).tobytes()
                    s = s[:bands * rows].reshape(bands, rows).astype(np.uint64)
                    keys.append(mixed((s * weights).sum(1) + np.arange(bands, dtype=np.uint64) * _STEP))
                offsets.append(offsets[-1] + (bands if len(h) else 0))
            flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(np.array(a, np.uint64).view(np.int64)),
                pa.array(np.array(b, np.uint64).view(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.view(np.int64))),
                pa.array(brief, pa.binary())], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        sign, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sketch binary")


def shingle_sets(docs: DataFrame, width: int = 5) -> DataFrame:
    """doc_id and the bytes of its sorted shingle hashes."""

    def gather(batches):
        memo_of("minhash", _forget)
        for batch in column_batches(batches):
            sets = [shingle_hashes(t, width).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["doc_id", "hashes"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        gather, "doc_id long, hashes binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union, on the full sets."""

    def verify(batches):
        memo_of("minhash", _forget)
        for batch in column_batches(batches, 500):
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                common = int((q[at] == p).sum())
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    with_b = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("hb")), "b")
    return with_b.join(sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("ha")), "a").select(
        "a", "b", "ha", "hb").mapInArrow(verify, "a long, b long")


def _placed(own: DataFrame, groups: DataFrame | None, first: int | None = None) -> DataFrame:
    """doc_id, its group so far, size, and a row for each of its (first) bands."""
    rows = own if groups is None else own.join(groups, own.doc_id == groups.node, "left")
    component = F.col("doc_id") if groups is None else F.coalesce("component", "doc_id")
    bands = F.col("bands") if first is None else F.slice("bands", 1, first)
    return rows.select("doc_id", "n_shingles", component.alias("component"), F.explode(bands).alias("bucket"))


def _mixed(placed: DataFrame, salt: int) -> DataFrame:
    """Buckets that hold several groups, each with a leader: its member of least (salted) id."""
    order = F.col("doc_id") if salt == 0 else F.xxhash64("doc_id", F.lit(salt))
    return placed.groupBy("bucket").agg(
        F.min(F.struct(order.alias("o"), "doc_id", "component")).alias("lead"), F.count(F.lit(1)).alias("n"),
        F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select(
        "bucket", "n", F.col("lead.doc_id").alias("leader"), F.col("lead.component").alias("own_group"))


def _star_pairs(own: DataFrame, groups: DataFrame | None, salts: tuple, first: int | None = None) -> DataFrame:
    """For each salt a pair for every member outside its bucket's leading group: with the leader it meets most often."""
    placed = _placed(own, groups, first)
    out = None
    for salt in salts:
        met = placed.join(_mixed(placed, salt), "bucket").filter("component <> own_group").groupBy(
            "doc_id", "leader").agg(F.count(F.lit(1)).alias("met"))
        pairs = met.groupBy(F.col("doc_id").alias("b")).agg(
            F.max(F.struct("met", (-F.col("leader")).alias("minus"))).alias("m")).select((-F.col("m.minus")).alias("a"), "b")
        out = pairs if out is None else out.unionByName(pairs)
    return out.distinct() if len(salts) > 1 else out


# how many of a byte's four two-bit numbers are zero
_EQUAL = np.array([sum((b >> k & 3) == 0 for k in (0, 2, 4, 6)) for b in range(256)], np.uint8)


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Similarity estimated from rows of sketches; two-bit numbers agree by chance once in four."""
    share = _EQUAL[x ^ y].sum(1, dtype=np.int64) / (4 * x.shape[1])
    return (share - 0.25) / 0.75


def bucket_pairs(bucket: int, ids, groups, sizes, marks, bands, percent: int, margin: float, nearest: int | None):
    """Pairs of different groups whose sizes and sketches allow a link; the ``nearest`` of each member, or all.

    All pairs come from the bucket of their first common band only.
    """
    width = max((len(m) for m in marks if m is not None), default=4)
    known = np.array([m is not None for m in marks])
    n_bands = max((len(b) for b, k in zip(bands, known, strict=True) if k and b is not None), default=1)
    single = known & np.array([b is not None and len(b) == n_bands for b in bands])
    banded = np.array([b if k else [0] * n_bands for b, k in zip(bands, single, strict=True)], np.int64).reshape(len(ids), n_bands)
    table = np.frombuffer(b"".join(m if m is not None else bytes(width) for m in marks), np.uint8).reshape(len(ids), -1)
    out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(ids), 32):
        part = slice(at, at + 32)
        less = np.minimum(sizes[part, None], sizes)
        fits = (groups[part, None] != groups) & ((100 * less >= percent * np.maximum(sizes[part, None], sizes)) | (less == 0))
        if nearest is None:
            fits &= ids[part, None] < ids
        i, j = np.nonzero(fits)
        if not len(i):
            continue
        same = np.concatenate([likeness(table[i[k:k + 20_000] + at], table[j[k:k + 20_000]]) for k in range(0, len(i), 20_000)])
        same[~known[i + at] | ~known[j]] = 1.0
        keep = same >= percent / 100 - margin
        i, j, same = i[keep], j[keep], same[keep]
        if nearest is None and len(i):
            x, y = banded[i + at], banded[j]
            first = x[np.arange(len(i)), (x == y).argmax(1)] == bucket
            here = first | ~single[i + at] | ~single[j]
            i, j = i[here], j[here]
        if nearest is not None and len(i):
            order = np.lexsort((ids[j], -same, i))
            i, j = i[order], j[order]
            rank = np.arange(len(i)) - np.searchsorted(i, i)
            i, j = i[rank < nearest], j[rank < nearest]
        x, y = ids[i + at], ids[j]
        out_a.append(np.minimum(x, y))
        out_b.append(np.maximum(x, y))
    return np.concatenate(out_a), np.concatenate(out_b)


def _likely_pairs(members: DataFrame, percent: int, nearest: int | None, margin: float = 0.07) -> DataFrame:
    """``bucket_pairs`` of every bucket. A bucket's rows reach one task, so its size must be bounded."""

    def pairs_of(bucket, parts) -> tuple[np.ndarray, np.ndarray]:
        column = lambda n: np.concatenate([p.column(n).to_numpy() for p in parts])
        marks, bands = ([m for p in parts for m in p.column(n).to_pylist()] for n in (4, 5))
        a, b = bucket_pairs(bucket, column(1), column(2), column(3), marks, bands, percent, margin, nearest)
        if len(a):
            a, b = np.unique(np.stack([a, b]), axis=1)
        return a, b

    def search(batches):
        memo_of("minhash", _forget)
        held, bucket = [], None
        for batch in batches:
            keys = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)] if len(keys) else [0]
            found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for low, high in zip(edges, edges[1:], strict=False):
                if keys[low] != bucket and held:
                    found.append(pairs_of(bucket, held))
                    held = []
                bucket = keys[low]
                held.append(batch.slice(low, high - low))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found])) for k in (0, 1)], ["a", "b"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in pairs_of(bucket, held)], ["a", "b"])

    return members.select("bucket", "doc_id", "component", "n_shingles", "sketch", "bands").repartition("bucket").sortWithinPartitions(
        "bucket").mapInArrow(search, "a long, b long").distinct()


def _cross_pairs(members: DataFrame, percent: int) -> DataFrame:
    """All pairs of different groups in one bucket whose sizes allow a link, by a join that Spark can split."""
    x = members.select("bucket", F.col("doc_id").alias("a"), F.col("component").alias("ca"), F.col("n_shingles").alias("na"))
    y = members.select("bucket", F.col("doc_id").alias("b"), F.col("component").alias("cb"), F.col("n_shingles").alias("nb"))
    return x.join(y, "bucket").filter("a < b and ca <> cb").filter(
        (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) | (F.least("na", "nb") == 0)).select("a", "b").distinct()


def _open_members(own: DataFrame, groups: DataFrame | None, small_bucket: int) -> tuple[DataFrame, DataFrame]:
    """Members of buckets that still hold several groups: of bounded buckets, and of larger ones
    dealt again by two bands at once."""
    placed = _placed(own, groups)
    open_ = spill(placed.join(_mixed(placed, 0).select("bucket", "n"), "bucket").join(
        own.select("doc_id", "bands", "sketch"), "doc_id").select(
        "bucket", "n", "doc_id", "component", "n_shingles", "sketch", "bands"), "minhash_open")
    bounded, large = open_.filter(F.col("n") <= small_bucket), open_.filter(F.col("n") > small_bucket)
    if large.isEmpty():
        return bounded, bounded.limit(0)
    none = F.lit(None).cast("array<long>")  # a pair meets in several of the buckets dealt again
    dealt = large.select("doc_id", "component", "n_shingles", "sketch", F.col("bucket").alias("one"), F.explode("bands").alias(
        "other")).filter("other <> one").withColumn("bucket", F.xxhash64(F.least("one", "other"), F.greatest("one", "other"))).drop(
        "one", "other").dropDuplicates(["bucket", "doc_id"])
    again = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("low"), F.max(
        "component").alias("high")).filter("low < high").select("bucket", "n")
    dealt = spill(dealt.join(again, "bucket").withColumn("bands", none).select(*open_.columns), "minhash_dealt")
    return bounded.unionByName(dealt.filter(F.col("n") <= small_bucket)), dealt.filter(F.col("n") > small_bucket)


def near_duplicates(docs: DataFrame, percent: int = 75, bands: int = 40, rows: int = 4, width: int = 5,
                    first_bands: int = 6, small_bucket: int = 4096) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    signed = spill(signatures(docs, bands, rows, width), "minhash")
    usable = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("doc_id"))
    # a doc_id with several texts is one document, without a size or sketch to filter by: its
    # classes are linked through the id
    first = usable.groupBy("set_a", "set_b", "n_shingles").agg(
        F.min(F.struct("doc_id", "bands", "sketch")).alias("m")).select("n_shingles", "m.*")
    own = spill(first.groupBy("doc_id").agg(
        F.when(F.count(F.lit(1)) == 1, F.max("n_shingles")).otherwise(0).alias("n_shingles"),
        F.flatten(F.collect_list("bands")).alias("bands"),
        F.when(F.count(F.lit(1)) == 1, F.first("sketch")).alias("sketch")), "minhash_own")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    groups = found = None

    def grown(pairs: DataFrame) -> bool:
        """Confirm pairs and merge their groups; whether there were any links."""
        nonlocal groups, found
        links = spill(confirmed(pairs, sets, percent), "minhash_links")
        if links.isEmpty():
            return False
        found = links if found is None else found.unionByName(links)
        groups = components(found)
        return True

    # large groups first: a few bands, then other leaders for who is not in its leader's group yet
    placed = _placed(own, None, first_bands)
    shared = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    early = spill(placed.join(shared, "bucket", "left_semi").select("doc_id").distinct(), "minhash_ids")
    sets = spill(shingle_sets(texts.join(early, "doc_id", "left_semi"), width), "minhash_sets")
    early_own = own.join(early, "doc_id", "left_semi")
    if grown(_star_pairs(early_own, None, (0,), first_bands)):
        grown(_star_pairs(early_own, groups, (1, 2, 3), first_bands))

    # then all bands, in buckets that still hold several groups: nearest members, then all that can be linked
    placed = _placed(own, groups)
    late = spill(placed.join(_mixed(placed, 0).select("bucket"), "bucket", "left_semi").select("doc_id").distinct(), "minhash_ids")
    sets = sets.unionByName(spill(shingle_sets(texts.join(
        late.join(early, "doc_id", "left_anti"), "doc_id", "left_semi"), width), "minhash_sets"))
    late_own = own.join(late, "doc_id", "left_semi")
    for nearest in (1, None):
        bounded, large = _open_members(late_own, groups, small_bucket)
        pairs = _likely_pairs(bounded, percent, nearest)
        if nearest is None:
            pairs = pairs.unionByName(_cross_pairs(large, percent)).distinct()
        grown(pairs)

    known = classes.select("set_a", "set_b", "n_shingles", F.col("doc_id").alias("class"))
    if groups is None:
        known = known.withColumn("component_id", F.col("class"))
    else:
        known = known.join(groups, F.col("class") == F.col("node"), "left").withColumn("component_id", F.coalesce("component", "class"))
    known = known.select("set_a", "set_b", "n_shingles", "component_id")
    out = signed.select("doc_id", "n_shingles", "set_a", "set_b").join(known, ["set_a", "set_b", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def first_of_groups(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` per near-duplicate group: that with the smallest doc_id.

    Rows without a doc_id can't be linked and stay. Of rows with one doc_id a single one stays.
    """
    kept = near_duplicates(docs, **options).filter("kept and doc_id is not null").select("doc_id").distinct()
    place = "_place"
    while place in docs.columns:
        place += "_"
    with_id = docs.filter("doc_id is not null")
    unique = with_id.withColumn(place, F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))))
    unique = unique.filter(F.col(place) == 1).drop(place).join(kept, "doc_id", "left_semi")
    return unique.select(*docs.columns).unionByName(docs.filter("doc_id is null"))
