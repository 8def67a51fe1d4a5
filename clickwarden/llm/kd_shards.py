"""K-d tree sharding by distributed weighted medians, with DataFrame functions only.

A row's metadata are its size in bytes, source, language and id. Each becomes an ordered
whole number: the size by its logarithm, source and language by their place in the sorted list
of values (null first), the id by its place between the least and the greatest. Copies of a text
take the metadata of the copy with the smallest id, so they are one point of the space. Rows
of equal value are ordered by a hash of the text and then of the row, so that a source,
language or text with a third of all rows can be cut anywhere, and a cut divides the copies of
one text only (of several texts where their 24-bit hashes agree as well).

Starting with one node, every node that should give several leaves is split along the
dimension in which its values spread widest, at the weighted median of bytes. Medians of all
nodes of a level come from one histogram: bytes per (node, bucket), summed before the shuffle,
then a finer histogram of the bucket that holds the cut until that bucket weighs less than
``tolerance`` of a leaf. Text is read once; the levels run over a stored table of ids, sizes
and keys.

Law ``bytes``: the sizes of leaves differ by tolerance times the number of levels at most, or
by a single row that is larger. Null texts weigh one byte and have checksum 0, as empty ones
have, and are copies of these. Null ids, sources and languages come before all others. Copies
of a row are told apart by a number given when the narrow table is stored. Extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickwarden.llm.common import spill
from clickwarden.operators.ordering import global_index

VALUE_BITS, TEXT_BITS, ROW_BITS, FINE_BITS = 20, 24, 18, 12
TIE_BITS = TEXT_BITS + ROW_BITS
TOP = (1 << VALUE_BITS) - 1
DIMENSIONS = ("size", "source", "lang", "doc_id")


def _metadata(df: DataFrame, column: str) -> Column:
    return F.col(column).cast("string") if column in df.columns else F.lit(None).cast("string")


def _ranked(rows: DataFrame, column: str) -> DataFrame:
    """Add ``r_<column>``: the place of the value in the sorted list of all values, as a key."""
    values = global_index(rows.select(column).distinct(), [column], "place")
    last = values.agg(F.max("place")).first()[0] or 0
    place = F.col("place") if last <= TOP else F.floor(F.col("place") / F.lit((last + 1) / (TOP + 1)))
    values = values.filter(F.col(column).isNotNull()).select(column, place.cast("long").alias(f"r_{column}"))
    return rows.join(values, column, "left").withColumn(f"r_{column}", F.coalesce(f"r_{column}", F.lit(0)))


def narrow(docs: DataFrame) -> DataFrame:
    """Ids, sizes, checksums and the ordered keys k_<dimension>, stored."""
    body = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    base = spill(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"), F.xxhash64(body).alias("text_hash"),
        _metadata(docs, "source").alias("source"), _metadata(docs, "lang").alias("lang")), "shard_rows")
    row = F.shiftrightunsigned(F.xxhash64("doc_id", F.monotonically_increasing_id()), 64 - ROW_BITS)
    rows = base.withColumn("row", row)
    # the point of texts with several copies, combined before the shuffle; a hot text's join is split by AQE
    point = F.struct("doc_id", "source", "lang")
    copied = base.groupBy("text_hash", "size").agg(F.min(point).alias("point"), F.count(F.lit(1)).alias("copies")).filter(
        "copies > 1").drop("copies")
    own = F.coalesce("point", point)
    rows = rows.join(copied, ["text_hash", "size"], "left").select(
        "doc_id", "size", "text_crc32", "text_hash", "row", own["doc_id"].alias("first_id"),
        own["source"].alias("source"), own["lang"].alias("lang"))
    for column in ("source", "lang"):
        rows = _ranked(rows, column)
    ends = base.agg(F.min("doc_id").cast("double").alias("a"), F.max("doc_id").cast("double").alias("b")).first()
    low, width = ends["a"] or 0.0, max((ends["b"] or 0.0) - (ends["a"] or 0.0), 1.0)
    text = F.shiftrightunsigned(F.xxhash64("text_hash", "size"), 64 - TEXT_BITS)
    tie = F.shiftleft(text, ROW_BITS).bitwiseOR(F.col("row"))

    def key(value: Column) -> Column:
        return F.shiftleft(F.least(value.cast("long"), F.lit(TOP)), TIE_BITS).bitwiseOR(tie)

    return spill(rows.select(
        "doc_id", "size", "text_crc32",
        key(F.round(F.log2("size") * (1 << (VALUE_BITS - 6)))).alias("k_size"),
        key(F.col("r_source")).alias("k_source"), key(F.col("r_lang")).alias("k_lang"),
        key(F.coalesce(F.floor((F.col("first_id").cast("double") - low) * (TOP / width)), F.lit(0))).alias("k_doc_id")),
        "shard_keys")


def _cuts(rows: DataFrame, nodes: DataFrame, tolerance_bytes: float) -> DataFrame:
    """For each node (node, dim, low, high, goal): the key below which ``goal`` bytes lie."""
    state = nodes.select("node", "dim", "low", "high", F.col("goal").alias("left"), F.lit(False).alias("done"))
    for _ in range(math.ceil((VALUE_BITS + TIE_BITS) / FINE_BITS) + 1):
        width = F.greatest(F.ceil((F.col("high") - F.col("low")) / float(1 << FINE_BITS)), F.lit(1)).cast("long")
        open_ = state.filter("not done").withColumn("width", width)
        hist = rows.join(open_, "node").withColumn("key", _chosen()).filter("key >= low and key < high").groupBy(
            "node", ((F.col("key") - F.col("low") - (F.col("key") - F.col("low")) % F.col("width"))
                     + F.col("low")).alias("at")).agg(F.sum("size").alias("bytes"))
        upto = Window.partitionBy("node").orderBy("at")
        found = hist.withColumn("sum", F.sum("bytes").over(upto)).join(open_, "node").filter(
            "sum >= left").groupBy("node").agg(F.min(F.struct("at", "bytes", "sum")).alias("b"))
        nearer = (F.col("left") - (F.col("b.sum") - F.col("b.bytes"))) * 2 < F.col("b.bytes")
        small = (F.col("b.bytes") <= tolerance_bytes) | (F.col("width") <= 1)
        stepped = open_.join(found, "node", "left").select(
            "node", "dim",
            F.when(F.col("b").isNull(), F.col("high")).when(
                small, F.when(nearer, F.col("b.at")).otherwise(F.col("b.at") + F.col("width"))).otherwise(
                F.col("b.at")).alias("low"),
            F.when(F.col("b").isNull(), F.col("high")).otherwise(F.col("b.at") + F.col("width")).alias("high"),
            F.coalesce(F.col("left") - (F.col("b.sum") - F.col("b.bytes")), F.lit(0)).alias("left"),
            (F.col("b").isNull() | small).alias("done"))
        state = spill(state.filter("done").unionByName(stepped), "shard_cuts")
        if state.filter("not done").isEmpty():
            break
    return state.select("node", F.col("low").alias("cut"))


def _chosen() -> Column:
    pick = F.when(F.col("dim") == 0, F.col("k_size"))
    for n, name in enumerate(DIMENSIONS[1:], 1):
        pick = pick.when(F.col("dim") == n, F.col(f"k_{name}"))
    return pick


def kd_leaves(rows: DataFrame, leaves: int, tolerance: float = 0.0005) -> DataFrame:
    """``rows`` with ``shard`` from 0 to leaves - 1."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    per_leaf = total / leaves
    value = {d: F.shiftright(f"k_{d}", TIE_BITS) for d in DIMENSIONS}
    span = {d: F.max(value[d]) - F.min(value[d]) for d in DIMENSIONS}
    # a dimension's spread counts as a share of its spread over the whole table
    base = rows.agg(*[F.greatest(span[d], F.lit(1)).alias(d) for d in DIMENSIONS]).first()
    placed = rows.withColumn("node", F.lit(0).cast("long")).withColumn("first", F.lit(0)).withColumn(
        "count", F.lit(leaves))
    for _ in range(math.ceil(math.log2(leaves)) if leaves > 1 else 0):
        stats = placed.filter("count > 1").groupBy("node", "first", "count").agg(
            F.sum("size").alias("bytes"),
            *[(span[d] / F.lit(float((base[d] if base else None) or 1.0))).alias(f"s_{d}") for d in DIMENSIONS],
            *[F.min(f"k_{d}").alias(f"low_{d}") for d in DIMENSIONS],
            *[(F.max(f"k_{d}") + 1).alias(f"high_{d}") for d in DIMENSIONS])
        widest = F.greatest(*[F.col(f"s_{d}") for d in DIMENSIONS])
        dim = F.coalesce(*[F.when(F.col(f"s_{d}") == widest, n) for n, d in enumerate(DIMENSIONS)])
        at = lambda side: F.coalesce(*[F.when(F.col("dim") == n, F.col(f"{side}_{d}")) for n, d in enumerate(DIMENSIONS)])
        half = F.floor(F.col("count") / 2)
        nodes = spill(stats.withColumn("dim", dim).select(
            "node", "dim", at("low").alias("low"), at("high").alias("high"),
            F.round(F.col("bytes") * half / F.col("count")).cast("long").alias("goal")), "shard_nodes")
        cuts = _cuts(placed.filter("count > 1"), nodes, tolerance * per_leaf)
        with_cut = placed.join(nodes.select("node", "dim").join(cuts, "node"), "node", "left")
        right = F.coalesce(_chosen() >= F.col("cut"), F.lit(False))
        split = F.col("count") > 1
        left_count = F.floor(F.col("count") / 2).cast("int")
        placed = spill(with_cut.select(
            *rows.columns,
            F.when(split, F.col("node") * 2 + 1 + right.cast("int")).otherwise(F.col("node")).alias("node"),
            F.when(split & right, F.col("first") + left_count).otherwise(F.col("first")).cast("int").alias("first"),
            F.when(~split, F.col("count")).when(right, F.col("count") - left_count).otherwise(
                left_count).cast("int").alias("count")), "shard_level")
    return placed.select(*rows.columns, F.col("first").cast("int").alias("shard"))


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None,
              slot_rows: int = 250_000) -> DataFrame:
    """Shard and slot of every row; give the number of shards or the bytes a shard should hold."""
    rows = narrow(docs)
    if shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = max(1, math.ceil(total / target_bytes))
    placed = kd_leaves(rows, shards)
    chunks = max(1, math.ceil(rows.count() / slot_rows)) * 16
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "k_doc_id"), F.lit(chunks)))
    counts = placed.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "chunk", (F.sum("n").over(
        Window.partitionBy("shard").orderBy("chunk")) - F.col("n")).alias("before"))
    number = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("doc_id", "k_doc_id"))
    return placed.withColumn("number", number).join(before, ["shard", "chunk"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("number") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
