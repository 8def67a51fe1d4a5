"""Merkle manifest of a dataset: a hash tree per language, and one tree over their roots.

A leaf is the SHA-256 of a row's fields, each as byte count, ``:`` and value, or ``-`` for
null. Two consecutive nodes become the hash of their hex digests, an odd last one the hash
of its own. Leaves of a language ascend by doc_id (null first), then by leaf.

Places in the trees come from rows laid out by range of (language, doc_id), so a language
with a third of all rows lies in many chunks. A superblock is an aligned run of
``2 ** block_bits`` nodes. On the way up each superblock is reduced to one node, and these
nodes form superblocks again, until a tree has a single one; every round leaves a table that
is smaller by the size of a superblock. On the way down the nodes of a superblock are
cogrouped with the one row of outer nodes that they all need, the siblings above it: the
group rebuilds its part of the tree, joins its own siblings with the outer ones, and folds
every leaf up to the root. No task holds more than a superblock and its outer path, and the
driver only numbers: rows of the largest tree, and of languages.

Tampering: where 7 divides the crc32 of the decimal doc_id, one is added to n_chars (a null
stays null, as do rows without doc_id), and the row is verified with the leaf made anew.
Rows that repeat are leaves each. Empty texts and languages are values, not nulls. Extra
columns are ignored, and an empty table gives no rows.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickwarden.llm.common import crc_of_id, spill
from clickwarden.operators.ordering import CHUNK, ROW, global_index, lay_out, same

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "tree long, idx long, n long, hash string"
PATH = "tree long, idx long, hash string, path array<string>, subroot string, root string"
PROVED = ("doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean")


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(**changed: Column) -> Column:
    """Leaf of a row; ``changed`` replaces fields."""
    return F.sha2(F.concat(*[_field(changed.get(name, F.col(name))) for name in FIELDS]).cast("binary"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf, and the leaf of the tampered row where there is one."""
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    hit = F.coalesce(crc_of_id() % 7 == 0, F.lit(False))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", leaf_hash().alias("hash"),
        F.when(hit, leaf_hash(n_chars=more)).alias("changed"))


def placed(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows with ``tree`` (languages in order), ``idx`` within it and its size ``n``; and the
    number of trees."""
    laid = lay_out(rows, ["lang", "doc_id", "hash"])
    before = Window.partitionBy("lang").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    # at most one row per chunk and language, and languages only share the chunks on their borders
    sizes = spill(laid.groupBy(CHUNK, "lang").agg(F.count(F.lit(1)).alias("_n"), F.min(ROW).alias("_first")), "merkle_sizes")
    trees = spill(global_index(sizes.select("lang").distinct(), ["lang"], "tree"), "merkle_trees")
    starts = sizes.withColumns({
        "_start": F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first"),
        "n": F.sum("_n").over(Window.partitionBy("lang"))})
    starts = starts.join(trees.withColumnRenamed("lang", "_lang"), same(F.col("lang"), F.col("_lang"))).select(
        F.col(CHUNK).alias("_c"), F.col("lang").alias("_l"), "_start", "n", "tree")
    out = laid.join(starts, (F.col(CHUNK) == F.col("_c")) & same(F.col("lang"), F.col("_l")))
    return out.withColumn("idx", F.col("_start") + F.col(ROW)).drop(CHUNK, ROW, "_c", "_l", "_start", "lang"), trees.count()


def height(n: int, bits: int) -> int:
    """Levels that a superblock of a tree with ``n`` nodes folds."""
    return min(bits, (n - 1).bit_length())


def layers(hashes: list[str], levels: int) -> list[list[str]]:
    """Nodes of a superblock level by level, its own nodes first."""
    out = [hashes]
    for _ in range(levels):
        last = out[-1]
        out.append([digest("".join(last[at:at + 2])) for at in range(0, len(last), 2)])
    return out


def siblings(built: list[list[str]], at: int) -> list[str]:
    """The siblings of a node up to its superblock's top: ``<`` left, ``>`` right, empty for none."""
    path = []
    for layer in built[:-1]:
        other = at ^ 1
        path.append(("<" if other < at else ">") + layer[other] if other < len(layer) else "")
        at >>= 1
    return path


def fold(node: str, path: list[str]) -> str:
    for step in path:
        side, other = step[:1], step[1:]
        node = digest(other + node if side == "<" else node + other)
    return node


def _blocks(nodes: DataFrame, bits: int) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("idx", bits))


def climb(nodes: DataFrame, bits: int) -> DataFrame:
    """One node per superblock."""
    def reduce(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        n = int(rows["n"].iloc[0])
        top = layers(rows["hash"].tolist(), height(n, bits))[-1]
        return pd.DataFrame({"tree": [key[0]], "idx": [key[1]], "n": [-(-n // 2 ** bits)], "hash": top})

    return _blocks(nodes.select("tree", "idx", "n", "hash"), bits).groupBy("tree", "block").applyInPandas(reduce, NODE)


def reductions(nodes: DataFrame, largest: int, bits: int, name: str) -> list[DataFrame]:
    """The nodes of every round; the last holds one node per tree."""
    rounds = [nodes]
    while largest > 1:
        rounds.append(spill(climb(rounds[-1], bits), name))
        largest = -(-largest // 2 ** bits)
    return rounds


def exchange(nodes: DataFrame, outer: DataFrame, bits: int, last: bool = False) -> DataFrame:
    """Superblocks cogrouped with their outer nodes: paths of all nodes, or proofs of leaves."""
    def descend(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        if len(above) != 1:
            raise ValueError(f"superblock {key} has {len(above)} rows of outer nodes")
        beyond, subroot, root = list(above["path"].iloc[0]), above["subroot"].iloc[0], above["root"].iloc[0]
        hashes = rows["hash"].tolist()
        built = layers(hashes, height(int(rows["n"].iloc[0]), bits))
        paths = [siblings(built, at) + beyond for at in range(len(hashes))]
        if not last:
            return pd.DataFrame({"tree": rows["tree"].tolist(), "idx": rows["idx"].tolist(), "hash": hashes, "path": paths,
                                 "subroot": subroot, "root": root})
        changed = [c if isinstance(c, str) else h for c, h in zip(rows["changed"], hashes)]
        folded = [fold(h, path) for h, path in zip(changed, paths)]
        return pd.DataFrame({
            "doc_id": rows["doc_id"].tolist(), "leaf": hashes, "subroot": subroot, "root": root,
            "proof_sha256": [digest("".join(step[1:] for step in path)) for path in paths],
            "folded_root": folded, "verified": [f == root for f in folded]})

    return _blocks(nodes, bits).groupBy("tree", "block").cogroup(outer.groupBy("tree", "idx")).applyInPandas(
        descend, PROVED if last else PATH)


def merkle_manifest(docs: DataFrame, block_bits: int = 10) -> DataFrame:
    """Leaf, roots, proof digest and check of every row of ``docs``."""
    bits = block_bits
    nodes, trees = placed(spill(leaves(docs), "merkle_leaves"))
    nodes = spill(nodes, "merkle_nodes")
    rounds = reductions(nodes, nodes.agg(F.max("n")).first()[0] or 0, bits, "merkle_round")
    roots = rounds[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"),
                              F.lit(trees).cast("long").alias("n"), "hash")
    tops = reductions(roots, trees, bits, "merkle_top")
    none = F.array().cast("array<string>").alias("path")
    outer = tops[-1].select("tree", "idx", "hash", none, F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"))
    for level in reversed(tops[:-1]):
        outer = exchange(level, outer, bits)
    # from here every language is a tree of its own, below the path of its subroot
    outer = spill(outer.select(F.col("idx").alias("tree"), F.lit(0).cast("long").alias("idx"), "hash", "path",
                               F.col("hash").alias("subroot"), "root"), "merkle_outer")
    for level in reversed(rounds[1:-1]):
        outer = spill(exchange(level, outer, bits), "merkle_outer")
    # ids travel as text, which stays exact beside nulls in pandas
    proved = exchange(nodes.withColumn("doc_id", F.col("doc_id").cast("string")), outer, bits, last=True)
    return proved.withColumn("doc_id", F.col("doc_id").cast("long"))
