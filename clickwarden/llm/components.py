"""Connected components of an edge table, by minimum labels with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwarden.llm.common import spill


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is its smallest node.

    Every round points each node at the smallest neighbour of its neighbourhood (large star,
    then small star), so long chains shrink quickly and no node's neighbours are gathered in
    a list. Stops when a round changes nothing.
    """
    links = spill(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = None
    for _ in range(max_rounds):
        both = links.select(F.explode(F.array(
            F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = spill(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        links = spill(large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select(
            "e.*").filter("u <> v").distinct(), "links")
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle; raise max_rounds")
    roots = links.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.col("v").alias("component")),
        F.struct(F.col("v").alias("node"), F.col("v").alias("component")))).alias("e")).select("e.*")
    return spill(roots.distinct(), "groups")
