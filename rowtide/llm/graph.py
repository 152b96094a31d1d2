"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import stored


def _larger_first(edges: DataFrame) -> DataFrame:
    """Each undirected edge once, as (u, v) with v < u."""
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("v < u").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (u, v): root is the least node reachable.

    A node's neighbours are never gathered: minima combine map-side and the joins are on
    keys that adaptive execution can split. Each round is stored, so lineage stays short;
    rounds grow with the logarithm of the longest chain. No edges give no rows; self loops
    and null ends are passed over.
    """
    now = stored(_larger_first(edges))
    mark = _mark(now)
    while mark[0]:
        now = stored(_larger_first(_small_star(_larger_first(_large_star(now)))))
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    """Row count and an order-free digest: equal in two rounds when nothing moved."""
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), digest).first())
