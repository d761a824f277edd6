"""Connected components of an undirected graph by alternating large-star and small-star rounds.

Edges never leave the cluster; each round is written to the shared scratch folder. A node of high degree is one group
above the share of rows that ``lookup`` broadcasts, so that its edges are not drawn into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup, stash


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _star(pairs: DataFrame, total: int) -> DataFrame:
    """pairs (u, v): each v with the least of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("degree"))
    return lookup(pairs, least, "u", "degree", total)


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, root) for every node that has an edge; root is the least node that it can reach."""
    edges = stash(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(edges)
    while True:
        total = max(2 * state[0], 1)
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _star(both, total).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stash(large, "large")
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        small = _star(down, total)
        small = small.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(small.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()
        edges = stash(small, "small")
        new = _state(edges)
        if new == state:
            break
        state = new
    roots = edges.groupBy("b").agg(F.lit(0)).select(F.col("b").alias("node"), F.col("b").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
