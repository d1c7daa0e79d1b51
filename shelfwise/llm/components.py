"""Connected components of a large graph by alternating star contractions.

An edge list (a, b) of longs is rewritten until every component is a star around
its smallest node.  Each round is two joins and two aggregations, so a node with
very many neighbours is a skewed join key, which adaptive execution splits, and
never a list in one task.  Every round is written to the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Joins every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Joins a node and its smaller neighbours to the smallest of these.
    ``edges`` lead from the larger to the smaller node."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    """Tells one edge set from another: its size and an order-free hash."""
    h = F.xxhash64("a", "b")
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF)))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the undirected edges (a, b) that is
    not itself the smallest of its component; ``component`` is that smallest
    node.  No edges: no rows.  Loops, null ends and repeated edges are ignored."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = cut_lineage(now)
    mark = _mark(now)
    while mark[0]:
        now = cut_lineage(_small_star(_large_star(now)))
        if (after := _mark(now)) == mark:
            break
        mark = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
