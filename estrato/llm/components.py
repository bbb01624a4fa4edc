"""Connected components of a graph given as a table of edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import drop_written, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.union(edges.select("b", "a").toDF("a", "b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    # The side that is aggregated gives up its partitioning, so that run-time splitting can part the edges of a large star.
    return both.join(least.hint("rebalance"), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them.  Edges point from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b): the component is its smallest node.

    Loops and repeated edges do no harm.  Each round is written to the shared folder; the number of rounds
    grows with the logarithm of the longest path.
    """
    def directed(rows: DataFrame) -> DataFrame:
        return rows.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def state(rows: DataFrame) -> tuple:
        return tuple(rows.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    current = written(directed(edges))
    before = state(current)
    while before[0]:
        after = written(directed(_small_star(directed(_large_star(current)))))
        drop_written(current)
        current, last, before = after, before, state(after)
        if last == before:
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(current.select("b", "b").distinct())
