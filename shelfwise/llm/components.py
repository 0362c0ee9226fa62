"""Connected components of a graph in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """Rows (node, label) for every node with a link; the label is the least node it reaches.

    ``links`` has columns a, b. Alternating large-star and small-star steps end,
    after a number of rounds that grows with the logarithm of the nodes, in one
    star for each component. A hot node is a group of a combined aggregate and a
    side of a join that adaptive execution splits. Each round is a written table.
    """
    edges = materialize(links.select("a", "b").where("a <> b"), "component-links")
    state = None
    while (now := _state(edges)) != state:
        state = now
        edges = materialize(_small_star(_large_star(edges)), "component-links")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        roots.select("node", F.col("node").alias("label"))
    )
