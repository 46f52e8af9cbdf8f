"""Connected components of a graph given as a table of edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmart.session import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least node of its neighbourhood."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return larger.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionAll(own).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and label, the least node of its component, for nodes that have an edge.

    `edges` has columns u and v. A round halves the depth of what is left, each is written
    to the shared folder, and the rounds end when every edge leads to a least node.
    """
    current = staged(edges.where("u <> v").distinct(), "edges")
    while True:
        current = staged(_small_star(_large_star(current)), "edges")
        roots = current.select(F.col("v").alias("u")).distinct()
        several = current.groupBy("u").agg(F.count("*").alias("n")).where("n > 1")
        if current.join(roots, "u", "left_semi").isEmpty() and several.isEmpty():
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(roots)
