"""Connected components of a graph given as edges, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import drop_table, shared_table


def _large_star(edges: DataFrame) -> DataFrame:
    """Each neighbour above a node is tied to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    # Written first, so that Spark can split the edges of a node that has many.
    tied = both.join(shared_table(least), "a").where(F.col("b") > F.col("a"))
    return tied.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each neighbour below a node, and the node itself, is tied to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return tied.unionByName(own).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` for every node of ``edges`` (``a``, ``b``); the component is its least id.

    Rounds halve the distance to the least node, and each is written to the
    shared folder. Groups are joined through their least member only, so a node
    of many edges costs a sum, which is taken before rows are shuffled. Null
    ids, loops and repeated edges do not matter; no edge gives no row.
    """
    nodes = edges.where("a <> b").select("a", "b").distinct()
    current = shared_table(nodes)
    seen = None
    while True:
        before, current = current, shared_table(_small_star(_large_star(current)))
        drop_table(before)
        found = current.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hash")
        ).first()
        if found == seen:
            break
        seen = found
    own = current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(own)
