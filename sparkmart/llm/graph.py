"""Connected components of an edge table by alternating star contraction.

Each round is joins and minimum aggregates on the node ids (partial minima are
taken before the shuffle; a hub's rows meet one row in a join that adaptive
execution may split) and is written to the shared folder, so a lost executor
costs one round at most.  A round replaces each node's links by links to the
least neighbour; the number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.session import reliable_checkpoint


def _summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"),
                           F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (columns a, b of one ordered
    type); component is the least node reachable.  Null ends, loops and repeated
    edges do not matter; an empty table has no nodes."""
    edges = reliable_checkpoint(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _summary(edges)
    while before[0]:
        # large star: every greater neighbour of a node links to its least neighbour (or itself)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        # nodes that are least themselves keep no row of their own: their neighbours point to them
        large = large.distinct()
        # small star: a node and its smaller neighbours link to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        edges = reliable_checkpoint(small)
        after = _summary(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
