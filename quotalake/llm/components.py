"""Connected components of an edge table by alternating star contractions.

Every round replaces the edges by edges towards the smallest neighbour (first
among larger neighbours, then among smaller ones) and writes them to the shared
scratch folder; it ends when a round changes nothing, and then each node points
at the smallest node of its component.  Rounds grow with the logarithm of the
longest path.  Nothing but a row count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotalake.llm import common as C


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (two BIGINT columns ``a``, ``b``) but the roots.

    Self-loops, repeated and reversed edges and edges with a null are harmless.
    """
    now = C.materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct())
    seen = _state(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # each larger neighbour of a node moves to the node's smallest neighbour
        large = (both.where("b > a").join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        # then the node and its smaller neighbours move to the smallest of these
        small = (large.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(smallest.select("a", F.col("m").alias("b"))).distinct())
        now = C.materialise(small)
        state = _state(now)
        if state == seen:
            break
        seen = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
