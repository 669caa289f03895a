"""Connected components of a graph held as a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node that has an edge; ``root`` is the smallest node reachable.

    ``edges`` has two columns of 64-bit ids in any order and direction.  Large-star
    and small-star steps alternate until the edges are stars (a number of rounds
    that grows with the logarithm of the graph).  A node of very many edges is
    reduced per task before its minimum is taken, and its edges are spread by the
    skew-splitting join.  Every round is written to the shared scratch folder.
    No edges give no rows."""
    u, v = edges.columns
    pairs = edges.select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b")).where("a <> b").distinct()
    pairs = materialise(pairs, "edges")
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(small_least, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b"))
        pairs = materialise(small.where("a <> b").distinct(), "edges")
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    stars = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
