"""Connected components by alternating star contraction; nothing is collected, each round is one pass over the edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.runtime import release, staged


def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(node, root) for every node of `edges(a, b)`; root is the smallest node of the component.

    Large-star links each larger neighbour of a node to the smallest one around it, small-star does so for the smaller
    neighbours, until nothing changes: a logarithmic number of rounds. The minimum is a grouped aggregate with map-side
    combine and is joined back, so a hub is split by adaptive skew handling and never becomes one task's group.
    Self-loops give no row; an empty input gives an empty result.
    """
    e = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    before, e0 = None, e
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(low.select("u", F.col("m").alias("v"))).distinct()
        last, e = e0, staged(e, "cc")
        release(e.sparkSession, last)
        e0 = e
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
