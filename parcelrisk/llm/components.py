"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelrisk.llm.common import stored


def connected_components(links: DataFrame, kind: str, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every id in a link (a, b); the component is its smallest id.

    Alternating large-star and small-star rounds: each keeps the components, makes the links shorter and ends with
    a star around the smallest id. The rounds grow with the logarithm of the longest path. Links are written
    after each round, so a lost executor costs one round at most.
    """
    edges = stored(links.filter("a is not null and b is not null and a <> b")
                   .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        # large star: every larger neighbour is tied to the smallest one
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: every smaller neighbour, and the id itself, is tied to the smallest one
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        edges = stored(small, "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == tuple(state):
            break
        before = tuple(state)
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
