"""Connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedertrace.session import checkpoint


def connected_components(edges: DataFrame, *, src: str = "src", dst: str = "dst", max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of ``edges``; the component is its smallest node.

    Alternates large-star and small-star steps: each node's larger neighbours link to its smallest neighbour, then its
    smaller neighbours do. Components become stars in a number of rounds that grows with the logarithm of their size.
    Only minima per node are gathered, so a node with very many neighbours costs rows, never one large group. Each
    round is checkpointed to the shared folder. Null ends and loops are ignored, repeated edges count once.
    """
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null and u <> v")
    e = checkpoint(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

    def star(pairs: DataFrame, larger: bool) -> DataFrame:
        """``pairs``: (u, v) with the neighbours v that u links anew; its minimum is over them and u."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        both = pairs.join(least, "u")
        out = both.where(F.col("v") > F.col("u")).select("v", "m") if larger else both.select("v", "m").union(least)
        return out.toDF("u", "v").where("u <> v").distinct()

    digest = None
    for _ in range(max_rounds):
        both = e.union(e.select("v", "u"))
        big = star(both.toDF("u", "v"), True)
        e = checkpoint(star(big, False))
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == digest:
            break
        digest = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())
