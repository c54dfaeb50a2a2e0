"""Candidate edges to clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedertrace.operators.graph import connected_components


def top_k(pairs: DataFrame, *, min_r: float, k: int) -> DataFrame:
    """(src, dst, r, rank): of each node the ``k`` best partners with at least ``min_r``; ties by name."""
    strong = pairs.where(F.col("r").isNotNull() & ~F.isnan("r") & (F.col("r") >= min_r))
    both = strong.select(F.col("badge_a").alias("src"), F.col("badge_b").alias("dst"), "r").union(strong.select("badge_b", "badge_a", "r"))
    best = Window.partitionBy("src").orderBy(F.desc("r"), "dst")
    return both.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mutual(edges: DataFrame) -> DataFrame:
    """(src, dst, r) with src < dst where each is among the other's best."""
    ends = edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), "r")
    return ends.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"), F.max("r").alias("r")).where("n = 2").drop("n")


def clusters(badges: DataFrame, edges: DataFrame) -> DataFrame:
    """(badge, cluster) for every badge: components numbered from 0 by their smallest badge, single ones included."""
    joined = connected_components(edges)
    named = badges.select("badge").distinct().join(joined.withColumnRenamed("node", "badge"), "badge", "left").select("badge", F.coalesce("component", "badge").alias("least"))
    return number(named, "least", "cluster")


def number(rows: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` with ``key`` replaced by its rank from 0, as ``name``. Keys are ranked in a range-sorted pass: a rank is
    the number of keys in the partitions before, plus the place in its own."""
    from feedertrace.session import checkpoint

    keys = checkpoint(rows.select(key).distinct().repartitionByRange(key).sortWithinPartitions(key)).withColumn("_at", F.monotonically_increasing_id())
    parts = sorted(tuple(r) for r in keys.groupBy(F.shiftright("_at", 33).alias("p")).agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("low")).collect())
    before, shift = 0, {}
    for part, n, low in parts:
        shift[part] = before - low
        before += n
    if not shift:
        return rows.select(*(c for c in rows.columns if c != key), F.lit(None).cast("long").alias(name))
    starts = F.create_map(*(F.lit(x) for p in shift.items() for x in p))
    ranks = keys.select(key, (F.col("_at") + F.element_at(starts, F.shiftright("_at", 33))).cast("long").alias(name))
    return rows.join(ranks, key).select(*(c for c in rows.columns if c != key), name)
