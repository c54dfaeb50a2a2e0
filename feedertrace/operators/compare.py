"""Two runs held against each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedertrace.functions.scalar import diff_status

STATUSES = ("newly_flagged", "no_longer_flagged", "recommendation_changed", "unchanged")


def common(old: DataFrame, new: DataFrame) -> DataFrame:
    """(badge, o, n): the clusters of badges that both runs have."""
    return old.select("badge", F.col("cluster").alias("o")).join(new.select("badge", F.col("cluster").alias("n")), "badge")


def badge_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per common badge whose peers changed: sizes, gained and lost peers, and the Jaccard index of the peer sets.

    Peers are counted, not listed: of an old and a new cluster, the badge shares with both what stands in both.
    """
    size = lambda runs, name: runs.groupBy("cluster").agg(F.count(F.lit(1)).alias(name))
    both = common(old, new)
    shared = both.groupBy("o", "n").agg(F.count(F.lit(1)).alias("both"))
    own = both.join(shared, ["o", "n"]).join(size(old, "old_size").withColumnRenamed("cluster", "o"), "o").join(size(new, "new_size").withColumnRenamed("cluster", "n"), "n")
    gained, lost, kept = F.col("new_size") - F.col("both"), F.col("old_size") - F.col("both"), F.col("both") - 1
    every = kept + gained + lost
    own = own.select("badge", F.col("old_size").alias("old_cluster_size"), F.col("new_size").alias("new_cluster_size"), gained.alias("gained_peers"), lost.alias("lost_peers"), F.when(every == 0, 1.0).otherwise(F.round(kept / F.nullif(every, F.lit(0)), 4)).alias("jaccard_peers"))
    return own.where("gained_peers > 0 OR lost_peers > 0")


def splits(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old clusters whose common badges are in several new ones."""
    sizes = old.groupBy(F.col("cluster").alias("o")).agg(F.count(F.lit(1)).alias("old_size"))
    found = common(old, new).groupBy("o").agg(F.count(F.lit(1)).alias("badges_in_common"), F.countDistinct("n").alias("split_into")).where("badges_in_common > 1 AND split_into > 1")
    return found.join(sizes, "o").select(F.col("o").alias("old_cluster"), "old_size", "badges_in_common", "split_into")


def merges(old: DataFrame, new: DataFrame) -> DataFrame:
    """New clusters whose common badges come from several old ones."""
    return splits(new, old).toDF("new_cluster", "new_size", "badges_in_common", "merged_from")


def identical(old: DataFrame, new: DataFrame) -> DataFrame:
    """(old_cluster, new_cluster, size) with the same members: as many in common as either has."""
    size = lambda runs, key: runs.groupBy(F.col("cluster").alias(key)).agg(F.count(F.lit(1)).alias(f"{key}_size"))
    shared = common(old, new).groupBy("o", "n").agg(F.count(F.lit(1)).alias("size"))
    same = shared.join(size(old, "o"), "o").join(size(new, "n"), "n").where("size = o_size AND size = n_size")
    return same.select(F.col("o").alias("old_cluster"), F.col("n").alias("new_cluster"), "size")


def corrections_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """A full outer join of corrections on the badge, with a status; a badge listed twice gives a row for each pairing."""
    side = lambda rows, name: rows.select("badge", F.lit(1).alias(f"in_{name}"), *(F.col(c).alias(f"{c}_{name}") for c in ("current", "recommended", "cluster")))
    both = side(old, "old").join(side(new, "new"), "badge", "full")
    return both.withColumn("status", diff_status("in_old", "in_new", "recommended_old", "recommended_new")).drop("in_old", "in_new")


def status_counts(diff: DataFrame) -> DataFrame:
    """(status, n) of all four statuses, 0 included."""
    every = diff.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, STATUSES))).alias("status"))
    return every.join(diff.groupBy("status").agg(F.count(F.lit(1)).alias("n")), "status", "left").fillna(0, ["n"])


def summary(old: DataFrame, new: DataFrame, old_corrections: DataFrame, new_corrections: DataFrame) -> DataFrame:
    """One row with the figures of a comparison."""
    one = [
        old.agg(F.countDistinct("badge").alias("old_badges"), F.countDistinct("cluster").alias("old_clusters")),
        new.agg(F.countDistinct("badge").alias("new_badges"), F.countDistinct("cluster").alias("new_clusters")),
        common(old, new).agg(F.count(F.lit(1)).alias("common_badges")),
        badge_changes(old, new).agg(F.count(F.lit(1)).alias("movers"), F.round(F.avg("jaccard_peers"), 3).alias("mean_jaccard")),
        splits(old, new).agg(F.count(F.lit(1)).alias("n_split")),
        merges(old, new).agg(F.count(F.lit(1)).alias("n_merged")),
        identical(old, new).agg(F.count(F.lit(1)).alias("n_identical")),
        corrections_diff(old_corrections, new_corrections).agg(*(F.count_if(F.col("status") == s).alias(s) for s in STATUSES)),
    ]
    out = one[0]
    for x in one[1:]:
        # Single rows.
        out = out.join(F.broadcast(x))
    return out.withColumns({"added": F.col("new_badges") - F.col("common_badges"), "dropped": F.col("old_badges") - F.col("common_badges")})


def report(row) -> str:
    """The figures as text."""
    return "\n".join(f"{k.replace('_', ' '):>22}: {v}" for k, v in row.asDict().items())


def metadata_changed(old: DataFrame, new: DataFrame, columns: list[str]) -> DataFrame:
    """Common badges with any of ``columns`` changed, old and new values side by side; two nulls are no change."""
    both = old.select("badge", *(F.col(c).alias(f"{c}_old") for c in columns)).join(new.select("badge", *(F.col(c).alias(f"{c}_new") for c in columns)), "badge")
    changed = F.lit(False)
    for c in columns:
        changed |= ~F.col(f"{c}_old").eqNullSafe(F.col(f"{c}_new"))
    return both.where(changed)
