"""Runs remembered: counters per badge, pair and recommendation, and stabilities from them.

A run's counters come from its own rows; merging two counter tables is one aggregation over their union, so a
recording is a single new version of each table. A run id that is already there is refused before anything is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedertrace.config import DEFAULT, Config
from feedertrace.functions.scalar import normalize_id, share


def member_pairs(clusters: DataFrame) -> DataFrame:
    """(badge_a, badge_b) of all members of a cluster, badge_a < badge_b. A self-join on the cluster; its size is what is asked for."""
    a, b = clusters.select("cluster", F.col("badge").alias("badge_a")), clusters.select("cluster", F.col("badge").alias("badge_b"))
    return a.join(b, "cluster").where("badge_a < badge_b").select("badge_a", "badge_b")


def run_row(run_id: str, run_date: str, source: str, clusters: DataFrame) -> DataFrame:
    return clusters.agg(F.countDistinct("badge").alias("n_badges"), F.countDistinct("cluster").alias("n_clusters")).select(F.lit(run_id).alias("run_id"), F.lit(run_date).alias("run_date"), "n_badges", "n_clusters", F.lit(source).alias("source"))


def append_run(runs: DataFrame, row: DataFrame) -> DataFrame:
    """``runs`` with one more; a run id that is there already is an error."""
    if not runs.join(row.select("run_id"), "run_id", "left_semi").isEmpty():
        raise ValueError("this run is recorded already")
    return runs.unionByName(row)


def _merge(old: DataFrame, new: DataFrame, keys: list[str], count: str, first: str, last: str) -> DataFrame:
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return both.groupBy(*keys).agg(F.sum(count).cast("long").alias(count), F.min_by(first, "_new").alias(first), F.max_by(last, "_new").alias(last))


def add_presence(old: DataFrame, clusters: DataFrame, run_id: str) -> DataFrame:
    new = clusters.select("badge").distinct().select("badge", F.lit(1).cast("long").alias("n_runs_seen"), F.lit(run_id).alias("first_run"), F.lit(run_id).alias("last_run"))
    return _merge(old, new, ["badge"], "n_runs_seen", "first_run", "last_run")


def add_pairs(old: DataFrame, clusters: DataFrame, run_id: str) -> DataFrame:
    # A badge has one cluster in a run: where rows are distinct, so are pairs.
    new = member_pairs(clusters.select("badge", "cluster").distinct()).select("badge_a", "badge_b", F.lit(1).cast("long").alias("times_together"), F.lit(run_id).alias("first_together"), F.lit(run_id).alias("last_together"))
    return _merge(old, new, ["badge_a", "badge_b"], "times_together", "first_together", "last_together")


def add_recommendations(old: DataFrame, found: DataFrame, run_id: str) -> DataFrame:
    own = found.select("badge", normalize_id("recommended").alias("recommended")).where("badge IS NOT NULL AND recommended IS NOT NULL").distinct()
    new = own.select("badge", "recommended", F.lit(1).cast("long").alias("times_recommended"), F.lit(run_id).alias("first_run"), F.lit(run_id).alias("last_run"))
    return _merge(old, new, ["badge", "recommended"], "times_recommended", "first_run", "last_run")


def peer_stability(clusters: DataFrame, pairs: DataFrame, presence: DataFrame, n_runs: int) -> DataFrame:
    """(badge, peer_stability, peers_considered): over its peers, the mean share of common runs spent together.

    A badge that presence lacks counts as seen in all runs; a pair never together counts 0; a badge alone in its cluster
    has no stability and 0 peers. Only pairs that were together once are looked at: the others add nothing to the sum,
    and their number follows from the cluster's size, so a cluster's members are never paired here.
    """
    own = clusters.join(presence.select("badge", "n_runs_seen"), "badge", "left").select("badge", "cluster", F.coalesce("n_runs_seen", F.lit(n_runs)).alias("runs"))
    side = lambda s: own.select(F.col("badge").alias(f"badge_{s}"), F.col("cluster").alias(f"cluster_{s}"), F.col("runs").alias(f"runs_{s}"))
    met = pairs.select("badge_a", "badge_b", "times_together").join(side("a"), "badge_a").join(side("b"), "badge_b").where("cluster_a = cluster_b")
    met = met.withColumn("part", F.col("times_together") / F.nullif(F.least("runs_a", "runs_b"), F.lit(0)))
    sums = met.select(F.explode(F.array("badge_a", "badge_b")).alias("badge"), "part").groupBy("badge").agg(F.sum("part").alias("part"))
    sizes = own.groupBy("cluster").agg(F.count(F.when(F.col("runs") > 0, 1)).alias("size"))
    out = own.join(sizes, "cluster").join(sums, "badge", "left").withColumn("peers_considered", F.when(F.col("runs") > 0, F.col("size") - 1).otherwise(0))
    return out.select("badge", F.round(F.coalesce("part", F.lit(0.0)) / F.nullif("peers_considered", F.lit(0)), 3).alias("peer_stability"), "peers_considered")


def corrections_with_stability(ranked: DataFrame, clusters: DataFrame, pairs: DataFrame, presence: DataFrame, recommendations: DataFrame, n_runs: int) -> DataFrame:
    own = ranked.withColumns({"recommended": normalize_id("recommended"), "current": normalize_id("current")})
    own = own.join(peer_stability(clusters, pairs, presence, n_runs), "badge", "left")
    own = own.join(recommendations.select("badge", "recommended", "times_recommended"), ["badge", "recommended"], "left")
    own = own.join(presence.select("badge", F.col("n_runs_seen").alias("badge_n_runs")), "badge", "left")
    own = own.withColumns({"times_recommended": F.coalesce("times_recommended", F.lit(0)), "badge_n_runs": F.coalesce("badge_n_runs", F.lit(n_runs))})
    return own.withColumn("recommendation_stability", share("times_recommended", "badge_n_runs", 3))


def high_confidence(found: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Rows that pass all four gates; a gate whose column is missing is open."""
    gates = {"confidence_gap": config.min_gap, "mapped_peers": config.min_mapped, "peer_stability": config.min_peer_stability, "recommendation_stability": config.min_recommendation_stability}
    ok: Column = F.lit(True)
    for name, least in gates.items():
        if name in found.columns:
            ok &= F.coalesce(F.col(name) >= least, F.lit(False))
    return found.where(ok)


def most_stable_first(found: DataFrame) -> DataFrame:
    return found.orderBy(F.desc_nulls_last("recommendation_stability"), F.desc_nulls_last("peer_stability"), "badge")


def badge_summary(stability: DataFrame, presence: DataFrame) -> DataFrame:
    """Stability per badge; a badge that presence lacks was seen in 0 runs here."""
    return stability.join(presence.select("badge", "n_runs_seen"), "badge", "left").fillna(0, ["n_runs_seen"])
