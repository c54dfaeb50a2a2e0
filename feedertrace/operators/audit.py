"""The recorded mapping held against the clusters: votes, corrections, ranks, suppression, and quality of clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedertrace.config import DEFAULT, Config
from feedertrace.functions.scalar import normalize_id, share


def known_mapping(service_points: DataFrame, signature_badges: DataFrame) -> DataFrame:
    """(badge, transformer) of the asset register, cleaned, one row a badge, for badges that have a signature. A badge that
    the register has twice gets its smallest transformer: rows of a table have no first one."""
    from feedertrace.functions.scalar import strip

    rows = service_points.select(normalize_id(strip("BADGENUMBER")).alias("badge"), normalize_id(strip("TRANSFORMERBANKOBJECTID")).alias("transformer")).where("badge IS NOT NULL")
    one = rows.groupBy("badge").agg(F.min("transformer").alias("transformer"))
    return one.join(signature_badges.select("badge").distinct(), "badge", "left_semi")


def votes(clusters: DataFrame, mapping: DataFrame) -> DataFrame:
    """(cluster, transformer, votes) of mapped members."""
    return clusters.join(mapping, "badge").where("transformer IS NOT NULL").groupBy("cluster", "transformer").agg(F.count(F.lit(1)).alias("votes"))


def majority(tally: DataFrame) -> DataFrame:
    """(cluster, transformer, votes) with most votes; ties go to the smallest id, as a number where it is one."""
    order = F.struct(-F.col("votes"), F.coalesce(F.col("transformer").try_cast("double"), F.lit(float("inf"))), "transformer")
    return tally.groupBy("cluster").agg(F.min_by(F.struct("transformer", "votes"), order).alias("s")).select("cluster", "s.transformer", "s.votes")


def corrections(clusters: DataFrame, mapping: DataFrame) -> DataFrame:
    """(badge, cluster, current, recommended): members whose transformer is not their cluster's majority; unmapped ones too."""
    top = majority(votes(clusters, mapping)).select("cluster", F.col("transformer").alias("recommended"))
    own = clusters.join(mapping, "badge").join(top, "cluster")
    return own.where(~F.col("transformer").eqNullSafe(F.col("recommended"))).select("badge", "cluster", F.col("transformer").alias("current"), "recommended")


def suppress(found: DataFrame, ignored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, suppressed) by the list of (badge, recommended) pairs to ignore."""
    pairs = ignored.select(normalize_id("badge").alias("badge"), normalize_id("recommended").alias("recommended")).distinct()
    own = found.withColumn("recommended", normalize_id("recommended"))
    return own.join(pairs, ["badge", "recommended"], "left_anti"), own.join(pairs, ["badge", "recommended"], "left_semi")


def cluster_sizes(clusters: DataFrame, mapping: DataFrame) -> DataFrame:
    """(cluster, cluster_size, mapped_peers)."""
    return clusters.join(mapping, "badge", "left").groupBy("cluster").agg(F.count(F.lit(1)).alias("cluster_size"), F.count("transformer").alias("mapped_peers"))


def newly_flagged(diff: DataFrame) -> DataFrame:
    """The corrections that ``compare.corrections_diff`` has as new, as input for ``rank_corrections``."""
    return diff.where("status = 'newly_flagged'").select("badge", F.col("cluster_new").alias("cluster"), F.col("current_new").alias("current"), F.col("recommended_new").alias("recommended"))


def rank_corrections(found: DataFrame, clusters: DataFrame, mapping: DataFrame) -> DataFrame:
    """``found`` with votes for both transformers, majority_share and confidence_gap."""
    tally = votes(clusters, mapping)
    now = tally.select("cluster", F.col("transformer").alias("current"), F.col("votes").alias("current_votes"))
    then = tally.select("cluster", F.col("transformer").alias("recommended"), F.col("votes").alias("majority_votes"))
    out = found.join(now, ["cluster", "current"], "left").join(then, ["cluster", "recommended"], "left").join(cluster_sizes(clusters, mapping), "cluster", "left")
    out = out.fillna(0, ["current_votes", "majority_votes"])
    return out.select(
        "badge", "current", "recommended", "cluster", "cluster_size", "mapped_peers", "current_votes", "majority_votes",
        share("majority_votes", "mapped_peers").alias("majority_share"), share(F.col("majority_votes") - F.col("current_votes"), "mapped_peers").alias("confidence_gap"),
    )


def best_first(ranked: DataFrame) -> DataFrame:
    return ranked.orderBy(F.desc_nulls_last("confidence_gap"), F.desc_nulls_last("mapped_peers"), "badge")


def rank_summary(ranked: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Median and upper quartile of the gap, and how many are strong."""
    strong = (F.col("confidence_gap") >= config.min_gap) & (F.col("mapped_peers") >= config.min_mapped)
    quartiles = F.percentile("confidence_gap", F.array(F.lit(0.5), F.lit(0.75)))
    return ranked.agg(F.count(F.lit(1)).alias("n"), quartiles.alias("q"), F.count_if(strong).alias("n_strong")).select("n", F.round(F.get("q", 0), 6).alias("median_gap"), F.round(F.get("q", 1), 6).alias("upper_gap"), "n_strong")


def cluster_purity(clusters: DataFrame, mapping: DataFrame) -> DataFrame:
    """(cluster, n_transformers) of clusters with mapped members."""
    return clusters.join(mapping, "badge").groupBy("cluster").agg(F.countDistinct("transformer").alias("n_transformers"))


def transformer_completeness(clusters: DataFrame, mapping: DataFrame) -> DataFrame:
    """(transformer, n_clusters)."""
    return clusters.join(mapping, "badge").where("transformer IS NOT NULL").groupBy("transformer").agg(F.countDistinct("cluster").alias("n_clusters"))


def evaluation(clusters: DataFrame, mapping: DataFrame) -> DataFrame:
    """Totals, and the shares of pure clusters and of whole transformers."""
    pure, whole = cluster_purity(clusters, mapping), transformer_completeness(clusters, mapping)
    totals = clusters.join(mapping, "badge").agg(F.countDistinct("badge").alias("n_badges"), F.countDistinct("cluster").alias("n_clusters"), F.countDistinct("transformer").alias("n_transformers"))
    a = pure.agg(F.count_if(F.col("n_transformers") > 1).alias("n_impure"), share(F.count_if(F.col("n_transformers") <= 1), F.count(F.lit(1))).alias("purity"))
    b = whole.agg(F.count_if(F.col("n_clusters") > 1).alias("n_split"), share(F.count_if(F.col("n_clusters") == 1), F.count(F.lit(1))).alias("completeness"))
    # Three single rows.
    return totals.join(F.broadcast(a)).join(F.broadcast(b))


def size_summary(clusters: DataFrame) -> DataFrame:
    """How cluster sizes are spread."""
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    q = F.percentile("size", F.array(*map(F.lit, (0.25, 0.5, 0.75))))
    out = sizes.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("size"), 6).alias("mean"), F.round(F.stddev_samp("size"), 6).alias("std"), F.min("size").alias("least"), q.alias("q"), F.max("size").alias("most"))
    return out.select("n", "mean", "std", "least", *(F.get("q", i).alias(f"p{p}") for i, p in enumerate((25, 50, 75))), "most")


def numbered_members(clusters: DataFrame) -> DataFrame:
    """Members with their place in the cluster, by badge."""
    return clusters.withColumn("place", F.row_number().over(Window.partitionBy("cluster").orderBy("badge")))
