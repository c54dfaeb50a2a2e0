"""Results with what the asset register knows: addresses, places, feeders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedertrace.functions.scalar import blank_to_null, haversine_m, normalize_id, recommendation_type, share, strip, to_number
from feedertrace.operators import audit


#: What is reported of a transformer.
UNIT = ("structure", "feeder", "subtype", "vault", "lat", "lon", "kva")


def service_points(rows: DataFrame) -> DataFrame:
    """The register's meters, cleaned, one row a badge (the first by its columns)."""
    own = rows.select(
        normalize_id(strip("BADGENUMBER")).alias("badge"), normalize_id(blank_to_null("TRANSFORMERBANKOBJECTID")).alias("gis_transformer"), blank_to_null("TRANSBANKTAG").alias("bank_tag"),
        F.col("CCBADDRESS1").alias("address"), F.col("CCBCITY").alias("city"), to_number("POINT_X").alias("lon"), to_number("POINT_Y").alias("lat"), F.col("d_FEEDERID").alias("feeder"),
    ).where("badge IS NOT NULL")
    rest = own.columns[1:]
    return own.groupBy("badge").agg(F.min(F.struct(*rest)).alias("s")).select("badge", "s.*")


def transformers(rows: DataFrame) -> DataFrame:
    """The register's transformers, one row a tag."""
    own = rows.select(blank_to_null("TAG").alias("tag"), F.col("STRUCTNO").alias("structure"), F.col("FEEDERID").alias("feeder_raw"), F.col("d_FEEDERID").alias("feeder"), F.col("d_SUBTYPECD").alias("subtype"), F.col("VAULTCD").alias("vault"), to_number("POINT_X").alias("lon"), to_number("POINT_Y").alias("lat"), to_number("TOTALKVA").alias("kva")).where("tag IS NOT NULL")
    return own.groupBy("tag").agg(F.min(F.struct(*own.columns[1:])).alias("s")).select("tag", "s.*")


def transformer_lookup(points: DataFrame, units: DataFrame) -> DataFrame:
    """(transformer, feeder, structure, lon, lat, kva ...): bank ids with the unit of their tag."""
    bridge = points.where("gis_transformer IS NOT NULL AND bank_tag IS NOT NULL").groupBy(F.col("gis_transformer").alias("transformer")).agg(F.min("bank_tag").alias("tag"))
    return bridge.join(units, "tag", "left").drop("tag")


def enrich_corrections(found: DataFrame, points: DataFrame, lookup: DataFrame, model: DataFrame) -> DataFrame:
    """Corrections with the meter's address, feeder and places, all that the register has of both transformers (raw feeder
    codes apart), their distances from the meter's place in the register, and a type.

    ``model`` has badge, lat and lon. Dimension tables are joined without hints: Spark broadcasts what is small.
    """
    meter = points.select("badge", "address", "city", F.col("feeder").alias("badge_feeder"), F.col("lon").alias("gis_lon"), F.col("lat").alias("gis_lat"))
    own = found.join(meter, "badge", "left").join(model.select("badge", F.col("lat").alias("model_lat"), F.col("lon").alias("model_lon")), "badge", "left")
    for side in ("current", "recommended"):
        unit = lookup.select(F.col("transformer").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in UNIT))
        own = own.join(unit, side, "left").withColumn(f"{side}_distance_m", F.round(haversine_m("gis_lat", "gis_lon", f"{side}_lat", f"{side}_lon"), 1))
    own = own.withColumn("model_gis_distance_m", F.round(haversine_m("model_lat", "model_lon", "gis_lat", "gis_lon"), 1))
    own = own.withColumn("location_differs", F.coalesce(F.col("model_gis_distance_m") > 100, F.lit(False)))
    return own.withColumn("recommendation_type", recommendation_type("current", "current_feeder", "recommended_feeder"))


def missing_from_register(clusters: DataFrame, points: DataFrame, active: DataFrame, mapping: DataFrame, lookup: DataFrame) -> DataFrame:
    """Recently active clustered badges that the register lacks, with their cluster's majority and what the register has
    of that transformer; the surest first."""
    own = clusters.join(points.select("badge"), "badge", "left_anti").join(active.select("badge").distinct(), "badge", "left_semi")
    top = audit.majority(audit.votes(clusters, mapping)).select("cluster", F.col("transformer").alias("majority_transformer"), F.col("votes").alias("majority_votes"))
    own = own.join(audit.cluster_sizes(clusters, mapping), "cluster").join(top, "cluster", "left").fillna(0, ["majority_votes"])
    own = own.withColumn("majority_share", share("majority_votes", "mapped_peers", 3))
    unit = lookup.select(F.col("transformer").alias("majority_transformer"), *(F.col(c).alias(f"recommended_{c}") for c in UNIT if c != "subtype"))
    return own.join(unit, "majority_transformer", "left").orderBy(F.desc_nulls_last("majority_share"), F.desc("mapped_peers"), "badge")


def clusters_enriched(clusters: DataFrame, points: DataFrame, model: DataFrame) -> DataFrame:
    """All clustered badges with the register's and the model's view of them."""
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("cluster_size"))
    meter = points.select("badge", "gis_transformer", "bank_tag", "address", "city", F.col("lon").alias("gis_lon"), F.col("lat").alias("gis_lat"), "feeder")
    return clusters.join(meter, "badge", "left").join(model.select("badge", F.col("lat").alias("model_lat"), F.col("lon").alias("model_lon")), "badge", "left").join(sizes, "cluster")


def location_discrepancies(model: DataFrame, points: DataFrame, *, over_m: float = 100.0) -> DataFrame:
    """Badges whose two places are more than ``over_m`` apart, farthest first."""
    own = model.select("badge", F.col("lat").alias("model_lat"), F.col("lon").alias("model_lon")).join(points.select("badge", "address", "city", F.col("lat").alias("gis_lat"), F.col("lon").alias("gis_lon")), "badge")
    own = own.withColumn("distance_m", F.round(haversine_m("model_lat", "model_lon", "gis_lat", "gis_lon"), 1))
    return own.where(F.coalesce(F.col("distance_m") > over_m, F.lit(False))).orderBy(F.desc("distance_m"), "badge")
