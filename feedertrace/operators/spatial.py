"""Pairs of points within a radius."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedertrace.config import EARTH_RADIUS_M
from feedertrace.functions.scalar import haversine_m


def neighbors(points: DataFrame, *, radius_m: float = 175.0, max_abs_lat: float | None = None) -> DataFrame:
    """(badge_a, badge_b, dist_m) with badge_a < badge_b and a distance of at most ``radius_m``.

    Cells are as large as the radius at the highest latitude; columns close around the globe. One side is listed in
    its cell and the eight around it, the other in its own, so the join is an equi-join and each pair meets once.
    Points without finite coordinates have no neighbours. ``max_abs_lat`` saves a pass if it is known.
    """
    own = points.where("lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon)").select("badge", "lat", "lon")
    if max_abs_lat is None:
        max_abs_lat = own.agg(F.max(F.abs("lat"))).first()[0] or 0.0
    height = math.degrees(radius_m / EARTH_RADIUS_M) * (1 + 1e-9)
    ratio = math.sin(radius_m / (2 * EARTH_RADIUS_M)) / max(1e-12, math.cos(math.radians(min(90.0, max_abs_lat + height))))
    columns = max(1, int(360 // (math.degrees(2 * math.asin(ratio)) * (1 + 1e-9)))) if ratio < 1 else 1
    own = own.withColumns({"cy": F.floor(F.col("lat") / height), "cx": F.pmod(F.floor((F.col("lon") + 180) / (360 / columns)), F.lit(columns))})
    near = F.array_distinct(F.flatten(F.array(*(F.array(*(F.struct((F.col("cy") + y).alias("cy"), F.pmod(F.col("cx") + x, F.lit(columns)).alias("cx")) for x in (-1, 0, 1))) for y in (-1, 0, 1)))))
    a = own.select(F.col("badge").alias("badge_a"), F.col("lat").alias("lat_a"), F.col("lon").alias("lon_a"), F.explode(near).alias("c")).select("badge_a", "lat_a", "lon_a", "c.cy", "c.cx")
    b = own.select(F.col("badge").alias("badge_b"), F.col("lat").alias("lat_b"), F.col("lon").alias("lon_b"), "cy", "cx")
    dist = haversine_m("lat_a", "lon_a", "lat_b", "lon_b")
    return a.join(b, ["cy", "cx"]).where(F.col("badge_a") < F.col("badge_b")).where(dist <= radius_m).select("badge_a", "badge_b", dist.alias("dist_m"))


def split_located(badges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Badges with both coordinates, and the others."""
    there = F.coalesce(F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~F.isnan("lat") & ~F.isnan("lon"), F.lit(False))
    return badges.where(there), badges.where(~there)
