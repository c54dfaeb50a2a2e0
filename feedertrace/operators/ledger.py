"""Correlations of a pair over the days. The long table (badge_a, badge_b, day, r) is the truth; the ledger is a view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def accepted(daily: DataFrame) -> DataFrame:
    """One value per pair and day, the first to arrive; ``daily`` may have ``arrival``. With it, a day that comes after a
    later day of its pair is refused, as a single pass over arrivals would."""
    keys = ["badge_a", "badge_b"]
    if "arrival" not in daily.columns:
        return daily.groupBy(*keys, "day").agg(F.min("r").alias("r"))
    before = Window.partitionBy(*keys).orderBy("arrival", "day").rowsBetween(Window.unboundedPreceding, -1)
    own = daily.withColumn("_last", F.max("day").over(before))
    return own.where(F.col("_last").isNull() | (F.col("day") > F.col("_last"))).select(*keys, "day", "r")


def ledger(daily: DataFrame, *, keep: int = 60) -> DataFrame:
    """badge_a, badge_b, values (the last ``keep`` by day), historical_n, historical_mean, first_day, last_day."""
    rows = F.array_sort(F.collect_list(F.struct("day", "r")))
    own = daily.groupBy("badge_a", "badge_b").agg(rows.alias("s"), F.count(F.lit(1)).alias("historical_n"), F.avg("r").alias("historical_mean"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    last = F.slice("s", F.greatest(F.lit(1), F.size("s") - (keep - 1)), keep)
    return own.select("badge_a", "badge_b", F.transform(last, lambda x: x["r"]).alias("values"), "historical_n", "historical_mean", "first_day", "last_day")


def _mean(values: Column, start: Column | int, n: Column) -> Column:
    return F.reduce(F.slice(values, start, n), F.lit(0.0), lambda s, x: s + x) / F.nullif(n, F.lit(0))


def stats(own: DataFrame) -> DataFrame:
    """mean, std (0 below two values), trend (last third less first third, 0 below six) and n of each ledger row."""
    v, n = F.col("values"), F.size("values")
    third = F.floor(n / 3).cast("int")
    mean = _mean(v, 1, n)
    square = F.reduce(v, F.lit(0.0), lambda s, x: s + x * x) / F.nullif(n, F.lit(0))
    std = F.when(n < 2, 0.0).otherwise(F.sqrt(F.greatest(F.lit(0.0), square - mean * mean)))
    trend = F.when(n < 6, 0.0).otherwise(_mean(v, F.greatest(F.lit(1), n - third + 1), third) - _mean(v, 1, third))
    return own.select("badge_a", "badge_b", mean.alias("mean"), std.alias("std"), trend.alias("trend"), n.alias("n"))


def update(own: DataFrame, day_rows: DataFrame, *, keep: int = 60) -> DataFrame:
    """The ledger after one day's (badge_a, badge_b, day, r): a pair whose last day is that day or later stays as it is."""
    new = day_rows.groupBy("badge_a", "badge_b").agg(F.min_by("r", "day").alias("r"), F.min("day").alias("day"))
    both = own.join(new, ["badge_a", "badge_b"], "full")
    take = F.col("day").isNotNull() & (F.col("last_day").isNull() | (F.col("day") > F.col("last_day")))
    grown = F.concat(F.coalesce("values", F.array().cast("array<double>")), F.array("r"))
    grown = F.slice(grown, F.greatest(F.lit(1), F.size(grown) - (keep - 1)), keep)
    n = F.coalesce("historical_n", F.lit(0)) + 1
    mean = F.coalesce("historical_mean", F.lit(0.0))
    pick = lambda yes, no: F.when(take, yes).otherwise(F.col(no)).alias(no)
    return both.select("badge_a", "badge_b", pick(grown, "values"), pick(n, "historical_n"), pick(mean + (F.col("r") - mean) / n, "historical_mean"), pick(F.coalesce("first_day", "day"), "first_day"), pick(F.col("day"), "last_day"))


def extend(own: DataFrame, daily: DataFrame, *, keep: int = 60) -> DataFrame:
    """The ledger after any number of days at once, as ``update`` would leave it day by day: days up to a pair's last one
    change nothing. One aggregation and one join, whatever the number of days."""
    known = own.select("badge_a", "badge_b", F.col("last_day").alias("_last"))
    new = accepted(daily).join(known, ["badge_a", "badge_b"], "left").where("_last IS NULL OR day > _last")
    rows = F.array_sort(F.collect_list(F.struct("day", "r")))
    new = new.groupBy("badge_a", "badge_b").agg(rows.alias("s"), F.count(F.lit(1)).alias("m"), F.sum("r").alias("total"), F.min("day").alias("a"), F.max("day").alias("b"))
    both = own.join(new, ["badge_a", "badge_b"], "full")
    added = F.coalesce(F.transform("s", lambda x: x["r"]), F.array().cast("array<double>"))
    grown = F.concat(F.coalesce("values", F.array().cast("array<double>")), added)
    n, m = F.coalesce("historical_n", F.lit(0)), F.coalesce("m", F.lit(0))
    mean = (F.coalesce("historical_mean", F.lit(0.0)) * n + F.coalesce("total", F.lit(0.0))) / (n + m)
    return both.select(
        "badge_a", "badge_b", F.slice(grown, F.greatest(F.lit(1), F.size(grown) - (keep - 1)), keep).alias("values"), (n + m).cast("long").alias("historical_n"),
        F.when(m == 0, F.col("historical_mean")).otherwise(mean).alias("historical_mean"), F.coalesce("first_day", "a").alias("first_day"), F.coalesce("b", "last_day").alias("last_day"),
    )
