"""Measurements to signatures: deduplication, the time grid, rolling windows, and the badge dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedertrace.config import DEFAULT, Config


def finite(c: Column | str) -> Column:
    """Null for NaN and infinities: a missing value is null everywhere."""
    value = F.col(c) if isinstance(c, str) else c
    return F.when(F.isnan(value) | (F.abs(value) == float("inf")), None).otherwise(value)


def dedup_last(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``. Combined before the shuffle, so repeated keys travel once per task."""
    rest = [c for c in rows.columns if c not in keys]
    latest = F.max(F.struct(*order, *(F.col(c).alias(f"_{c}") for c in rest))).alias("s")
    return rows.groupBy(*keys).agg(latest).select(*keys, *(F.col(f"s._{c}").alias(c) for c in rest))


def first_row(rows: DataFrame, key: str, ts: str, values: list[str]) -> DataFrame:
    """The values of each key's first row by ``ts``, nulls included."""
    return rows.groupBy(key).agg(F.min_by(F.struct(*values), F.struct(ts, *values)).alias("s")).select(key, "s.*")


def first_values(rows: DataFrame, key: str, ts: str, values: list[str]) -> DataFrame:
    """For each key and column, the first value by ``ts`` that is not null."""
    return rows.groupBy(key).agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(ts, c))).alias(c) for c in values))


def align(rows: DataFrame, *, minutes: int = 15, ts: str = "ts") -> DataFrame:
    """Rows whose time is exactly on the grid, with their day and slot of the day."""
    seconds = F.unix_micros(F.col(ts).cast("timestamp"))
    step = minutes * 60 * 1_000_000
    return rows.where(F.pmod(seconds, F.lit(step)) == 0).withColumns({"day": F.to_date(ts), "slot": (F.pmod(seconds, F.lit(86_400_000_000)) / step).cast("int")})


def last_days(rows: DataFrame, n: int, *, day: str = "day") -> DataFrame:
    """Rows of the ``n`` days up to the latest; a filter on the partition column, so nothing is moved."""
    newest = rows.agg(F.max(day)).first()[0]
    return rows.where(F.lit(False)) if newest is None else rows.where(F.col(day) > F.date_sub(F.lit(newest), n))


def active_badges(rows: DataFrame, days: int = DEFAULT.recent_days, *, day: str = "day") -> DataFrame:
    """(badge) of all that have a row on one of the ``days`` latest days there are."""
    return latest_days(rows, days, day=day).where("badge IS NOT NULL").select("badge").distinct()


def latest_days(rows: DataFrame, n: int, *, day: str = "day", complete: bool = False) -> DataFrame:
    """Rows of the ``n`` latest days that have rows; with ``complete``, fewer are an error."""
    days = [r[0] for r in rows.select(day).where(F.col(day).isNotNull()).distinct().orderBy(F.desc(day)).limit(n).collect()]
    if complete and len(days) < n:
        raise ValueError(f"{len(days)} days; {n} are needed")
    return rows.where(F.col(day).isin(days)) if days else rows.where(F.lit(False))


def signatures(rows: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(badge, signature): per badge an array of ``config.signature_length`` floats, null where nothing was measured.

    ``rows`` has badge, ts, pu and ingest (the order of arrival): the last value of a time wins. The slot comes from the
    time itself, so a missing day leaves a gap and shifts nothing.
    """
    own = align(rows.select("badge", "ts", finite("pu").alias("pu"), "ingest"))
    own = dedup_last(own, ["badge", "day", "slot"], ["ingest"])
    own = last_days(own, config.window_days)
    newest = own.agg(F.max("day")).first()[0]
    per_day, n = config.intervals_per_day, config.signature_length
    at = F.datediff("day", F.date_sub(F.lit(newest), config.window_days - 1)) * per_day + F.col("slot")
    # What was measured, in order, with an end mark behind the last slot; gaps are filled in one pass from one to the next.
    value = F.when(F.col("pu").isNotNull(), F.struct(at.alias("at"), F.col("pu").cast("float").alias("pu")))
    end = F.struct(F.lit(n).alias("at"), F.lit(None).cast("float").alias("pu"))
    held = own.groupBy("badge").agg(F.array_append(F.array_sort(F.collect_list(value)), end).alias("s"))

    def filled(own: Column) -> Column:
        # own: the list; bound here, it is sorted once.
        def step(x: Column, i: Column) -> Column:
            before = F.when(i == 0, -1).otherwise(F.get(own, i - 1)["at"])
            return F.concat(F.array_repeat(F.lit(None).cast("float"), x["at"] - before - 1), F.array(x["pu"]))

        return F.slice(F.flatten(F.transform(own, step)), 1, n)

    return held.select("badge", F.element_at(F.transform(F.array("s"), filled), 1).alias("signature"))


def day_signatures(rows: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(badge, day, slot, pu) of badges with enough values that day and finite coordinates in their first row."""
    own = align(rows.select("badge", "ts", finite("pu").alias("pu"), "ingest", "lat", "lon"))
    place = first_row(own, "badge", "ts", ["lat", "lon"]).where("lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon)")
    values = dedup_last(own.select("badge", "day", "slot", "pu", "ingest"), ["badge", "day", "slot"], ["ingest"]).where("pu IS NOT NULL").drop("ingest")
    enough = values.groupBy("badge", "day").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= config.min_daily_overlap).drop("n")
    return values.join(enough, ["badge", "day"], "left_semi").join(place, "badge")


def merge_badges(old: DataFrame, new: DataFrame, *, keep_known_place: bool = True) -> DataFrame:
    """The badge dimension after a day: new rows win; a missing new coordinate keeps the old one unless told otherwise."""
    names = [c for c in old.columns if c != "badge"]
    both = old.select("badge", *(F.col(c).alias(f"o_{c}") for c in names)).join(new.select("badge", F.lit(True).alias("seen"), *(F.col(c).alias(f"n_{c}") for c in names)), "badge", "full")
    pick = (lambda c: F.coalesce(f"n_{c}", f"o_{c}")) if keep_known_place else (lambda c: F.when(F.col("seen"), F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")))
    return both.select("badge", *(pick(c).alias(c) for c in names))


def added_removed(old: DataFrame, new: DataFrame) -> DataFrame:
    """(badge, change): added or removed."""
    a, b = old.select("badge").distinct(), new.select("badge").distinct()
    return b.join(a, "badge", "left_anti").withColumn("change", F.lit("added")).union(a.join(b, "badge", "left_anti").withColumn("change", F.lit("removed")))
