"""Scalar expressions. All are built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedertrace.config import EARTH_RADIUS_M

#: Texts that stand for no id.
NO_ID = ("nan", "None", "<NA>")
#: Nominal volts by device type: fixed values.
NOMINAL_VOLTS = {
    120.0: ("1", "1D", "55"),
    208.0: ("10N",),
    240.0: ("5", "52", "52M", "5D", "5E", "5ED", "5EN", "5L", "5N"),
}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_id(c: Column | str) -> Column:
    """An id as text: without a trailing .0, and null for the texts that stand for none."""
    text = F.regexp_replace(col(c).cast("string"), r"\.0+$", "")
    return F.when(text.isin(*NO_ID), None).otherwise(text)


def strip(c: Column | str) -> Column:
    """Without white space at both ends, tabs and line ends included."""
    return F.regexp_replace(F.regexp_replace(col(c), r"^\s+", ""), r"\s+$", "")


def blank_to_null(c: Column | str) -> Column:
    text = strip(c)
    return F.when(text.isin("", "nan", "None"), None).otherwise(text)


def to_number(c: Column | str) -> Column:
    """A double, or null where the text is no finite number."""
    value = col(c).cast("string").try_cast("double")
    return F.when(F.isnan(value) | (F.abs(value) == float("inf")), None).otherwise(value)


def split_location(c: Column | str) -> tuple[Column, Column]:
    """(lat, lon) of a text "LAT LONG" whose longitude lacks its sign."""
    parts = F.regexp_extract_all(col(c), F.lit(r"([^ ]+)"))
    return F.get(parts, 0).try_cast("double"), -F.get(parts, 1).try_cast("double")


def nominal_volts(device_type: Column | str, table: dict[float, tuple[str, ...]] = NOMINAL_VOLTS) -> Column:
    out = F.lit(None).cast("double")
    for volts, codes in table.items():
        out = F.when(col(device_type).isin(*codes), volts).otherwise(out)
    return out


def per_unit(actual: Column | str, nominal: Column | str) -> Column:
    """actual / nominal to 10 places; null without a nominal value."""
    return F.round(col(actual) / F.nullif(col(nominal), F.lit(0.0)), 10)


def share(part: Column | str, whole: Column | str, places: int = 4) -> Column:
    """part / whole, null where the whole is 0 or null."""
    return F.round(F.try_divide(col(part).cast("double"), col(whole).cast("double")), places)


def canonical_pair(a: Column | str, b: Column | str) -> tuple[Column, Column]:
    return F.least(col(a), col(b)), F.greatest(col(a), col(b))


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle metres."""
    lat1, lon1, lat2, lon2 = map(col, (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def slot_start(ts: Column | str, minutes: int = 15) -> Column:
    return F.window(col(ts), f"{minutes} minutes").start


def day_of_file(path: Column | str) -> Column:
    """The day in a file's name, else null."""
    return F.try_to_date(F.nullif(F.regexp_extract(col(path), r"(\d{4}-\d{2}-\d{2})[^/]*$", 1), F.lit("")), "yyyy-MM-dd")


def stamp(at: Column | str, form: str = "run") -> Column:
    """A time as text: for a run's id or a report's name ('run'), a run's date ('iso', of a UTC time) or a day's file ('day'). Times are given, not
    taken from a clock, so that a repeated run writes the same."""
    return F.date_format(col(at), {"run": "yyyy-MM-dd_HHmmss", "iso": "yyyy-MM-dd'T'HH:mm:ss'+00:00'", "day": "yyyy-MM-dd"}[form])


def recommendation_type(current_tx, current_feeder, recommended_feeder) -> Column:
    """new_assignment before unknown_feeder before same_feeder_ambiguous before cross_feeder_likely_gis_error."""
    a, b = col(current_feeder), col(recommended_feeder)
    return (
        F.when(col(current_tx).isNull(), "new_assignment")
        .when(a.isNull() | b.isNull(), "unknown_feeder")
        .when(a == b, "same_feeder_ambiguous")
        .otherwise("cross_feeder_likely_gis_error")
    )


def diff_status(in_old, in_new, old_value, new_value) -> Column:
    """newly_flagged, no_longer_flagged, recommendation_changed or unchanged."""
    return (
        F.when(col(in_old).isNull(), "newly_flagged")
        .when(col(in_new).isNull(), "no_longer_flagged")
        .when(~col(old_value).eqNullSafe(col(new_value)), "recommendation_changed")
        .otherwise("unchanged")
    )
