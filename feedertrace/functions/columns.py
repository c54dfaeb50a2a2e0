"""Shapes of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_present(rows: DataFrame, order: list[str], *, rest: bool = False) -> DataFrame:
    """The columns of ``order`` that there are, in that order, and with ``rest`` all others behind them."""
    have = [c for c in order if c in rows.columns]
    return rows.select(*have, *((c for c in rows.columns if c not in have) if rest else ()))


def side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two tables of one column next to each other, in order, the shorter one filled with nulls.

    A report of two short lists. Places come from range-sorted ranks, so a long list meets in no single task either.
    """
    from feedertrace.operators.edges import number

    a, b = left.columns[0], right.columns[0]
    ranked = [number(x.withColumn("_key", F.col(c)), "_key", "_i") for x, c in ((left.distinct(), a), (right.distinct(), b))]
    return ranked[0].join(ranked[1], "_i", "full").select(a, b)


def drop_null_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.dropna(subset=keys)


def copy_column(rows: DataFrame, name: str, to: str) -> DataFrame:
    return rows.withColumn(to, F.col(name))
