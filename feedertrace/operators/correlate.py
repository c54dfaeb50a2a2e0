"""Overlap-aware Pearson correlation of pairs.

``pearson_long`` is relational and partitions by pair; ``pearson_arrays`` correlates ready arrays, a batch of pairs at a
time in numpy, and is the way for long signatures: a pair is one row, not one row per sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pearson(x: Column | str, y: Column | str) -> Column:
    """Correlation as an aggregate: null where a side is constant, held within -1 and 1."""
    spread = F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))
    r = F.covar_pop(x, y) / spread
    return F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def pearson_long(values: DataFrame, pairs: DataFrame, *, at: list[str], min_overlap: int, by: list[str] | None = None) -> DataFrame:
    """(badge_a, badge_b, *by, r, n) for ``pairs`` with ``min_overlap`` common samples and no constant side.

    ``values`` has badge, the columns ``at`` that say when, and pu; samples that are null do not count. ``by`` (part of
    ``at``) gives a correlation for each of its values, such as each day.
    """
    by = by or []
    own = values.where("pu IS NOT NULL AND NOT isnan(pu)")
    a = own.select(F.col("badge").alias("badge_a"), *at, F.col("pu").alias("x"))
    b = own.select(F.col("badge").alias("badge_b"), *at, F.col("pu").alias("y"))
    met = pairs.select("badge_a", "badge_b").join(a, "badge_a").join(b, ["badge_b", *at])
    out = met.groupBy("badge_a", "badge_b", *by).agg(pearson("x", "y").alias("r"), F.count(F.lit(1)).alias("n"))
    return out.where((F.col("n") >= min_overlap) & F.col("r").isNotNull())


def masked_pearson(x: np.ndarray, y: np.ndarray, min_overlap: int) -> np.ndarray:
    """Row-wise correlation of two matrices over the samples finite in both; NaN below the overlap or if constant."""
    both = np.isfinite(x) & np.isfinite(y)
    n = both.sum(axis=1)
    some = np.maximum(n, 1)
    x, y = np.where(both, x, 0.0), np.where(both, y, 0.0)
    x = np.where(both, x - (x.sum(axis=1) / some)[:, None], 0.0)
    y = np.where(both, y - (y.sum(axis=1) / some)[:, None], 0.0)
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    spread = np.sqrt(xx) * np.sqrt(yy)
    ok = (n >= min_overlap) & (spread > 0)
    return np.where(ok, np.clip((x * y).sum(axis=1) / np.where(ok, spread, 1.0), -1.0, 1.0), np.nan)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.float64) for v in column], dtype=np.float64)


def _pearson_batches(min_overlap: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at : at + 512]
                r = masked_pearson(_matrix(part["x"]), _matrix(part["y"]), min_overlap)
                yield pd.DataFrame({"badge_a": part["badge_a"], "badge_b": part["badge_b"], "r": r})[np.isfinite(r)]

    return run


def pearson_arrays(signatures: DataFrame, pairs: DataFrame, *, min_overlap: int) -> DataFrame:
    """(badge_a, badge_b, r) for ``pairs``; ``signatures`` has badge and signature, arrays of one length."""
    a = signatures.select(F.col("badge").alias("badge_a"), F.col("signature").alias("x"))
    b = signatures.select(F.col("badge").alias("badge_b"), F.col("signature").alias("y"))
    met = pairs.select("badge_a", "badge_b").join(a, "badge_a").join(b, "badge_b")
    return met.select("badge_a", "badge_b", "x", "y").mapInPandas(_pearson_batches(min_overlap), "badge_a string, badge_b string, r double")
