"""The engine end to end: signatures to clusters, one day's correlations, and the weekly audit."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedertrace.config import DEFAULT, Config
from feedertrace.operators import audit, edges, history, ledger, signature, spatial
from feedertrace.operators.correlate import pearson_arrays, pearson_long
from feedertrace.session import materialize
from feedertrace.sources.metering import Versions


def infer_clusters(signatures: DataFrame, badges: DataFrame, config: Config = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(clusters, excluded): clusters of badges whose signatures agree, and the badges without a place."""
    located, excluded = spatial.split_located(badges)
    pairs = spatial.neighbors(located, radius_m=config.radius_m)
    scored = materialize(pearson_arrays(signatures, pairs, min_overlap=config.min_overlap), "scored")
    links = edges.mutual(edges.top_k(scored, min_r=config.min_correlation, k=config.top_k))
    return edges.clusters(located, links), excluded.select("badge")


def correlate_day(measurements: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(badge_a, badge_b, day, r) of neighbours, for each day of ``measurements``."""
    own = materialize(signature.day_signatures(measurements, config), "day")
    pairs = spatial.neighbors(own.groupBy("badge").agg(F.min("lat").alias("lat"), F.min("lon").alias("lon")), radius_m=config.radius_m)
    return pearson_long(own, pairs, at=["day", "slot"], min_overlap=config.min_daily_overlap, by=["day"]).select("badge_a", "badge_b", "day", "r")


def backfill(measurements: DataFrame, store: Versions, config: Config = DEFAULT, *, start: date | None = None, every: bool = False, resume: bool = False, overwrite: bool = False, save_every: int = 5) -> DataFrame:
    """The pair ledger at ``store`` brought up from stored days, oldest first, ``save_every`` days to a new version.

    Days: from ``start`` on if it is given, else all (``every``), else the latest ``config.window_days``. ``resume`` goes on
    from the ledger there is; without it a ledger that has rows is an error unless ``overwrite`` says that it may go.
    ``measurements`` has badge, ts, day, pu, ingest, lat and lon; days are read by their partitions.
    """
    days = sorted(r[0] for r in measurements.select("day").where("day IS NOT NULL").distinct().collect())
    days = [d for d in days if d >= start] if start else days if every else days[-config.window_days :]
    if not days:
        raise ValueError("no days in the range")
    if not resume:
        if not overwrite and not store.read().isEmpty():
            raise ValueError("there is a ledger already: say resume or overwrite")
        store.write(store.spark.createDataFrame([], store.schema))
    for at in range(0, len(days), save_every):
        part = days[at : at + save_every]
        rows = correlate_day(measurements.where(F.col("day").isin(part)), config)
        store.write(ledger.extend(store.read(), rows, keep=config.ledger_values))
    return store.read()


def weekly_audit(clusters: DataFrame, mapping: DataFrame, ignored: DataFrame, runs: dict[str, DataFrame], run_id: str, run_date: str, source: str) -> dict[str, DataFrame]:
    """All tables of an audit. ``runs`` has the history so far: runs, presence, pairs, recommendations."""
    kept, suppressed = audit.suppress(audit.corrections(clusters, mapping), ignored)
    ranked = audit.rank_corrections(kept, clusters, mapping)
    history_of = {
        "runs": history.append_run(runs["runs"], history.run_row(run_id, run_date, source, clusters)),
        "presence": history.add_presence(runs["presence"], clusters, run_id),
        "pairs": history.add_pairs(runs["pairs"], clusters, run_id),
        "recommendations": history.add_recommendations(runs["recommendations"], kept, run_id),
    }
    n_runs = history_of["runs"].count()
    stable = history.corrections_with_stability(ranked, clusters, history_of["pairs"], history_of["presence"], history_of["recommendations"], n_runs)
    return history_of | {"corrections": kept, "suppressed": suppressed, "ranked": ranked, "stable": stable, "high_confidence": history.high_confidence(stable)}
