"""Queries of whole flows: stores and files written and read again, signatures, daily correlations, ledgers, audits."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedertrace import schemas
from feedertrace.config import Config
from feedertrace.functions import scalar as fx
from feedertrace.functions.columns import copy_column, select_present
from feedertrace.operators import audit, compare, enrich, history, ledger, signature
from feedertrace.plans import topology
from feedertrace.plans.catalog import ORACLES, PARTS, STAND_INS, Data, _d, query
from feedertrace.session import materialize, shared_dir
from feedertrace.sources import metering

DAILY = Config(min_daily_overlap=5)
STAND_INS |= {
    # Readings on the hours of a week's first day: many badges share a slot.
    "metered": ("events", ["CAST(user_id AS STRING) AS badge", "date_trunc('week', ts) + INTERVAL '1' HOUR * hour(ts) AS ts", "CASE WHEN event_id % 37 = 0 THEN NULL ELSE value / 120e0 END AS pu", "event_id AS ingest", "38.8e0 + (user_id % 20) * 0.0005e0 AS lat", "-77.0e0 - floor(user_id / 20) * 0.0006e0 AS lon"], "true"),
    "odd_times": ("events", ["event_id", "date_trunc('hour', ts) + INTERVAL '1' MINUTE * (event_id % 16) AS ts"], "true"),
    # The metering system's nine tables.
    "d1_msrmt": ("events", ["'C' || CAST(user_id AS STRING) AS measr_comp_id", "ts AS msrmt_dttm", "value AS msrmt_val", "CASE WHEN event_id % 11 = 0 THEN '301000' ELSE '501000' END AS msrmt_cond_flg", "event_id"], "true"),
    "d1_measr_comp": ("customer", ["'C' || CAST(c_custkey AS STRING) AS measr_comp_id", "'F' || CAST(c_custkey AS STRING) AS device_config_id", "CASE WHEN c_custkey % 12 = 0 THEN 'E-KWH' ELSE 'E-V2HVHA-15' END AS measr_comp_type_cd"], "true"),
    "d1_dvc_cfg": ("customer", ["'F' || CAST(c_custkey AS STRING) AS device_config_id", "CASE WHEN c_custkey % 10 = 0 THEN 'GAS1' ELSE 'EL1' END AS device_config_type_cd", "'D' || CAST(c_custkey AS STRING) AS d1_device_id"], "true"),
    "d1_dvc_cfg_type": ("region", ["CASE WHEN r_regionkey = 0 THEN 'EL1' WHEN r_regionkey = 1 THEN 'GAS1' ELSE 'K' || CAST(r_regionkey AS STRING) END AS device_config_type_cd", "CASE WHEN r_regionkey = 1 THEN 'G' ELSE 'E' END AS d1_svc_type_cd"], "true"),
    "d1_dvc": ("customer", ["'D' || CAST(c_custkey AS STRING) AS d1_device_id", "CASE c_custkey % 4 WHEN 0 THEN ' 1D ' WHEN 1 THEN '10N' WHEN 2 THEN '5ED' ELSE '99' END AS device_type_cd"], "true"),
    "d1_dvc_identifier": ("customer", ["'D' || CAST(c_custkey AS STRING) AS d1_device_id", "CASE WHEN c_custkey % 19 = 0 THEN 'D1SN' ELSE 'D1BN' END AS dvc_id_type_flg", "'B' || CAST(c_custkey AS STRING) AS id_value"], "true"),
    "d1_install_evt": ("customer", ["'F' || CAST(c_custkey AS STRING) AS device_config_id", "'P' || CAST(c_custkey AS STRING) AS d1_sp_id", "CASE WHEN c_custkey % 23 = 0 THEN 'gone' END AS d1_removal_dttm"], "true"),
    "d1_sp_identifier": ("customer", ["'P' || CAST(c_custkey AS STRING) AS d1_sp_id", "'D1EP' AS sp_id_type_flg", "'R' || CAST(c_custkey AS STRING) AS id_value"], "true"),
    "ci_prem_geo": ("customer", ["'R' || CAST(c_custkey AS STRING) AS prem_id", "CASE WHEN c_custkey % 9 = 0 THEN 'XY' ELSE 'LAT/LONG' END AS geo_type_cd", "CAST(38 + c_custkey % 5 AS STRING) || '.5  77.25' AS geo_val"], "true"),
}
_NEW = ("metered", "odd_times", "d1_msrmt", "d1_measr_comp", "d1_dvc_cfg", "d1_dvc_cfg_type", "d1_dvc", "d1_dvc_identifier", "d1_install_evt", "d1_sp_identifier", "ci_prem_geo")
PARTS |= {k: f"SELECT {', '.join(STAND_INS[k][1])} FROM {STAND_INS[k][0]}" for k in _NEW}
PARTS["kept_readings"] = "SELECT badge, CAST(ts AS DATE) AS day, hour(ts) * 4 AS slot, pu, lat, lon FROM (SELECT *, row_number() OVER (PARTITION BY badge, ts ORDER BY ingest DESC) AS i FROM metered) WHERE i = 1"
PARTS["enough"] = "SELECT badge, day, slot, pu, lat, lon FROM kept_readings JOIN (SELECT badge, day FROM kept_readings WHERE pu IS NOT NULL GROUP BY ALL HAVING count(*) >= 5) USING (badge, day) WHERE pu IS NOT NULL"
PARTS["day_places"] = "SELECT DISTINCT badge, lat, lon FROM enough"
PARTS["day_pairs"] = f"SELECT a.badge AS badge_a, b.badge AS badge_b FROM day_places a JOIN day_places b ON a.badge < b.badge AND {_d('a.', 'b.')} <= 175"
PARTS["day_r"] = "SELECT badge_a, badge_b, a.day, corr(a.pu, b.pu) AS r FROM day_pairs JOIN enough a ON a.badge = badge_a JOIN enough b ON b.badge = badge_b AND b.day = a.day AND b.slot = a.slot GROUP BY ALL HAVING count(*) >= 5 AND corr(a.pu, b.pu) IS NOT NULL"


def _place(d: Data, label: str) -> str:
    return f"{shared_dir(d.spark)}/tables/{label}-{uuid.uuid4().hex}"


def _stored(d: Data) -> DataFrame:
    """The readings by way of a day store."""
    path = _place(d, "days")
    metering.write_days(d.metered, path)
    return metering.read_days(d.spark, path)


# Sources and sinks.
query(
    "metering_join",
    """SELECT event_id, i.id_value AS badge, trim(device_type_cd) AS device_type, CASE WHEN geo_type_cd = 'LAT/LONG' THEN CAST(split_part(geo_val, '  ', 1) AS DOUBLE) END AS lat, CASE WHEN geo_type_cd = 'LAT/LONG' THEN -77.25e0 END AS lon,
 CASE trim(device_type_cd) WHEN '1D' THEN 120e0 WHEN '10N' THEN 208e0 ELSE 240e0 END AS nominal, msrmt_val AS actual, round(msrmt_val / CASE trim(device_type_cd) WHEN '1D' THEN 120e0 WHEN '10N' THEN 208e0 ELSE 240e0 END, 10) AS pu
 FROM d1_msrmt m JOIN d1_measr_comp c USING (measr_comp_id) JOIN d1_dvc_cfg f USING (device_config_id) JOIN d1_dvc_cfg_type USING (device_config_type_cd) JOIN d1_dvc v ON v.d1_device_id = f.d1_device_id JOIN d1_dvc_identifier i ON i.d1_device_id = v.d1_device_id
 JOIN d1_install_evt e ON e.device_config_id = c.device_config_id JOIN d1_sp_identifier s ON s.d1_sp_id = e.d1_sp_id LEFT JOIN ci_prem_geo g ON g.prem_id = s.id_value
 WHERE msrmt_cond_flg = '501000' AND measr_comp_type_cd = 'E-V2HVHA-15' AND d1_svc_type_cd = 'E' AND dvc_id_type_flg = 'D1BN' AND d1_removal_dttm IS NULL AND trim(device_type_cd) IN ('1D', '10N', '5ED')""",
)(lambda d: _metering(d))


def _metering(d: Data) -> DataFrame:
    names = "d1_msrmt d1_measr_comp d1_dvc_cfg d1_dvc_cfg_type d1_dvc d1_dvc_identifier d1_install_evt d1_sp_identifier ci_prem_geo".split()
    rows = metering.metering_rows({n: getattr(d, n) for n in names})
    times = d.table("events").select("event_id", "ts", F.concat(F.lit("B"), "user_id").alias("badge"))
    return rows.join(times, ["badge", "ts"]).select("event_id", "badge", "device_type", "lat", "lon", "nominal", "actual", F.round("pu", 10).alias("pu"))


query("jdbc_hours", "SELECT h, count(ts) AS n FROM (SELECT unnest(range(24)) AS h) LEFT JOIN (SELECT ts FROM readings WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM readings)) ON hour(ts) = h GROUP BY h")(lambda d: _hours(d))


def _hours(d: Data) -> DataFrame:
    """The ranges of a partitioned database read, each counted over the readings."""
    day = d.readings.agg(F.max(F.to_date("ts"))).first()[0]
    counts = [F.struct(F.lit(h).cast("long").alias("h"), F.count(F.when(F.expr(p), 1)).alias("n")) for h, p in enumerate(metering.hourly_predicates(day, "ts"))]
    return d.readings.agg(F.array(*counts).alias("x")).select(F.inline("x"))


query("day_store", "SELECT day, count(*) AS n, count(DISTINCT badge) AS badges FROM (SELECT badge, CAST(ts AS DATE) AS day FROM metered) WHERE day >= (SELECT max(CAST(ts AS DATE)) FROM metered) - 14 GROUP BY day")(lambda d: _day_store(d))


def _day_store(d: Data) -> DataFrame:
    """All days written, the newest written again, and the last fifteen days read."""
    path = _place(d, "store")
    rows = d.metered.withColumn("day", F.to_date("ts"))
    newest = rows.agg(F.max("day")).first()[0]
    metering.write_days(rows, path)
    metering.write_days(rows.where(F.col("day") == F.lit(newest)), path)
    return metering.read_days(d.spark, path, since=newest - timedelta(days=14)).groupBy(F.col("day").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("badge").alias("badges"))


query("missing_days", "SELECT CAST(x AS DATE) AS day FROM (SELECT unnest(generate_series((SELECT min(CAST(ts AS DATE)) FROM metered), (SELECT max(CAST(ts AS DATE)) FROM metered), INTERVAL 1 DAY)) AS x) WHERE CAST(x AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM metered)")(lambda d: _missing(d))


def _missing(d: Data) -> DataFrame:
    path = _place(d, "store")
    metering.write_days(d.metered, path)
    a, b = d.metered.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    return metering.missing_days(d.spark, path, a, b)


query("csv_service_points", "SELECT * FROM points")(lambda d: _csv(d, d.register_points, schemas.SERVICE_POINTS, enrich.service_points))
query("csv_transformers", "SELECT * FROM unit_rows")(lambda d: _csv(d, d.register_units, schemas.TRANSFORMERS, enrich.transformers))


def _csv(d: Data, rows: DataFrame, schema, clean) -> DataFrame:
    """A register written as CSV and read again by the preferred one of two places."""
    path = _place(d, "csv")
    metering.write_csv(rows, path)
    return clean(metering.preferred(d.spark, [f"{path}-none", path], schema))


query("latest_file", "SELECT 2 AS version, count(*) AS n FROM readings")(lambda d: _latest(d))


def _latest(d: Data) -> DataFrame:
    """Two exports, and the rows of the one written last."""
    path = _place(d, "exports")
    d.readings.limit(10).coalesce(1).withColumn("version", F.lit(1)).write.parquet(f"{path}/1")
    d.readings.coalesce(1).withColumn("version", F.lit(2)).write.parquet(f"{path}/2")
    newest = metering.latest_file(d.spark, f"{path}/*/*.parquet")
    return d.spark.read.parquet(newest).groupBy("version").agg(F.count(F.lit(1)).alias("n"))


query("file_days", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders")(
    lambda d: d.table("orders").select("o_orderkey", fx.day_of_file(F.when(F.col("o_orderkey") % 5 == 0, F.lit("/a/2020-01-01/readings.parquet")).otherwise(F.concat(F.lit("/a/readings_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".parquet")))).alias("day"))
)
query("first_recording", "SELECT badge, 1 AS n_runs_seen, 'r1' AS first_run, 'r1' AS last_run FROM new_run")(
    lambda d: history.add_presence(metering.load_or_empty(d.spark, _place(d, "none"), schemas.PRESENCE), d.new_run, "r1")
)
query("stamps", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d_%H%M%S') AS run, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') AS iso, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")(
    lambda d: d.table("orders").select("o_orderkey", *(fx.stamp("o_orderdate", k).alias(k) for k in ("run", "iso", "day")))
)

# Signatures and correlations.
query("aligned", "SELECT CAST(ts AS DATE) AS day, hour(ts) * 4 + minute(ts) // 15 AS slot, count(*) AS n FROM odd_times WHERE minute(ts) % 15 = 0 GROUP BY ALL")(
    lambda d: signature.align(d.odd_times).groupBy("day", "slot").agg(F.count(F.lit(1)).alias("n"))
)
query(
    "signatures",
    "SELECT badge, 5760 AS length, count(pu) AS n, round(coalesce(sum(CAST(CAST(pu AS FLOAT) AS DOUBLE) * (date_diff('day', (SELECT max(day) - 59 FROM kept_readings), day) * 96 + slot + 1)), 0), 1) AS weighted FROM kept_readings WHERE day > (SELECT max(day) FROM kept_readings) - 60 GROUP BY badge",
)(lambda d: signature.signatures(_stored(d)).select("badge", F.size("signature").alias("length"), F.size(F.array_compact("signature")).cast("long").alias("n"), F.round(_weighted("signature"), 1).alias("weighted")))


def _weighted(c: str):
    return F.aggregate(F.transform(c, lambda x, i: F.coalesce(x.cast("double") * (i + 1), F.lit(0.0))), F.lit(0.0), lambda s, x: s + x)


query("day_signatures", "SELECT badge, day, slot, round(pu, 9) AS pu, lat, lon FROM enough")(lambda d: signature.day_signatures(_stored(d), DAILY).withColumn("pu", F.round("pu", 9)))
query("day_counts", "SELECT badge, day, count(*) AS n FROM enough GROUP BY ALL")(lambda d: signature.day_signatures(d.metered, DAILY).groupBy("badge", "day").agg(F.count(F.lit(1)).alias("n")))
query("day_correlations", "SELECT badge_a, badge_b, day, round(r, 6) AS r FROM day_r")(lambda d: topology.correlate_day(_stored(d), DAILY).withColumn("r", F.round("r", 6)))
query("inferred_clusters")(lambda d: topology.infer_clusters(d.vectors.select("badge", "signature"), d.vectors.select("badge", "lat", "lon"), Config(min_correlation=0.15, top_k=3, min_overlap=64))[0])
ORACLES["inferred_clusters"] = ORACLES["clusters"]

# Ledgers.
_GROWN = "badge_a, badge_b, len(v) AS n, round(list_sum(v), 6) AS total, historical_n, round(historical_mean, 6) AS historical_mean, first_day, last_day"
PARTS["pair_years"] = "SELECT badge_a, badge_b, CAST(date_trunc('year', day) AS DATE) AS day, min(r) AS r FROM pair_days GROUP BY ALL"
PARTS["grown"] = "SELECT badge_a, badge_b, list(r ORDER BY day)[greatest(1, count(*) - 2):] AS v, count(*) AS historical_n, avg(r) AS historical_mean, min(day) AS first_day, max(day) AS last_day FROM pair_years GROUP BY ALL"
PARTS["last_two"] = "SELECT badge_a, badge_b, list(r ORDER BY day) AS v, count(*) AS historical_n, avg(r) AS historical_mean, min(day) AS first_day, max(day) AS last_day FROM day_r WHERE day IN (SELECT DISTINCT day FROM kept_readings ORDER BY day DESC LIMIT 2) GROUP BY ALL"
PARTS["all_days"] = "SELECT badge_a, badge_b, list(r ORDER BY day) AS v, count(*) AS historical_n, avg(r) AS historical_mean, min(day) AS first_day, max(day) AS last_day FROM day_r GROUP BY ALL"


def _shown(rows: DataFrame) -> DataFrame:
    total = F.reduce("values", F.lit(0.0), lambda s, x: s + x)
    return rows.select("badge_a", "badge_b", F.size("values").alias("n"), F.round(total, 6).alias("total"), "historical_n", F.round("historical_mean", 6).alias("historical_mean"), "first_day", "last_day")


def _years(d: Data) -> DataFrame:
    return materialize(d.pair_days.groupBy("badge_a", "badge_b", F.trunc("day", "year").alias("day")).agg(F.min("r").alias("r")), "years")


def _upserted(d: Data) -> DataFrame:
    """A ledger of three values brought on period by period through versions; the last period comes twice."""
    store, rows = metering.Versions(d.spark, _place(d, "ledger"), schemas.LEDGER), _years(d)
    days = sorted(r[0] for r in rows.select("day").distinct().collect())
    for day in [*days, days[-1]]:
        store.write(ledger.update(store.read(), rows.where(F.col("day") == F.lit(day)), keep=3))
    return store.read()


def _extended(d: Data) -> DataFrame:
    """The same in two steps of many periods, the second of which has the first's periods too."""
    rows = _years(d)
    cut = rows.agg(F.min("day")).first()[0] + timedelta(days=800)
    first = materialize(ledger.extend(d.empty(schemas.LEDGER), rows.where(F.col("day") < F.lit(cut)), keep=3), "ledger")
    return ledger.extend(first, rows, keep=3)


def _filled(d: Data, **choice) -> DataFrame:
    config = Config(min_daily_overlap=5, window_days=2)
    return topology.backfill(_stored(d), metering.Versions(d.spark, _place(d, "ledger"), schemas.LEDGER), config, save_every=2, **choice)


def _resumed(d: Data) -> DataFrame:
    """The latest days first, then all days on top: what came before a pair's last day stays out."""
    days, store = _stored(d), metering.Versions(d.spark, _place(d, "ledger"), schemas.LEDGER)
    first = sorted(r[0] for r in days.select("day").distinct().collect())[1]
    topology.backfill(days.where(F.col("day") <= F.lit(first)), store, DAILY, every=True)
    return topology.backfill(days, store, DAILY, start=first, resume=True, save_every=1)


query("ledger_upsert", f"SELECT {_GROWN} FROM grown")(lambda d: _shown(_upserted(d)))
query("ledger_extend", f"SELECT {_GROWN} FROM grown")(lambda d: _shown(_extended(d)))
query("backfill_latest", f"SELECT {_GROWN} FROM last_two")(lambda d: _shown(_filled(d)))
query("backfill_all", f"SELECT {_GROWN} FROM all_days")(lambda d: _shown(_filled(d, every=True)))
query("backfill_resume", f"SELECT {_GROWN} FROM all_days")(lambda d: _shown(_resumed(d)))

# Audits and reports.
query("run_log", "SELECT run AS run_id, run || '_date' AS run_date, count(DISTINCT badge) AS n_badges, count(DISTINCT cluster) AS n_clusters, 'file' AS source FROM three GROUP BY run")(lambda d: _runs(d))


def _runs(d: Data) -> DataFrame:
    out = d.empty(schemas.RUNS)
    for run, own in (("r1", d.old_run), ("r2", d.mid_run), ("r3", d.new_run)):
        out = history.append_run(out, history.run_row(run, f"{run}_date", "file", own))
    return out


PARTS["kept"] = "SELECT badge, cluster, \"current\", recommended FROM corrections WHERE (badge, recommended) NOT IN (SELECT badge, regexp_replace(recommended, '\\.0+$', '') FROM ignored)"
PARTS["kept_ranked"] = "SELECT r.* FROM ranked r JOIN kept k ON k.badge = r.badge AND k.recommended = r.recommended"
PARTS["kept_history"] = "SELECT badge, recommended, count(*) AS times_recommended FROM (SELECT 'r1' AS run, badge, recommended FROM old_corrections UNION SELECT 'r3', badge, recommended FROM kept) GROUP BY ALL"
query(
    "weekly_audit",
    "SELECT r.*, peer_stability, peers_considered, coalesce(times_recommended, 0) AS times_recommended, coalesce(n_runs_seen, 3) AS badge_n_runs, round(coalesce(times_recommended, 0) / coalesce(n_runs_seen, 3), 3) AS recommendation_stability FROM kept_ranked r LEFT JOIN peers p ON p.badge = r.badge LEFT JOIN kept_history h ON h.badge = r.badge AND h.recommended = r.recommended LEFT JOIN presence s ON s.badge = r.badge",
)(lambda d: _audit(d)["stable"])


def _audit(d: Data) -> dict[str, DataFrame]:
    """Two runs recorded, and the audit of the third."""
    runs = {"runs": d.empty(schemas.RUNS), "presence": d.empty(schemas.PRESENCE), "pairs": d.empty(schemas.CO_MEMBERSHIP), "recommendations": history.add_recommendations(d.empty(schemas.RECOMMENDATIONS), d.old_corrections(), "r1")}
    for run, own in (("r1", d.old_run), ("r2", d.mid_run)):
        runs["runs"] = history.append_run(runs["runs"], history.run_row(run, run, "file", own))
        runs["presence"], runs["pairs"] = history.add_presence(runs["presence"], own, run), history.add_pairs(runs["pairs"], own, run)
    return topology.weekly_audit(d.new_run, d.mapping, d.ignored, runs, "r3", "r3", "file")


query("ranked_new", "SELECT r.* FROM ranked r JOIN diff f ON f.badge = r.badge WHERE f.status = 'newly_flagged'")(
    lambda d: audit.rank_corrections(audit.newly_flagged(compare.corrections_diff(d.old_corrections(), d.corrections())), d.new_run, d.mapping)
)
query("preferred_columns", "SELECT badge, recommended AS proposed, recommended, confidence_gap FROM ranked")(
    lambda d: select_present(copy_column(d.ranked(), "recommended", "proposed"), ["badge", "proposed", "recommended", "no_such_column", "confidence_gap"])
)
query("most_stable", "SELECT badge, recommended, recommendation_stability, peer_stability FROM stable ORDER BY recommendation_stability DESC NULLS LAST, peer_stability DESC NULLS LAST, badge LIMIT 25")(
    lambda d: history.most_stable_first(d.stable()).select("badge", "recommended", "recommendation_stability", "peer_stability").limit(25)
)
query("surest_missing", "SELECT n.badge, round(coalesce(votes, 0) / nullif(mapped_peers, 0), 3) AS majority_share, mapped_peers FROM new_run n JOIN sizes s ON s.cluster = n.cluster LEFT JOIN majority j ON j.cluster = n.cluster WHERE n.badge NOT IN (SELECT badge FROM gis) AND n.badge IN (SELECT badge FROM active) ORDER BY 2 DESC NULLS LAST, 3 DESC, 1 LIMIT 10")(
    lambda d: enrich.missing_from_register(d.new_run, d.gis, d.active(), d.mapping, d.lookup).select("badge", "majority_share", "mapped_peers").limit(10)
)
