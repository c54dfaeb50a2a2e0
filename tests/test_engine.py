import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedertrace import schemas
from feedertrace.config import Config
from feedertrace.functions import scalar as fx
from feedertrace.operators import audit, compare, correlate, edges, history, ledger, signature, spatial
from feedertrace.plans import topology
from feedertrace.sources import metering
from feedertrace.streaming import days

DAY = dt.datetime(2024, 3, 1)


def test_ids_and_labels(spark):
    rows = [("100.00",), ("31.0",), ("nan",), ("None",), ("<NA>",), (" 7 ",), (None,), ("1.50",), ("1234567890.0",)]
    got = spark.createDataFrame(rows, "x string").select(fx.normalize_id("x")).collect()
    assert [r[0] for r in got] == ["100", "31", None, None, None, " 7 ", None, "1.50", "1234567890"]
    types = spark.createDataFrame([(None, None, "a"), ("t", None, "a"), ("t", "a", "a"), ("t", "a", "b")], "c string, x string, y string").select(fx.recommendation_type("c", "x", "y")).collect()
    assert [r[0] for r in types] == ["new_assignment", "unknown_feeder", "same_feeder_ambiguous", "cross_feeder_likely_gis_error"]
    files = spark.createDataFrame([("a/volts_2024-05-01.parquet",), ("nothing",)], "p string").select(fx.day_of_file("p")).collect()
    assert [r[0] for r in files] == [dt.date(2024, 5, 1), None]


def slow_haversine(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371000 * math.asin(min(1, math.sqrt(h)))


@pytest.mark.parametrize(("lat", "lon"), [(38.8, -77.0), (0.0, 179.9995), (89.999, 10.0), (-65.0, -180.0)])
def test_neighbors_equal_brute_force(spark, lat, lon):
    rng = random.Random(5)
    points = [(f"b{i}", lat + rng.uniform(-0.004, 0.004) * (lat < 89), ((lon + rng.uniform(-0.004, 0.004) + 180) % 360) - 180) for i in range(120)]
    points += [("same1", lat, lon if lon > -180 else 180.0), ("same2", lat, lon), ("none", None, lon), ("nan", float("nan"), lon)]
    got = {(r.badge_a, r.badge_b) for r in spatial.neighbors(spark.createDataFrame(points, "badge string, lat double, lon double")).collect()}
    real = [p for p in points if p[1] is not None and p[1] == p[1]]
    want = {(a[0], b[0]) for a in real for b in real if a[0] < b[0] and slow_haversine(a[1:], b[1:]) <= 175}
    assert got == want and ("same1", "same2") in got
    assert spatial.neighbors(spark.createDataFrame([], "badge string, lat double, lon double")).count() == 0


def test_masked_pearson_and_long_form_agree(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(12, 40))
    x[rng.random(x.shape) < 0.3] = np.nan
    x[3] = 5.0
    x[4] = np.nan
    pairs = [(f"{i:02d}", f"{j:02d}") for i in range(12) for j in range(i + 1, 12)]
    frame = spark.createDataFrame(pairs, "badge_a string, badge_b string")
    long = spark.createDataFrame([(f"{i:02d}", k, None if np.isnan(v) else float(v)) for i in range(12) for k, v in enumerate(x[i])], "badge string, slot int, pu double")
    wide = spark.createDataFrame([(f"{i:02d}", [None if np.isnan(v) else float(v) for v in x[i]]) for i in range(12)], "badge string, signature array<double>")
    want = {}
    for i in range(12):
        for j in range(i + 1, 12):
            m = np.isfinite(x[i]) & np.isfinite(x[j])
            if m.sum() >= 18 and x[i][m].std() > 0 and x[j][m].std() > 0:
                want[f"{i:02d}", f"{j:02d}"] = np.corrcoef(x[i][m], x[j][m])[0, 1]
    a = {(r.badge_a, r.badge_b): r.r for r in correlate.pearson_long(long, frame, at=["slot"], min_overlap=18).collect()}
    b = {(r.badge_a, r.badge_b): r.r for r in correlate.pearson_arrays(wide, frame, min_overlap=18).collect()}
    assert a.keys() == b.keys() == want.keys() and all(abs(a[k] - want[k]) < 1e-9 and abs(b[k] - want[k]) < 1e-9 for k in want)


def test_top_k_mutual_and_clusters(spark):
    pairs = [("a", "b", 0.99), ("b", "c", 0.98), ("a", "c", 0.5), ("c", "d", 0.97), ("x", "y", float("nan")), ("d", "e", 0.97), ("d", "f", 0.97)]
    p = spark.createDataFrame(pairs, "badge_a string, badge_b string, r double")
    top = edges.top_k(p, min_r=0.9, k=2)
    assert {(r.src, r.dst) for r in top.collect() if r.src == "d"} == {("d", "c"), ("d", "e")}
    links = edges.mutual(top)
    assert {(r.src, r.dst) for r in links.collect()} == {("a", "b"), ("b", "c"), ("c", "d"), ("d", "e")}
    badges = spark.createDataFrame([(x,) for x in "abcdefxyz"], "badge string")
    got = {r.badge: r.cluster for r in edges.clusters(badges, links).collect()}
    assert got == {"a": 0, "b": 0, "c": 0, "d": 0, "e": 0, "f": 1, "x": 2, "y": 3, "z": 4}
    lower = {r.badge: r.cluster for r in edges.clusters(badges, edges.mutual(edges.top_k(p, min_r=0.4, k=2))).collect()}
    assert all(lower[a] == lower[b] for a in got for b in got if got[a] == got[b])


def measurements(spark, n_days=3, gap=1):
    rng = random.Random(7)
    rows = []
    for day in range(n_days):
        if day == gap:
            continue
        for slot in range(96):
            shared = rng.random()
            for b in "pqr":
                rows.append((b, "1D", 38.8, -77.0 if b != "r" else None, 120.0, DAY + dt.timedelta(days=day, minutes=15 * slot), 120.0, shared + rng.random() * (0.01 if b != "r" else 1.0), slot))
    rows.append(("p", "1D", 38.8, -77.0, 120.0, DAY, 120.0, 9.0, 1000))
    rows.append(("p", "1D", 38.8, -77.0, 120.0, DAY + dt.timedelta(minutes=7), 120.0, 8.0, 1001))
    return spark.createDataFrame(rows, "badge string, device_type string, lat double, lon double, nominal double, ts timestamp, actual double, pu double, ingest long")


def test_signatures_keep_gaps_and_last_values(spark):
    config = Config(window_days=3, min_overlap=100, min_daily_overlap=60)
    m = measurements(spark)
    got = {r.badge: r.signature for r in signature.signatures(m, config).collect()}
    assert {len(v) for v in got.values()} == {288} and set(got) == set("pqr")
    assert got["p"][0] == 9.0 and all(v is None for v in got["p"][96:192]) and None not in got["p"][192:]
    badges = signature.first_row(m, "badge", "ts", ["lat", "lon"])
    clusters, excluded = topology.infer_clusters(signature.signatures(m.where("pu < 2"), config), badges, config)
    assert {r.badge: r.cluster for r in clusters.collect()} == {"p": 0, "q": 0} and [r.badge for r in excluded.collect()] == ["r"]
    daily = topology.correlate_day(m.where("pu < 2"), config).collect()
    assert {(r.badge_a, r.badge_b, r.day) for r in daily} == {("p", "q", dt.date(2024, 3, 1)), ("p", "q", dt.date(2024, 3, 3))} and all(r.r > 0.99 for r in daily)


def test_first_row_and_first_values(spark):
    rows = [("a", 1, None, 5), ("a", 2, 7, 6), ("b", 1, None, None)]
    f = spark.createDataFrame(rows, "badge string, ts int, lat int, lon int")
    assert sorted(map(tuple, signature.first_row(f, "badge", "ts", ["lat", "lon"]).collect())) == [("a", None, 5), ("b", None, None)]
    assert sorted(map(tuple, signature.first_values(f, "badge", "ts", ["lat", "lon"]).collect())) == [("a", 7, 5), ("b", None, None)]
    with pytest.raises(ValueError):
        signature.latest_days(f.withColumn("day", F.lit(dt.date(2024, 1, 1))), 2, complete=True)


def test_majority_ties_by_number(spark):
    clusters = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), ("d", 2), ("e", 3)], schemas.CLUSTERS)
    mapping = spark.createDataFrame([("a", "10"), ("b", "9"), ("c", None), ("d", None), ("e", "x")], schemas.MAPPING)
    assert sorted(map(tuple, audit.majority(audit.votes(clusters, mapping)).collect())) == [(1, "9", 1), (3, "x", 1)]
    found = audit.corrections(clusters, mapping)
    assert {(r.badge, r.recommended) for r in found.collect()} == {("a", "9"), ("c", "9")}
    ignored = spark.createDataFrame([("a", "9.0", None, None), ("c", "5", None, None)], schemas.IGNORED)
    kept, gone = audit.suppress(found, ignored)
    assert [r.badge for r in kept.collect()] == ["c"] and [r.badge for r in gone.collect()] == ["a"]
    assert audit.suppress(found.limit(0), ignored)[0].count() == 0


def test_audit_run_and_refusal(spark, tmp_path):
    clusters = spark.createDataFrame([(f"b{i}", i // 4) for i in range(12)], schemas.CLUSTERS)
    mapping = spark.createDataFrame([(f"b{i}", None if i == 5 else "7" if i == 1 else str(100 + i // 4)) for i in range(12)], schemas.MAPPING)
    tables = {"runs": schemas.RUNS, "presence": schemas.PRESENCE, "pairs": schemas.CO_MEMBERSHIP, "recommendations": schemas.RECOMMENDATIONS}
    stores = {k: metering.Versions(spark, f"{tmp_path}/{k}", s) for k, s in tables.items()}
    empty = spark.createDataFrame([], schemas.IGNORED)
    for run in ("r1", "r2"):
        out = topology.weekly_audit(clusters, mapping, empty, {k: v.read() for k, v in stores.items()}, run, "2024-01-01", "t")
        strong = {r.badge: r for r in out["high_confidence"].collect()}
        for k, v in stores.items():
            v.write(out[k])
    assert set(strong) == {"b1"} and strong["b1"].times_recommended == 2 and strong["b1"].peer_stability == 1.0
    assert {r.n_runs_seen for r in stores["presence"].read().collect()} == {2} and stores["runs"].read().count() == 2
    assert {(r.first_together, r.last_together) for r in stores["pairs"].read().collect()} == {("r1", "r2")}
    with pytest.raises(ValueError):
        topology.weekly_audit(clusters, mapping, empty, {k: v.read() for k, v in stores.items()}, "r2", "", "")


def test_peers_never_together_and_unseen(spark):
    clusters = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], schemas.CLUSTERS)
    pairs = spark.createDataFrame([("a", "b", 2, "r", "r")], schemas.CO_MEMBERSHIP)
    presence = spark.createDataFrame([("a", 4, "r", "r"), ("b", 2, "r", "r")], schemas.PRESENCE)
    got = {r.badge: (r.peer_stability, r.peers_considered) for r in history.peer_stability(clusters, pairs, presence, 4).collect()}
    assert got == {"a": (0.5, 2), "b": (0.5, 2), "c": (0.0, 2)}


def test_duplicate_badges_fan_out(spark):
    s = "badge string, current string, recommended string, cluster long"
    old = spark.createDataFrame([("a", "1", "2", 1), ("a", "1", "3", 1), ("g", "1", "2", 1)], s)
    new = spark.createDataFrame([("a", "1", "2", 1), ("n", "1", "2", 1), ("m", "1", None, 1)], s)
    assert sorted(r.status for r in compare.corrections_diff(old, new).collect()) == ["newly_flagged", "newly_flagged", "no_longer_flagged", "recommendation_changed", "unchanged"]
    assert "old badges" in compare.report(compare.summary(spark.createDataFrame([("a", 1)], schemas.CLUSTERS), spark.createDataFrame([("a", 2)], schemas.CLUSTERS), old, new).first())


def test_ledger_fold_stream_and_batch_agree(spark, tmp_path):
    rng = random.Random(1)
    start = dt.date(2024, 1, 1)
    rows = [(a, b, start + dt.timedelta(days=i), round(rng.random(), 3)) for i in range(8) for a, b in (("a", "b"), ("a", "c")) if (a, b, i) != ("a", "c", 3)]
    batch = {(r.badge_a, r.badge_b): r for r in ledger.ledger(spark.createDataFrame(rows, schemas.PAIR_DAILY), keep=5).collect()}
    for i in range(8):
        spark.createDataFrame([r for r in rows if r[2] == start + dt.timedelta(days=i)], schemas.PAIR_DAILY).coalesce(1).write.mode("append").parquet(f"{tmp_path}/feed")
    days.follow_pair_days(spark, f"{tmp_path}/feed", f"{tmp_path}/ledger", f"{tmp_path}/cp", keep=5, overwrite=True).awaitTermination()
    late = [("a", "b", start, 0.5), ("a", "b", start + dt.timedelta(days=7), 0.5)]
    spark.createDataFrame(late, schemas.PAIR_DAILY).coalesce(1).write.mode("append").parquet(f"{tmp_path}/feed")
    days.follow_pair_days(spark, f"{tmp_path}/feed", f"{tmp_path}/ledger", f"{tmp_path}/cp", keep=5).awaitTermination()
    stream = {(r.badge_a, r.badge_b): r for r in metering.Versions(spark, f"{tmp_path}/ledger", schemas.LEDGER).read().collect()}
    assert stream.keys() == batch.keys()
    for k, r in stream.items():
        assert r["values"] == batch[k]["values"] and (r.historical_n, r.first_day, r.last_day) == (batch[k].historical_n, batch[k].first_day, batch[k].last_day)
        assert abs(r.historical_mean - batch[k].historical_mean) < 1e-12
    arrivals = spark.createDataFrame([("a", "b", start + dt.timedelta(days=d), float(d), i) for i, d in enumerate([1, 0, 2, 2, 1, 3])], "badge_a string, badge_b string, day date, r double, arrival int")
    assert sorted(r.r for r in ledger.accepted(arrivals).collect()) == [1.0, 2.0, 3.0]


def test_ledger_stats(spark):
    values = [[0.5], [0.1, 0.3], [float(i) for i in range(1, 8)]]
    frame = spark.createDataFrame([("a", str(i), v) for i, v in enumerate(values)], "badge_a string, badge_b string, values array<double>")
    for r in ledger.stats(frame).collect():
        v = values[int(r.badge_b)]
        k = len(v) // 3
        trend = np.mean(v[-k:]) - np.mean(v[:k]) if len(v) >= 6 else 0.0
        assert np.allclose([r.mean, r.std, r.trend, r.n], [np.mean(v), np.std(v) if len(v) > 1 else 0, trend, len(v)])


def test_stream_windows_equal_batch(spark, tmp_path):
    m = measurements(spark)
    m.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(m.schema).parquet(f"{tmp_path}/in")
    q = days.windowed(stream).writeStream.format("memory").queryName("slots").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("slots").count() == days.windowed(m).count() == 3 * 2 * 96


def test_day_store_and_files(spark, tmp_path):
    m = measurements(spark)
    path = f"{tmp_path}/days"
    for _ in range(2):
        metering.write_days(m, path)
    assert metering.read_days(spark, path).count() == m.count()
    assert metering.read_days(spark, path, since=dt.date(2024, 3, 2)).where("day < '2024-03-02'").count() == 0
    missing = metering.missing_days(spark, path, dt.date(2024, 3, 1), dt.date(2024, 3, 4)).collect()
    assert [r.day for r in missing] == [dt.date(2024, 3, 2), dt.date(2024, 3, 4)]
    assert len(metering.missing_days(spark, f"{tmp_path}/no", dt.date(2024, 3, 1), dt.date(2024, 3, 2)).collect()) == 2
    m.coalesce(1).write.parquet(f"{tmp_path}/volts")
    assert "ingest" in metering.read_day_files(spark, f"{tmp_path}/volts").columns
    metering.write_csv(spark.createDataFrame([(" 1.0 ", "T1.0")], "BADGENUMBER string, TRANSFORMERBANKOBJECTID string"), f"{tmp_path}/sp")
    points = metering.read_csv(spark, f"{tmp_path}/sp", schemas.SERVICE_POINTS)
    assert len(points.columns) == 9 and metering.preferred(spark, [f"{tmp_path}/nix", f"{tmp_path}/sp"], schemas.SERVICE_POINTS).count() == 1
    known = audit.known_mapping(points, spark.createDataFrame([("1",)], "badge string")).collect()
    assert [tuple(r) for r in known] == [("1", "T1")]
    assert metering.latest_file(spark, f"{tmp_path}/sp/*.csv").endswith(".csv")
    assert metering.load_or_empty(spark, f"{tmp_path}/none", schemas.RUNS).count() == 0
    with pytest.raises(FileNotFoundError):
        metering.preferred(spark, [f"{tmp_path}/nix"], schemas.RUNS)


def test_nine_table_join(spark):
    t = {
        "d1_install_evt": ([(1, 10, None), (2, 20, "2020")], "device_config_id int, d1_sp_id int, d1_removal_dttm string"),
        "d1_dvc_cfg": ([(1, "k", 5), (2, "k", 6)], "device_config_id int, device_config_type_cd string, d1_device_id int"),
        "d1_dvc_cfg_type": ([("k", "E"), ("g", "G")], "device_config_type_cd string, d1_svc_type_cd string"),
        "d1_dvc": ([(5, " 1D "), (6, "zz")], "d1_device_id int, device_type_cd string"),
        "d1_dvc_identifier": ([(5, "D1BN", "M5"), (5, "XX", "no")], "d1_device_id int, dvc_id_type_flg string, id_value string"),
        "d1_sp_identifier": ([(10, "D1EP", "p1")], "d1_sp_id int, sp_id_type_flg string, id_value string"),
        "ci_prem_geo": ([("p1", "LAT/LONG", "38.5 77.25")], "prem_id string, geo_type_cd string, geo_val string"),
        "d1_measr_comp": ([(1, 100, "E-V2HVHA-15")], "device_config_id int, measr_comp_id int, measr_comp_type_cd string"),
        "d1_msrmt": ([(100, "501000", DAY, 121.2), (100, "1", DAY, 1.0)], "measr_comp_id int, msrmt_cond_flg string, msrmt_dttm timestamp, msrmt_val double"),
    }
    rows = metering.metering_rows({k: spark.createDataFrame(*v) for k, v in t.items()}).collect()
    assert [tuple(r) for r in rows] == [("M5", "1D", 38.5, -77.25, 120.0, DAY, 121.2, 1.01)]
    hours = metering.hourly_predicates(dt.date(2024, 2, 28))
    assert len(hours) == 24 and hours[-1] == "msrmt_dttm >= TIMESTAMP '2024-02-28 23:00:00' AND msrmt_dttm < TIMESTAMP '2024-02-29 00:00:00'"


def test_columns(spark):
    from feedertrace.functions import columns

    f = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert columns.select_present(f, ["c", "x", "a"]).columns == ["c", "a"]
    assert columns.select_present(f, ["c"], rest=True).columns == ["c", "a", "b"]
    assert columns.copy_column(f, "a", "d").first().d == 1 and columns.drop_null_keys(f.withColumn("a", F.lit(None).cast("int")), ["a"]).count() == 0
    a, b = spark.createDataFrame([("q",), ("p",), ("r",)], "x string"), spark.createDataFrame([("z",)], "y string")
    assert sorted(map(tuple, columns.side_by_side(a, b).collect())) == [("p", "z"), ("q", None), ("r", None)]
    assert columns.side_by_side(a.limit(0), b.limit(0)).count() == 0
