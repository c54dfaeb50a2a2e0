"""Queries over the driver's tables, which stand in for meters, registers and runs, and the same in SQL.

A stand-in is a table with expressions that both engines read alike. SQL is put together from named parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedertrace.config import Config
from feedertrace.functions import scalar as fx
from feedertrace.functions.columns import side_by_side
from feedertrace.operators import audit, compare, correlate, edges, enrich, history, ledger, signature, spatial
from feedertrace.session import materialize, read_table

_K = "c_custkey"
_CELL = "CAST(floor(c_custkey / 6) AS BIGINT)"
#: name: (table, expressions, condition). All rows of a table are taken: a badge that a side lacks has another key there.
STAND_INS: dict[str, tuple[str, list[str], str]] = {
    "model": ("customer", [f"'B' || CAST({_K} AS STRING) AS badge", f"CASE WHEN {_K} % 53 = 0 THEN NULL ELSE 38.8e0 + ({_K} % 97) * 0.0005e0 END AS lat", f"-77.0e0 - (CAST(floor({_K} / 97) AS BIGINT) % 83) * 0.0006e0 AS lon"], "true"),
    "gis": ("customer", [f"CASE WHEN {_K} % 17 = 0 THEN 'G' ELSE 'B' END || CAST({_K} AS STRING) AS badge", "c_name AS address", "c_mktsegment AS city", f"38.8e0 + ({_K} % 97) * 0.0005e0 + CASE WHEN {_K} % 9 = 0 THEN 0.002e0 ELSE 0.0001e0 END AS lat", f"-77.0e0 - (CAST(floor({_K} / 97) AS BIGINT) % 83) * 0.0006e0 AS lon", f"'F' || CAST({_K} % 4 AS STRING) AS feeder", f"CAST(100 + {_CELL} % 40 AS STRING) AS gis_transformer", f"'G' || CAST({_CELL} % 40 AS STRING) AS bank_tag"], "true"),
    "new_run": ("customer", [f"CASE WHEN {_K} % 31 = 0 THEN 'X' ELSE 'B' END || CAST({_K} AS STRING) AS badge", f"CASE WHEN {_K} % 31 = 0 THEN 100000000 + {_K} ELSE {_CELL} END AS cluster"], "true"),
    "old_run": ("customer", [f"CASE WHEN {_K} % 29 = 0 THEN 'Y' ELSE 'B' END || CAST({_K} AS STRING) AS badge", f"CASE WHEN {_K} % 11 = 0 THEN {_CELL} + 1 WHEN {_K} % 600 < 12 THEN {_CELL} - {_CELL} % 2 ELSE {_CELL} END AS cluster"], "true"),
    "mid_run": ("customer", [f"CASE WHEN {_K} % 23 = 0 THEN 'Z' ELSE 'B' END || CAST({_K} AS STRING) AS badge", f"CAST(floor(({_K} + 2) / 6) AS BIGINT) AS cluster"], "true"),
    "mapping": ("customer", [f"CASE WHEN {_K} % 13 = 0 THEN 'M' ELSE 'B' END || CAST({_K} AS STRING) AS badge", f"CASE WHEN {_K} % 7 = 0 THEN NULL WHEN {_K} % 5 = 0 THEN 'T' || CAST(c_nationkey AS STRING) ELSE CAST(100 + {_CELL} % 40 AS STRING) END AS transformer"], "true"),
    "old_mapping": ("customer", [f"CASE WHEN {_K} % 13 = 0 THEN 'M' ELSE 'B' END || CAST({_K} AS STRING) AS badge", f"CASE WHEN {_K} % 8 = 0 THEN NULL WHEN {_K} % 5 = 0 THEN 'T' || CAST(c_nationkey % 9 AS STRING) ELSE CAST(100 + {_CELL} % 40 AS STRING) END AS transformer"], "true"),
    "ignored": ("customer", [f"CASE WHEN {_K} % 3 <> 0 THEN 'I' ELSE 'B' END || CAST({_K} AS STRING) AS badge", f"CAST(100 + {_CELL} % 40 AS STRING) || '.0' AS recommended"], "true"),
    "lookup": ("nation", ["CAST(100 + n_nationkey AS STRING) AS transformer", "n_name AS structure", "'F' || CAST(n_regionkey AS STRING) AS feeder", "'S' || CAST(n_regionkey AS STRING) AS subtype", "'V' || CAST(n_nationkey AS STRING) AS vault", "38.81e0 + n_nationkey * 0.001e0 AS lat", "-77.01e0 AS lon", "n_nationkey * 2.5e0 AS kva"], "true"),
    "sightings": ("orders", ["'B' || CAST(o_custkey AS STRING) AS badge", "CAST(o_orderdate AS DATE) AS day"], "true"),
    "readings": ("events", ["event_id", "CAST(user_id AS STRING) AS badge", "CASE event_id % 4 WHEN 0 THEN '1D' WHEN 1 THEN '10N' WHEN 2 THEN '5ED' ELSE '99' END AS device_type", "ts", "CASE WHEN event_id % 37 = 0 THEN NULL ELSE value END AS actual"], "true"),
    "vectors": ("embeddings", ["CAST(vec_id AS STRING) AS badge", "embedding AS signature", "38.8e0 + (vec_id % 40) * 0.0005e0 AS lat", "-77.0e0 - floor(vec_id / 40) * 0.0006e0 AS lon"], "true"),
    "units": ("supplier", ["CAST(s_suppkey AS STRING) AS badge", "38.8e0 + (s_suppkey % 20) * 0.0005e0 AS lat", "-77.0e0 - floor(s_suppkey / 20) * 0.0006e0 AS lon"], "true"),
    "metadata_old": ("supplier", ["CASE WHEN s_suppkey % 10 = 1 THEN 'O' ELSE '' END || CAST(s_suppkey AS STRING) AS badge", "s_nationkey AS place", "CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_name END AS label"], "true"),
    "metadata_new": ("supplier", ["CASE WHEN s_suppkey % 10 = 2 THEN 'N' ELSE '' END || CAST(s_suppkey AS STRING) AS badge", "CASE WHEN s_suppkey % 4 = 0 THEN s_nationkey + 1 ELSE s_nationkey END AS place", "CASE WHEN s_suppkey % 15 = 0 THEN NULL ELSE s_name END AS label"], "true"),
    "pair_days": ("lineitem", ["CAST(l_suppkey AS STRING) AS badge_a", "CAST(l_suppkey + 1 AS STRING) || 'x' AS badge_b", "CAST(l_shipdate AS DATE) AS day", "l_discount AS r"], "true"),
}
_DIST = "2 * 6371000e0 * asin(least(1e0, sqrt(pow(sin(radians({b}lat - {a}lat) / 2), 2) + cos(radians({a}lat)) * cos(radians({b}lat)) * pow(sin(radians({b}lon - {a}lon) / 2), 2))))"


def _d(a: str, b: str) -> str:
    return _DIST.format(a=a, b=b)


#: SQL parts by name; a part may read any part above it.
PARTS: dict[str, str] = {
    **{k: f"SELECT {', '.join(e)} FROM {t} WHERE {w}" for k, (t, e, w) in STAND_INS.items()},
    "supplier_months": "SELECT CAST(l_suppkey AS STRING) AS badge, date_trunc('month', l_shipdate) AS slot, avg(l_extendedprice) AS pu FROM lineitem GROUP BY ALL",
    "user_days": "SELECT CAST(user_id AS STRING) AS badge, CAST(date_trunc('week', ts) AS DATE) AS day, dayofweek(ts) AS slot, avg(value) AS pu FROM events GROUP BY ALL",
    "vector_pairs": f"SELECT a.badge AS badge_a, b.badge AS badge_b, a.signature AS x, b.signature AS y FROM vectors a JOIN vectors b ON a.badge < b.badge AND {_d('a.', 'b.')} <= 175",
    "scored": "SELECT badge_a, badge_b, corr(u, v) AS r FROM (SELECT badge_a, badge_b, unnest(x)::DOUBLE AS u, unnest(y)::DOUBLE AS v FROM vector_pairs) GROUP BY ALL",
    "top": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY r DESC, dst) AS rank FROM (SELECT badge_a AS src, badge_b AS dst, r FROM scored UNION ALL SELECT badge_b, badge_a, r FROM scored) WHERE r >= 0.15) WHERE rank <= 3",
    "mutual": "SELECT a.src, a.dst, a.r FROM top a JOIN top b ON a.src = b.dst AND a.dst = b.src WHERE a.src < a.dst",
    "ends": "SELECT src AS p, dst AS q FROM mutual UNION SELECT dst, src FROM mutual UNION SELECT badge, badge FROM vectors",
    "active": "SELECT DISTINCT badge FROM sightings WHERE day IN (SELECT DISTINCT day FROM sightings ORDER BY day DESC LIMIT 200)",
    "votes": "SELECT cluster, transformer, count(*) AS votes FROM new_run JOIN mapping USING (badge) WHERE transformer IS NOT NULL GROUP BY ALL",
    "majority": "SELECT cluster, transformer, votes FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY votes DESC, coalesce(try_cast(transformer AS DOUBLE), 'inf'::DOUBLE), transformer) AS i FROM votes) WHERE i = 1",
    "corrections": 'SELECT badge, n.cluster, m.transformer AS "current", j.transformer AS recommended FROM new_run n JOIN mapping m USING (badge) JOIN majority j ON j.cluster = n.cluster WHERE m.transformer IS DISTINCT FROM j.transformer',
    "old_votes": "SELECT cluster, transformer, count(*) AS votes FROM old_run JOIN old_mapping USING (badge) WHERE transformer IS NOT NULL GROUP BY ALL",
    "old_majority": "SELECT cluster, transformer FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY votes DESC, coalesce(try_cast(transformer AS DOUBLE), 'inf'::DOUBLE), transformer) AS i FROM old_votes) WHERE i = 1",
    "old_corrections": 'SELECT badge, n.cluster, m.transformer AS "current", j.transformer AS recommended FROM old_run n JOIN old_mapping m USING (badge) JOIN old_majority j ON j.cluster = n.cluster WHERE m.transformer IS DISTINCT FROM j.transformer',
    "sizes": "SELECT cluster, count(*) AS cluster_size, count(transformer) AS mapped_peers FROM new_run LEFT JOIN mapping USING (badge) GROUP BY cluster",
    "ranked": 'SELECT c.badge, c."current", c.recommended, c.cluster, cluster_size, mapped_peers, coalesce(v.votes, 0) AS current_votes, coalesce(w.votes, 0) AS majority_votes, round(coalesce(w.votes, 0) / nullif(mapped_peers, 0), 4) AS majority_share, round((coalesce(w.votes, 0) - coalesce(v.votes, 0)) / nullif(mapped_peers, 0), 4) AS confidence_gap FROM corrections c LEFT JOIN votes v ON v.cluster = c.cluster AND v.transformer = c."current" LEFT JOIN votes w ON w.cluster = c.cluster AND w.transformer = c.recommended LEFT JOIN sizes s ON s.cluster = c.cluster',
    "three": "SELECT 'r1' AS run, * FROM old_run UNION ALL SELECT 'r2', * FROM mid_run UNION ALL SELECT 'r3', * FROM new_run",
    "presence": "SELECT badge, count(*) AS n_runs_seen, min(run) AS first_run, max(run) AS last_run FROM three GROUP BY badge",
    "pairs": "SELECT a.badge AS badge_a, b.badge AS badge_b, count(*) AS times_together, min(a.run) AS first_together, max(a.run) AS last_together FROM three a JOIN three b ON a.run = b.run AND a.cluster = b.cluster AND a.badge < b.badge GROUP BY ALL",
    "recommendations": "SELECT badge, recommended, count(*) AS times_recommended, min(run) AS first_run, max(run) AS last_run FROM (SELECT 'r1' AS run, badge, recommended FROM old_corrections UNION SELECT 'r3', badge, recommended FROM corrections) GROUP BY ALL",
    "peers": "SELECT n.badge, peer_stability, coalesce(peers_considered, 0) AS peers_considered FROM new_run n LEFT JOIN (SELECT badge, round(avg(part), 3) AS peer_stability, count(*) AS peers_considered FROM (SELECT a.badge, coalesce(times_together, 0) / least(coalesce(p.n_runs_seen, 3), coalesce(q.n_runs_seen, 3)) AS part FROM new_run a JOIN new_run b ON a.cluster = b.cluster AND a.badge <> b.badge LEFT JOIN pairs ON badge_a = least(a.badge, b.badge) AND badge_b = greatest(a.badge, b.badge) LEFT JOIN presence p ON p.badge = a.badge LEFT JOIN presence q ON q.badge = b.badge) GROUP BY badge) k ON k.badge = n.badge",
    "stable": 'SELECT r.*, peer_stability, peers_considered, coalesce(times_recommended, 0) AS times_recommended, coalesce(n_runs_seen, 3) AS badge_n_runs, round(coalesce(times_recommended, 0) / coalesce(n_runs_seen, 3), 3) AS recommendation_stability FROM ranked r LEFT JOIN peers p ON p.badge = r.badge LEFT JOIN recommendations h ON h.badge = r.badge AND h.recommended = r.recommended LEFT JOIN presence s ON s.badge = r.badge',
    "common": "SELECT badge, o.cluster AS o, n.cluster AS n FROM old_run o JOIN new_run n USING (badge)",
    "old_sizes": "SELECT cluster, count(*) AS size FROM old_run GROUP BY cluster",
    "new_sizes": "SELECT cluster, count(*) AS size FROM new_run GROUP BY cluster",
    "old_sets": "SELECT cluster, list_sort(list(badge)) AS members FROM old_run GROUP BY cluster",
    "new_sets": "SELECT cluster, list_sort(list(badge)) AS members FROM new_run GROUP BY cluster",
    "changes": "SELECT c.badge, len(a.members) AS old_cluster_size, len(b.members) AS new_cluster_size, len(b.members) - len(list_intersect(a.members, b.members)) AS gained_peers, len(a.members) - len(list_intersect(a.members, b.members)) AS lost_peers, round((len(list_intersect(a.members, b.members)) - 1) / nullif(len(a.members) + len(b.members) - len(list_intersect(a.members, b.members)) - 1, 0), 4) AS jaccard_peers FROM common c JOIN old_sets a ON a.cluster = o JOIN new_sets b ON b.cluster = n WHERE a.members <> b.members",
    "splits": "SELECT o AS old_cluster, any_value(size) AS old_size, count(*) AS badges_in_common, count(DISTINCT n) AS split_into FROM common JOIN old_sizes ON cluster = o GROUP BY o HAVING count(*) > 1 AND count(DISTINCT n) > 1",
    "merges": "SELECT n AS new_cluster, any_value(size) AS new_size, count(*) AS badges_in_common, count(DISTINCT o) AS merged_from FROM common JOIN new_sizes ON cluster = n GROUP BY n HAVING count(*) > 1 AND count(DISTINCT o) > 1",
    "identical": "SELECT a.cluster AS old_cluster, b.cluster AS new_cluster, len(a.members) AS size FROM old_sets a JOIN new_sets b USING (members)",
    "diff": 'SELECT badge, a."current" AS current_old, a.recommended AS recommended_old, a.cluster AS cluster_old, b."current" AS current_new, b.recommended AS recommended_new, b.cluster AS cluster_new, CASE WHEN a.badge IS NULL THEN \'newly_flagged\' WHEN b.badge IS NULL THEN \'no_longer_flagged\' WHEN a.recommended IS DISTINCT FROM b.recommended THEN \'recommendation_changed\' ELSE \'unchanged\' END AS status FROM old_corrections a FULL JOIN corrections b USING (badge)',
    "daily": "SELECT badge_a, badge_b, day, min(r) AS r FROM pair_days GROUP BY ALL",
    "held": "SELECT badge_a, badge_b, list(r ORDER BY day) AS every, count(*) AS historical_n, avg(r) AS historical_mean, min(day) AS first_day, max(day) AS last_day FROM daily GROUP BY ALL",
    "ledger": "SELECT badge_a, badge_b, every[greatest(1, len(every) - 59):] AS \"values\", historical_n, historical_mean, first_day, last_day FROM held",
}


def _sql(body: str) -> str:
    """``body`` with the parts it reads in front."""
    import re

    def reads(text: str, below: list[str]) -> set[str]:
        return {p for p in below if re.search(rf"(?:FROM|JOIN|,)\s+{p}\b", text)}

    names = list(PARTS)
    need, todo = set(), reads(body, names)
    while todo:
        p = todo.pop()
        need.add(p)
        todo |= reads(PARTS[p], names[: names.index(p)]) - need
    return "WITH RECURSIVE " + ",\n".join(f"{p} AS ({PARTS[p]})" for p in names if p in need) + "\n" + body if need else body


class Data:
    """The stand-ins, and what several queries make of them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in STAND_INS:
            raise AttributeError(name)
        table, exprs, where = STAND_INS[name]
        return self.table(table).where(where).selectExpr(*exprs)

    def scored(self) -> DataFrame:
        v = self.vectors
        return correlate.pearson_arrays(v, spatial.neighbors(v, radius_m=175.0, max_abs_lat=39.0), min_overlap=64)

    def top(self) -> DataFrame:
        return edges.top_k(self.scored(), min_r=0.15, k=3)

    def supplier_months(self) -> DataFrame:
        return self.table("lineitem").groupBy(F.col("l_suppkey").cast("string").alias("badge"), F.date_trunc("month", "l_shipdate").alias("slot")).agg(F.avg("l_extendedprice").alias("pu"))

    def user_days(self) -> DataFrame:
        return self.table("events").groupBy(F.col("user_id").cast("string").alias("badge"), F.date_trunc("week", "ts").cast("date").alias("day"), F.dayofweek("ts").alias("slot")).agg(F.avg("value").alias("pu"))

    def votes(self) -> DataFrame:
        return audit.votes(self.new_run, self.mapping)

    def corrections(self) -> DataFrame:
        return audit.corrections(self.new_run, self.mapping)

    def old_corrections(self) -> DataFrame:
        return audit.corrections(self.old_run, self.old_mapping)

    def ranked(self) -> DataFrame:
        return audit.rank_corrections(self.corrections(), self.new_run, self.mapping)

    def active(self) -> DataFrame:
        return signature.active_badges(self.sightings, 200)

    def empty(self, schema) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    def presence(self) -> DataFrame:
        from feedertrace import schemas

        out = self.empty(schemas.PRESENCE)
        for run, own in (("r1", self.old_run), ("r2", self.mid_run), ("r3", self.new_run)):
            out = history.add_presence(out, own, run)
        return out

    def pairs(self) -> DataFrame:
        from feedertrace import schemas

        out = self.empty(schemas.CO_MEMBERSHIP)
        for run, own in (("r1", self.old_run), ("r2", self.mid_run), ("r3", self.new_run)):
            out = history.add_pairs(out, own, run)
        return out

    def recommendations(self) -> DataFrame:
        from feedertrace import schemas

        return history.add_recommendations(history.add_recommendations(self.empty(schemas.RECOMMENDATIONS), self.old_corrections(), "r1"), self.corrections(), "r3")

    def peers(self) -> DataFrame:
        return history.peer_stability(self.new_run, self.pairs(), self.presence(), 3)

    def stable(self) -> DataFrame:
        return history.corrections_with_stability(self.ranked(), self.new_run, self.pairs(), self.presence(), self.recommendations(), 3)

    def daily(self) -> DataFrame:
        return ledger.accepted(self.pair_days)


QUERIES: dict[str, object] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Data(spark, sf_dir))
        if sql:
            ORACLES[name] = _sql(sql)
        return f

    return add


_TEXTS = "CASE o_orderkey % 6 WHEN 0 THEN CAST(o_orderkey AS STRING) || '.0' WHEN 1 THEN CAST(o_orderkey AS STRING) || '.00' WHEN 2 THEN 'nan' WHEN 3 THEN '<NA>' WHEN 4 THEN NULL ELSE CAST(o_orderkey AS STRING) || '.50' END"
query("normalize_id", f"SELECT o_orderkey, CASE WHEN x IN ('nan', 'None', '<NA>') THEN NULL ELSE x END AS id FROM (SELECT o_orderkey, regexp_replace({_TEXTS}, '\\.0+$', '') AS x FROM orders)")(
    lambda d: d.table("orders").selectExpr("o_orderkey", f"{_TEXTS} AS x").select("o_orderkey", fx.normalize_id("x").alias("id"))
)
_BLANKS = "CASE p_partkey % 5 WHEN 0 THEN '  ' WHEN 1 THEN ' ' || p_name || '  ' WHEN 2 THEN 'nan' ELSE p_name END"
query("blank_to_null", f"SELECT p_partkey, CASE WHEN trim({_BLANKS}) IN ('', 'nan', 'None') THEN NULL ELSE trim({_BLANKS}) END AS name FROM part")(
    lambda d: d.table("part").selectExpr("p_partkey", f"{_BLANKS} AS x").select("p_partkey", fx.blank_to_null("x").alias("name"))
)
_NUMBERS = "CASE p_partkey % 3 WHEN 0 THEN CAST(p_size AS STRING) || '.25' WHEN 1 THEN p_brand ELSE CAST(p_size AS STRING) END"
query("to_number", f"SELECT p_partkey, try_cast({_NUMBERS} AS DOUBLE) AS x FROM part")(lambda d: d.table("part").selectExpr("p_partkey", f"{_NUMBERS} AS x").select("p_partkey", fx.to_number("x").alias("x")))
_PLACES = "CAST(38 + s_suppkey % 5 AS STRING) || '.5  ' || CAST(70 + s_suppkey % 9 AS STRING) || '.25'"
query("split_location", "SELECT s_suppkey, 38 + s_suppkey % 5 + 0.5e0 AS lat, -(70 + s_suppkey % 9 + 0.25e0) AS lon FROM supplier")(
    lambda d: d.table("supplier").selectExpr("s_suppkey", f"{_PLACES} AS x").select("s_suppkey", fx.split_location("x")[0].alias("lat"), fx.split_location("x")[1].alias("lon"))
)
query("canonical_pair", "SELECT DISTINCT least(CAST(l_suppkey AS STRING), CAST(l_partkey AS STRING)) AS a, greatest(CAST(l_suppkey AS STRING), CAST(l_partkey AS STRING)) AS b FROM lineitem")(
    lambda d: d.table("lineitem").select(*(c.alias(n) for c, n in zip(fx.canonical_pair(F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string")), "ab", strict=True))).distinct()
)
_NOMINAL = "CASE WHEN device_type IN ('1', '1D', '55') THEN 120e0 WHEN device_type = '10N' THEN 208e0 WHEN device_type IN ('5', '52', '52M', '5D', '5E', '5ED', '5EN', '5L', '5N') THEN 240e0 END"
query("per_unit", f"SELECT event_id, {_NOMINAL} AS nominal, round(actual / {_NOMINAL}, 10) AS pu FROM readings")(
    lambda d: d.readings.select("event_id", fx.nominal_volts("device_type").alias("nominal"), fx.per_unit("actual", fx.nominal_volts("device_type")).alias("pu"))
)
query("slot_counts", "SELECT badge, time_bucket(INTERVAL 15 MINUTE, ts) AS slot, count(*) AS n FROM readings GROUP BY ALL")(
    lambda d: d.readings.groupBy("badge", fx.slot_start("ts").alias("slot")).agg(F.count(F.lit(1)).alias("n"))
)
query("dedup_last", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS i FROM lineitem) WHERE i = 1")(
    lambda d: signature.dedup_last(d.table("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]).drop("l_shipdate")
)
query("first_row", "SELECT badge, device_type, actual FROM (SELECT *, row_number() OVER (PARTITION BY badge ORDER BY ts, device_type, actual NULLS FIRST) AS i FROM readings) WHERE i = 1")(lambda d: signature.first_row(d.readings, "badge", "ts", ["device_type", "actual"]))
query("first_values", "SELECT badge, arg_min(device_type, (ts, device_type)) AS device_type, arg_min(actual, (ts, actual)) FILTER (actual IS NOT NULL) AS actual FROM readings GROUP BY badge")(lambda d: signature.first_values(d.readings, "badge", "ts", ["device_type", "actual"]))
query("latest_days", "SELECT badge, count(*) AS n FROM readings WHERE CAST(ts AS DATE) IN (SELECT DISTINCT CAST(ts AS DATE) FROM readings ORDER BY 1 DESC LIMIT 7) GROUP BY badge")(
    lambda d: signature.latest_days(d.readings.withColumn("day", F.to_date("ts")), 7).groupBy("badge").agg(F.count(F.lit(1)).alias("n"))
)
query("last_days", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM readings WHERE CAST(ts AS DATE) > (SELECT max(CAST(ts AS DATE)) FROM readings) - 10 GROUP BY ALL")(
    lambda d: signature.last_days(d.readings.withColumn("day", F.to_date("ts")), 10).groupBy("day").agg(F.count(F.lit(1)).alias("n"))
)
query("active_badges", "SELECT badge FROM active")(lambda d: d.active())
query("spatial_neighbors", f"SELECT a.badge AS badge_a, b.badge AS badge_b, round({_d('a.', 'b.')}, 6) AS dist_m FROM model a JOIN model b ON a.badge < b.badge AND {_d('a.', 'b.')} <= 175")(
    lambda d: spatial.neighbors(d.model, radius_m=175.0).withColumn("dist_m", F.round("dist_m", 6))
)
query("excluded_badges", "SELECT badge FROM model WHERE lat IS NULL OR lon IS NULL")(lambda d: spatial.split_located(d.model)[1].select("badge"))
query("pearson_overlap", f"SELECT a.badge AS badge_a, b.badge AS badge_b, round(corr(a.pu, b.pu), 6) AS r, count(*) AS n FROM units p JOIN units q ON p.badge < q.badge AND {_d('p.', 'q.')} <= 175 JOIN supplier_months a ON a.badge = p.badge JOIN supplier_months b ON b.badge = q.badge AND a.slot = b.slot GROUP BY ALL HAVING count(*) >= 60")(
    lambda d: correlate.pearson_long(materialize(d.supplier_months(), "months"), spatial.neighbors(d.units, max_abs_lat=39.0), at=["slot"], min_overlap=60).withColumn("r", F.round("r", 6))
)
query("pearson_daily", "SELECT a.badge AS badge_a, b.badge AS badge_b, a.day, round(corr(a.pu, b.pu), 6) AS r, count(*) AS n FROM user_days a JOIN user_days b ON a.day = b.day AND a.slot = b.slot AND CAST(b.badge AS BIGINT) = CAST(a.badge AS BIGINT) + 1 GROUP BY ALL HAVING count(*) >= 4 AND corr(a.pu, b.pu) IS NOT NULL")(
    lambda d: correlate.pearson_long(u := materialize(d.user_days(), "days"), u.select(F.col("badge").alias("badge_a"), (F.col("badge").cast("long") + 1).cast("string").alias("badge_b")).distinct(), at=["day", "slot"], min_overlap=4, by=["day"]).withColumn("r", F.round("r", 6))
)
query("pearson_vectors", "SELECT badge_a, badge_b, round(r, 6) AS r FROM scored")(lambda d: d.scored().withColumn("r", F.round("r", 6)))
query("topk_candidates", "SELECT src, dst, round(r, 6) AS r, rank FROM top")(lambda d: d.top().withColumn("r", F.round("r", 6)))
query("mutual_edges", "SELECT src, dst, round(r, 6) AS r FROM mutual")(lambda d: edges.mutual(d.top()).withColumn("r", F.round("r", 6)))
query("clusters", "SELECT badge, dense_rank() OVER (ORDER BY least_badge) - 1 AS cluster FROM (SELECT p AS badge, min(q) AS least_badge FROM reach GROUP BY p)")(lambda d: edges.clusters(d.vectors, edges.mutual(d.top())))
PARTS["reach"] = "SELECT p, q FROM ends UNION SELECT reach.p, ends.q FROM reach JOIN ends ON ends.p = reach.q"
ORACLES["clusters"] = _sql("SELECT badge, dense_rank() OVER (ORDER BY least_badge) - 1 AS cluster FROM (SELECT p AS badge, min(q) AS least_badge FROM reach GROUP BY p)")
query("votes", "SELECT * FROM votes")(lambda d: d.votes())
query("majority", "SELECT * FROM majority")(lambda d: audit.majority(d.votes()))
query("mapping_errors", "SELECT * FROM corrections")(lambda d: d.corrections())
query("kept_corrections", "SELECT badge, cluster, \"current\", recommended FROM corrections WHERE (badge, recommended) NOT IN (SELECT badge, regexp_replace(recommended, '\\.0+$', '') FROM ignored)")(lambda d: audit.suppress(d.corrections(), d.ignored)[0])
query("suppressed_corrections", "SELECT badge, cluster, \"current\", recommended FROM corrections WHERE (badge, recommended) IN (SELECT badge, regexp_replace(recommended, '\\.0+$', '') FROM ignored)")(lambda d: audit.suppress(d.corrections(), d.ignored)[1])
query("cluster_sizes", "SELECT * FROM sizes")(lambda d: audit.cluster_sizes(d.new_run, d.mapping))
query("ranked_corrections", "SELECT * FROM ranked")(lambda d: audit.best_first(d.ranked()))
query("top_corrections", "SELECT * FROM ranked ORDER BY confidence_gap DESC NULLS LAST, mapped_peers DESC NULLS LAST, badge LIMIT 20")(lambda d: audit.best_first(d.ranked()).limit(20))
query("rank_summary", "SELECT count(*) AS n, round(quantile_cont(confidence_gap, 0.5), 6) AS median_gap, round(quantile_cont(confidence_gap, 0.75), 6) AS upper_gap, count(*) FILTER (confidence_gap >= 0.5 AND mapped_peers >= 4) AS n_strong FROM ranked")(lambda d: audit.rank_summary(d.ranked()))
query("cluster_purity", "SELECT cluster, count(DISTINCT transformer) AS n_transformers FROM new_run JOIN mapping USING (badge) GROUP BY cluster")(lambda d: audit.cluster_purity(d.new_run, d.mapping))
query("transformer_completeness", "SELECT transformer, count(DISTINCT cluster) AS n_clusters FROM new_run JOIN mapping USING (badge) WHERE transformer IS NOT NULL GROUP BY transformer")(lambda d: audit.transformer_completeness(d.new_run, d.mapping))
query(
    "evaluation",
    "SELECT n_badges, n_clusters, n_transformers, n_impure, purity, n_split, completeness FROM (SELECT count(DISTINCT badge) AS n_badges, count(DISTINCT cluster) AS n_clusters, count(DISTINCT transformer) AS n_transformers FROM new_run JOIN mapping USING (badge)), (SELECT count(*) FILTER (k > 1) AS n_impure, round(count(*) FILTER (k <= 1) / count(*), 4) AS purity FROM (SELECT count(DISTINCT transformer) AS k FROM new_run JOIN mapping USING (badge) GROUP BY cluster)), (SELECT count(*) FILTER (k > 1) AS n_split, round(count(*) FILTER (k = 1) / count(*), 4) AS completeness FROM (SELECT count(DISTINCT cluster) AS k FROM new_run JOIN mapping USING (badge) WHERE transformer IS NOT NULL GROUP BY transformer))",
)(lambda d: audit.evaluation(d.new_run, d.mapping))
query("size_summary", "SELECT count(*) AS n, round(avg(size), 6) AS mean, round(stddev_samp(size), 6) AS std, min(size) AS least, quantile_cont(size, 0.25) AS p25, quantile_cont(size, 0.5) AS p50, quantile_cont(size, 0.75) AS p75, max(size) AS most FROM new_sizes")(lambda d: audit.size_summary(d.new_run))
query("badge_presence", "SELECT * FROM presence")(lambda d: d.presence())
query("pair_co_membership", "SELECT * FROM pairs")(lambda d: d.pairs())
query("recommendation_history", "SELECT * FROM recommendations")(lambda d: d.recommendations())
query("peer_stability", "SELECT * FROM peers")(lambda d: d.peers())
query("corrections_with_stability", "SELECT * FROM stable")(lambda d: d.stable())
query("high_confidence", "SELECT * FROM stable WHERE confidence_gap >= 0.5 AND mapped_peers >= 4 AND peer_stability >= 0.5 AND recommendation_stability >= 0.3")(lambda d: history.high_confidence(d.stable(), Config(min_peer_stability=0.5, min_recommendation_stability=0.3)))
query("badge_stability_summary", "SELECT badge, peer_stability, peers_considered, coalesce(n_runs_seen, 0) AS n_runs_seen FROM peers LEFT JOIN presence USING (badge)")(lambda d: history.badge_summary(d.peers(), d.presence()))
_UNIT = ["structure", "feeder", "subtype", "vault", "lat", "lon", "kva"]
_SIDES = ", ".join(f"{t}.{c} AS {side}_{c}" for t, side in (("x", "current"), ("y", "recommended")) for c in _UNIT)
_PLACES_OF = ["badge_feeder", "model_lat", "model_lon", "gis_lat", "gis_lon"]
_ENRICH = ["badge", "cluster", "current", "recommended", "address", "city", *_PLACES_OF, "model_gis_distance_m", "location_differs", *(f"{side}_{c}" for side in ("current", "recommended") for c in _UNIT), "current_distance_m", "recommended_distance_m", "recommendation_type"]
query(
    "enriched_corrections",
    f"""SELECT c.badge, c.cluster, c."current", c.recommended, g.address, g.city, round({_d('m.', 'g.')}, 1) AS model_gis_distance_m, coalesce(round({_d('m.', 'g.')}, 1) > 100, false) AS location_differs, {_SIDES}, g.feeder AS badge_feeder, m.lat AS model_lat, m.lon AS model_lon, g.lat AS gis_lat, g.lon AS gis_lon, round({_d('g.', 'x.')}, 1) AS current_distance_m, round({_d('g.', 'y.')}, 1) AS recommended_distance_m,
 CASE WHEN c."current" IS NULL THEN 'new_assignment' WHEN x.feeder IS NULL OR y.feeder IS NULL THEN 'unknown_feeder' WHEN x.feeder = y.feeder THEN 'same_feeder_ambiguous' ELSE 'cross_feeder_likely_gis_error' END AS recommendation_type
 FROM corrections c LEFT JOIN gis g ON g.badge = c.badge LEFT JOIN model m ON m.badge = c.badge LEFT JOIN lookup x ON x.transformer = c."current" LEFT JOIN lookup y ON y.transformer = c.recommended""",
)(lambda d: enrich.enrich_corrections(d.corrections(), d.gis, d.lookup, d.model).select(*_ENRICH))
query("recommendation_types", "SELECT CASE WHEN c.\"current\" IS NULL THEN 'new_assignment' WHEN x.feeder IS NULL OR y.feeder IS NULL THEN 'unknown_feeder' WHEN x.feeder = y.feeder THEN 'same_feeder_ambiguous' ELSE 'cross_feeder_likely_gis_error' END AS recommendation_type, count(*) AS n FROM corrections c LEFT JOIN lookup x ON x.transformer = c.\"current\" LEFT JOIN lookup y ON y.transformer = c.recommended GROUP BY ALL")(
    lambda d: enrich.enrich_corrections(d.corrections(), d.gis, d.lookup, d.model).groupBy("recommendation_type").agg(F.count(F.lit(1)).alias("n"))
)
query(
    "missing_from_register",
    "SELECT n.badge, n.cluster, cluster_size, mapped_peers, j.transformer AS majority_transformer, coalesce(votes, 0) AS majority_votes, round(coalesce(votes, 0) / nullif(mapped_peers, 0), 3) AS majority_share, l.structure AS recommended_structure, l.feeder AS recommended_feeder, l.vault AS recommended_vault, l.lat AS recommended_lat, l.lon AS recommended_lon, l.kva AS recommended_kva FROM new_run n JOIN sizes s ON s.cluster = n.cluster LEFT JOIN majority j ON j.cluster = n.cluster LEFT JOIN lookup l ON l.transformer = j.transformer WHERE n.badge NOT IN (SELECT badge FROM gis) AND n.badge IN (SELECT badge FROM active)",
)(lambda d: enrich.missing_from_register(d.new_run, d.gis, d.active(), d.mapping, d.lookup))
query("location_discrepancies", f"SELECT m.badge, m.lat AS model_lat, m.lon AS model_lon, g.address, g.city, g.lat AS gis_lat, g.lon AS gis_lon, round({_d('m.', 'g.')}, 1) AS distance_m FROM model m JOIN gis g ON g.badge = m.badge WHERE round({_d('m.', 'g.')}, 1) > 100")(lambda d: enrich.location_discrepancies(d.model, d.gis))
query("clusters_enriched", "SELECT n.badge, n.cluster, g.gis_transformer, g.bank_tag, g.address, g.city, g.lon AS gis_lon, g.lat AS gis_lat, g.feeder, m.lat AS model_lat, m.lon AS model_lon, s.size AS cluster_size FROM new_run n LEFT JOIN gis g ON g.badge = n.badge LEFT JOIN model m ON m.badge = n.badge JOIN new_sizes s ON s.cluster = n.cluster")(lambda d: enrich.clusters_enriched(d.new_run, d.gis, d.model))
query("badge_changes", "SELECT * FROM changes")(lambda d: compare.badge_changes(d.old_run, d.new_run))
query("cluster_splits", "SELECT * FROM splits")(lambda d: compare.splits(d.old_run, d.new_run))
query("cluster_merges", "SELECT * FROM merges")(lambda d: compare.merges(d.old_run, d.new_run))
query("identical_clusters", "SELECT * FROM identical")(lambda d: compare.identical(d.old_run, d.new_run))
query("corrections_diff", "SELECT * FROM diff")(lambda d: compare.corrections_diff(d.old_corrections(), d.corrections()))
query("status_counts", "SELECT status, count(badge) AS n FROM (VALUES ('newly_flagged'), ('no_longer_flagged'), ('recommendation_changed'), ('unchanged')) v(status) LEFT JOIN diff USING (status) GROUP BY status")(lambda d: compare.status_counts(compare.corrections_diff(d.old_corrections(), d.corrections())))
query(
    "run_comparison",
    "SELECT (SELECT count(*) FROM old_run) AS old_badges, (SELECT count(DISTINCT cluster) FROM old_run) AS old_clusters, (SELECT count(*) FROM new_run) AS new_badges, (SELECT count(DISTINCT cluster) FROM new_run) AS new_clusters, (SELECT count(*) FROM common) AS common_badges, (SELECT count(*) FROM changes) AS movers, (SELECT round(avg(jaccard_peers), 3) FROM changes) AS mean_jaccard, (SELECT count(*) FROM splits) AS n_split, (SELECT count(*) FROM merges) AS n_merged, (SELECT count(*) FROM identical) AS n_identical, (SELECT count(*) FROM diff WHERE status = 'newly_flagged') AS newly_flagged, (SELECT count(*) FROM diff WHERE status = 'no_longer_flagged') AS no_longer_flagged, (SELECT count(*) FROM diff WHERE status = 'recommendation_changed') AS recommendation_changed, (SELECT count(*) FROM diff WHERE status = 'unchanged') AS unchanged, (SELECT count(*) FROM new_run) - (SELECT count(*) FROM common) AS added, (SELECT count(*) FROM old_run) - (SELECT count(*) FROM common) AS dropped",
)(lambda d: compare.summary(d.old_run, d.new_run, d.old_corrections(), d.corrections()))
query("metadata_changed", "SELECT o.badge, o.place AS place_old, n.place AS place_new, o.label AS label_old, n.label AS label_new FROM metadata_old o JOIN metadata_new n USING (badge) WHERE o.place IS DISTINCT FROM n.place OR o.label IS DISTINCT FROM n.label")(lambda d: compare.metadata_changed(d.metadata_old, d.metadata_new, ["place", "label"]))
query("added_removed", "SELECT badge, 'added' AS change FROM metadata_new WHERE badge NOT IN (SELECT badge FROM metadata_old) UNION ALL SELECT badge, 'removed' FROM metadata_old WHERE badge NOT IN (SELECT badge FROM metadata_new)")(lambda d: signature.added_removed(d.metadata_old, d.metadata_new))
query("merged_badges", "SELECT badge, coalesce(n.place, o.place) AS place, coalesce(n.label, o.label) AS label FROM metadata_old o FULL JOIN metadata_new n USING (badge)")(lambda d: signature.merge_badges(d.metadata_old, d.metadata_new))
query("pair_daily", "SELECT * FROM daily")(lambda d: d.daily())
query("ledger_window", 'SELECT badge_a, badge_b, len("values") AS n, round(list_sum("values"), 6) AS total, historical_n, round(historical_mean, 9) AS historical_mean, first_day, last_day FROM ledger')(
    lambda d: ledger.ledger(d.daily()).select("badge_a", "badge_b", F.size("values").alias("n"), F.round(F.reduce("values", F.lit(0.0), lambda s, x: s + x), 6).alias("total"), "historical_n", F.round("historical_mean", 9).alias("historical_mean"), "first_day", "last_day")
)
query("ledger_stats", 'SELECT badge_a, badge_b, round(list_avg("values"), 9) AS mean, round(CASE WHEN len("values") < 2 THEN 0 ELSE list_stddev_pop("values") END, 6) AS std, round(CASE WHEN len("values") < 6 THEN 0 ELSE list_avg("values"[len("values") - len("values") // 3 + 1:]) - list_avg("values"[:len("values") // 3]) END, 9) + 0 AS trend, len("values") AS n FROM ledger')(
    lambda d: ledger.stats(ledger.ledger(d.daily())).select("badge_a", "badge_b", F.round("mean", 9).alias("mean"), F.round("std", 6).alias("std"), (F.round("trend", 9) + 0.0).alias("trend"), "n")
)
query("cluster_places", "SELECT badge, cluster, row_number() OVER (PARTITION BY cluster ORDER BY badge) AS place FROM new_run")(lambda d: audit.numbered_members(d.new_run))

# Grids, files of the register, sets.
query(
    "slot_grid",
    "SELECT g.slot, count(e.actual) AS n FROM (SELECT unnest(generate_series((SELECT date_trunc('day', min(ts)) FROM readings), (SELECT date_trunc('day', max(ts)) FROM readings), INTERVAL 1 HOUR)) AS slot) g LEFT JOIN (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS slot, actual FROM readings) e ON e.slot = g.slot GROUP BY g.slot",
)(lambda d: _slot_grid(d))


def _slot_grid(d: Data) -> DataFrame:
    """Every hour of the days there are, with the readings it has: a grid joined with what lies on it."""
    ends = d.readings.agg(F.date_trunc("day", F.min("ts")).alias("a"), F.date_trunc("day", F.max("ts")).alias("b"))
    grid = ends.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 HOUR"))).alias("slot"))
    own = d.readings.select(F.date_trunc("hour", "ts").alias("slot"), "actual")
    return grid.join(own.groupBy("slot").agg(F.count("actual").alias("n")), "slot", "left").fillna(0, ["n"])


_REGISTER = [f"' ' || CAST({_K} AS STRING) || CASE {_K} % 3 WHEN 0 THEN '.0 ' WHEN 1 THEN '' ELSE ' ' END AS BADGENUMBER", f"CASE {_K} % 5 WHEN 0 THEN 'nan' WHEN 1 THEN '' ELSE CAST({_CELL} AS STRING) || '.0' END AS TRANSFORMERBANKOBJECTID", f"CASE {_K} % 4 WHEN 0 THEN ' ' ELSE 'G' || CAST({_CELL} % 40 AS STRING) END AS TRANSBANKTAG", "c_name AS CCBADDRESS1", "c_mktsegment AS CCBCITY", f"CASE {_K} % 6 WHEN 0 THEN 'east' ELSE CAST({_K} % 90 AS STRING) || '.5' END AS POINT_X", f"CAST({_K} % 80 AS STRING) || '.25' AS POINT_Y", "CAST(c_nationkey AS STRING) AS FEEDERID", "'F' || CAST(c_nationkey AS STRING) AS d_FEEDERID"]
STAND_INS["register_points"] = ("customer", _REGISTER, "true")
STAND_INS["register_units"] = ("nation", ["CASE n_nationkey % 5 WHEN 0 THEN ' ' ELSE ' G' || CAST(n_nationkey AS STRING) || ' ' END AS TAG", "n_name AS STRUCTNO", "CAST(n_regionkey AS STRING) AS FEEDERID", "'F' || CAST(n_regionkey AS STRING) AS d_FEEDERID", "'x' AS d_SUBTYPECD", "'v' AS VAULTCD", "CAST(n_nationkey AS STRING) || '.5' AS POINT_X", "'n/a' AS POINT_Y", "CAST(n_nationkey * 10 AS STRING) AS TOTALKVA"], "true")
_BADGE = "regexp_replace(trim(BADGENUMBER), '\\.0+$', '')"
_BANK = "CASE WHEN trim(TRANSFORMERBANKOBJECTID) IN ('', 'nan', 'None') THEN NULL ELSE regexp_replace(trim(TRANSFORMERBANKOBJECTID), '\\.0+$', '') END"
PARTS = {k: f"SELECT {', '.join(STAND_INS[k][1])} FROM {STAND_INS[k][0]} WHERE {STAND_INS[k][2]}" for k in ("register_points", "register_units")} | PARTS
PARTS["points"] = f"SELECT {_BADGE} AS badge, {_BANK} AS gis_transformer, nullif(trim(TRANSBANKTAG), '') AS bank_tag, CCBADDRESS1 AS address, CCBCITY AS city, try_cast(POINT_X AS DOUBLE) AS lon, try_cast(POINT_Y AS DOUBLE) AS lat, d_FEEDERID AS feeder FROM register_points"
PARTS["unit_rows"] = "SELECT trim(TAG) AS tag, STRUCTNO AS structure, FEEDERID AS feeder_raw, d_FEEDERID AS feeder, d_SUBTYPECD AS subtype, VAULTCD AS vault, try_cast(POINT_X AS DOUBLE) AS lon, try_cast(POINT_Y AS DOUBLE) AS lat, try_cast(TOTALKVA AS DOUBLE) AS kva FROM register_units WHERE trim(TAG) <> ''"
query("register_service_points", "SELECT * FROM points")(lambda d: enrich.service_points(d.register_points))
query("register_transformers", "SELECT * FROM unit_rows")(lambda d: enrich.transformers(d.register_units))
query("transformer_lookup", "SELECT b.transformer, structure, feeder_raw, feeder, subtype, vault, lon, lat, kva FROM (SELECT gis_transformer AS transformer, min(bank_tag) AS tag FROM points WHERE gis_transformer IS NOT NULL AND bank_tag IS NOT NULL GROUP BY ALL) b LEFT JOIN unit_rows u ON u.tag = b.tag")(
    lambda d: enrich.transformer_lookup(enrich.service_points(d.register_points), enrich.transformers(d.register_units))
)
query("known_mapping", f"SELECT {_BADGE} AS badge, CASE WHEN trim(TRANSFORMERBANKOBJECTID) IN ('nan', 'None', '<NA>') THEN NULL ELSE regexp_replace(trim(TRANSFORMERBANKOBJECTID), '\\.0+$', '') END AS transformer FROM register_points WHERE {_BADGE} IN (SELECT CAST(o_custkey AS STRING) FROM orders)")(
    lambda d: audit.known_mapping(d.register_points, d.table("orders").select(F.col("o_custkey").cast("string").alias("badge")))
)
query("common_badges", "SELECT badge FROM old_run INTERSECT SELECT badge FROM new_run")(lambda d: d.old_run.select("badge").intersect(d.new_run.select("badge")))
query("peer_sets", "SELECT cluster, list_sort(list(badge)) AS members FROM new_run GROUP BY cluster")(lambda d: d.new_run.groupBy("cluster").agg(F.array_sort(F.collect_set("badge")).alias("members")))
query("all_runs", "SELECT run, count(*) AS n_badges, count(DISTINCT cluster) AS n_clusters FROM three GROUP BY run")(
    lambda d: d.old_run.withColumn("run", F.lit("r1")).unionByName(d.mid_run.withColumn("run", F.lit("r2"))).unionByName(d.new_run.withColumn("run", F.lit("r3"))).groupBy("run").agg(F.count(F.lit(1)).alias("n_badges"), F.countDistinct("cluster").alias("n_clusters"))
)
query("change_report", "SELECT a.badge AS added, r.badge AS removed FROM (SELECT badge, row_number() OVER (ORDER BY badge) AS i FROM (SELECT badge FROM metadata_new EXCEPT SELECT badge FROM metadata_old)) a FULL JOIN (SELECT badge, row_number() OVER (ORDER BY badge) AS i FROM (SELECT badge FROM metadata_old EXCEPT SELECT badge FROM metadata_new)) r USING (i)")(
    lambda d: side_by_side(d.metadata_new.select(F.col("badge").alias("added")).subtract(d.metadata_old.select("badge")), d.metadata_old.select(F.col("badge").alias("removed")).subtract(d.metadata_new.select("badge")))
)
