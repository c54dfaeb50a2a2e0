"""Where measurements come from and go to: the metering database, day files, register files."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedertrace import schemas
from feedertrace.functions.scalar import NOMINAL_VOLTS, day_of_file, nominal_volts, per_unit, split_location

DEVICE_TYPES = tuple(sorted(c for codes in NOMINAL_VOLTS.values() for c in codes))
#: Codes of the metering system: fixed values.
ELECTRIC, BADGE_ID, SERVICE_POINT_ID, PLACE, VOLTAGE, GOOD = "E", "D1BN", "D1EP", "LAT/LONG", "E-V2HVHA-15", "501000"


def hourly_predicates(day: date, column: str = "msrmt_dttm") -> list[str]:
    """A half-open range for each hour of a UTC day: a JDBC read with these has 24 partitions."""
    at = lambda h: f"TIMESTAMP '{day + timedelta(days=h // 24)} {h % 24:02d}:00:00'"
    return [f"{column} >= {at(h)} AND {column} < {at(h + 1)}" for h in range(24)]


def read_jdbc_day(spark: SparkSession, url: str, query: str, day: date, properties: dict[str, str], *, column: str = "msrmt_dttm") -> DataFrame:
    """One day of ``query`` in 24 parallel reads. Failed reads are repeated as tasks are (spark.task.maxFailures)."""
    own = {"fetchsize": "10000", "sessionInitStatement": "ALTER SESSION SET TIME_ZONE = 'UTC'"} | properties
    return spark.read.jdbc(url, f"({query}) q", predicates=hourly_predicates(day, column), properties=own)


def metering_rows(t: dict[str, DataFrame]) -> DataFrame:
    """Measurements from the nine tables of the metering system; ``t`` has them by name.

    Small tables are filtered before they are joined, and Spark chooses what it broadcasts. A meter without a known
    place keeps its rows.
    """
    installed = t["d1_install_evt"].where("d1_removal_dttm IS NULL").select("device_config_id", "d1_sp_id")
    kinds = t["d1_dvc_cfg_type"].where(F.col("d1_svc_type_cd") == ELECTRIC).select("device_config_type_cd")
    devices = t["d1_dvc"].select("d1_device_id", F.trim("device_type_cd").alias("device_type")).where(F.col("device_type").isin(*DEVICE_TYPES))
    badges = t["d1_dvc_identifier"].where(F.col("dvc_id_type_flg") == BADGE_ID).select("d1_device_id", F.col("id_value").alias("badge"))
    points = t["d1_sp_identifier"].where(F.col("sp_id_type_flg") == SERVICE_POINT_ID).select("d1_sp_id", F.col("id_value").alias("prem_id"))
    lat, lon = split_location("geo_val")
    places = t["ci_prem_geo"].where(F.col("geo_type_cd") == PLACE).select("prem_id", lat.alias("lat"), lon.alias("lon"))
    parts = t["d1_measr_comp"].where(F.col("measr_comp_type_cd") == VOLTAGE).select("device_config_id", "measr_comp_id")
    values = t["d1_msrmt"].where(F.col("msrmt_cond_flg") == GOOD).select("measr_comp_id", F.col("msrmt_dttm").alias("ts"), F.col("msrmt_val").cast("double").alias("actual"))
    meters = installed.join(t["d1_dvc_cfg"].select("device_config_id", "device_config_type_cd", "d1_device_id"), "device_config_id").join(kinds, "device_config_type_cd")
    meters = meters.join(devices, "d1_device_id").join(badges, "d1_device_id").join(points, "d1_sp_id").join(places, "prem_id", "left").join(parts, "device_config_id")
    own = values.join(meters.select("measr_comp_id", "badge", "device_type", "lat", "lon"), "measr_comp_id").withColumn("nominal", nominal_volts("device_type"))
    return own.select("badge", "device_type", "lat", "lon", "nominal", "ts", "actual", per_unit("actual", "nominal").alias("pu"))


def read_days(spark: SparkSession, path: str, *, since: date | None = None) -> DataFrame:
    """The day-partitioned store; a filter on ``day`` prunes folders."""
    rows = spark.read.parquet(path)
    return rows.where(F.col("day") >= F.lit(since)) if since else rows


def read_day_files(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Files of a day each, the day taken from the file's name; ``ingest`` orders files by their time of writing."""
    rows = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    return rows.withColumns({"day": day_of_file(F.col("_metadata.file_name")), "ingest": F.col("_metadata.file_modification_time")})


def write_days(rows: DataFrame, path: str) -> None:
    """Write whole days; a day that is there already is replaced, the others stay. Repeating it changes nothing."""
    own = rows.withColumn("day", F.to_date("ts")) if "day" not in rows.columns else rows
    own.repartition("day", F.pmod(F.xxhash64("badge"), F.lit(32))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def missing_days(spark: SparkSession, path: str, start: date, end: date) -> DataFrame:
    """(day) of the range, both ends included, that the store lacks."""
    wanted = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("day"))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return wanted
    return wanted.join(spark.read.parquet(path).select(F.col("day").cast("date").alias("day")).distinct(), "day", "left_anti")


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """A file with a header, by the names in it: the columns of ``schema`` that are there, as text unless it says otherwise."""
    own = spark.read.option("header", True).option("mode", "PERMISSIVE").option("multiLine", True).option("escape", '"').csv(path)
    have = set(own.columns)
    return own.select(*((F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast("string").try_cast(f.dataType).alias(f.name) for f in schema.fields))


def latest_file(spark: SparkSession, pattern: str) -> str | None:
    """The path of the file written last, or None. Only listed, never read."""
    files = spark.read.format("binaryFile").load(pattern).select("path", "modificationTime")
    newest = files.agg(F.max_by("path", F.struct("modificationTime", "path"))).first()
    return newest[0]


def load_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table at ``path``, or an empty one of ``schema``."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def preferred(spark: SparkSession, paths: list[str], schema) -> DataFrame:
    """The first of ``paths`` that is there; an error if none is."""
    for path in paths:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
            return read_csv(spark, path, schema)
    raise FileNotFoundError(f"none of {paths}")


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


class Versions:
    """A table as numbered versions in one folder. A new version is written whole and then named as the current one by a
    single small file, so a reader sees the old one or the new one, and a version may be made from the one before."""

    def __init__(self, spark: SparkSession, path: str, schema):
        self.spark, self.path, self.schema = spark, path, schema

    def current(self) -> int:
        rows = load_or_empty(self.spark, f"{self.path}/_versions", schemas._table(version=schemas.L))
        return rows.agg(F.max("version")).first()[0] or 0

    def read(self) -> DataFrame:
        n = self.current()
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v{n}") if n else self.spark.createDataFrame([], self.schema)

    def write(self, rows: DataFrame) -> int:
        n = self.current() + 1
        rows.select(*(F.col(f.name).cast(f.dataType) for f in self.schema.fields)).write.mode("overwrite").parquet(f"{self.path}/v{n}")
        self.spark.range(1).select(F.lit(n).cast("long").alias("version")).coalesce(1).write.mode("append").parquet(f"{self.path}/_versions")
        return n


def measured(events: DataFrame, *, badge: str, device_type: str, ts: str, actual: str) -> DataFrame:
    """Raw readings as measurements with their nominal and per-unit values."""
    nominal: Column = nominal_volts(device_type)
    return events.select(F.col(badge).cast("string").alias("badge"), F.col(device_type).alias("device_type"), nominal.alias("nominal"), F.col(ts).alias("ts"), F.col(actual).alias("actual"), per_unit(actual, nominal).alias("pu"))
