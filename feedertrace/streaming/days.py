"""The daily feed as a stream: day files arrive in order, and each micro-batch brings the ledger a day further."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedertrace import schemas
from feedertrace.operators import ledger
from feedertrace.sources.metering import Versions


def follow_pair_days(spark: SparkSession, folder: str, table: str, checkpoint: str, *, keep: int = 60, overwrite: bool = False) -> StreamingQuery:
    """Fold new files of (badge_a, badge_b, day, r) into the ledger at ``table``, a file a batch, oldest first.

    What was folded is in the checkpoint, so a restart goes on where it stopped, and a day that comes again or too late
    leaves its pairs as they are. ``overwrite`` begins a new ledger; then the checkpoint must be new too.
    """
    store = Versions(spark, table, schemas.LEDGER)
    if overwrite:
        store.write(spark.createDataFrame([], schemas.LEDGER))

    def fold(rows: DataFrame, _: int) -> None:
        days = [r[0] for r in rows.select("day").distinct().orderBy("day").collect()]
        for day in days:
            store.write(ledger.update(store.read(), rows.where(F.col("day") == day).select("badge_a", "badge_b", "day", "r"), keep=keep))

    feed = spark.readStream.schema(schemas.PAIR_DAILY).option("maxFilesPerTrigger", 1).parquet(folder)
    return feed.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(measurements: DataFrame, *, late: str = "1 day", minutes: int = 15) -> DataFrame:
    """(badge, slot, pu, n) of a stream of measurements: the mean of each badge and slot, until ``late`` after it."""
    own = measurements.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    out = own.groupBy("badge", F.window("ts", f"{minutes} minutes").alias("w")).agg(F.avg("pu").alias("pu"), F.count(F.lit(1)).alias("n"))
    return out.select("badge", F.col("w.start").alias("slot"), "pu", "n")
