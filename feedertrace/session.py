"""Session helpers: the shared scratch folder, and tables that cut lineage there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Of the largest heap that the driver may have: from there on it is collected.
_HEAP_SHARE = 0.5
#: The heap's size after that.
_heap = 0


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, a temporary one in local mode and an error elsewhere:
    the driver and all executors must reach it.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="feedertrace-")
        spark.conf.set("spark.checkpoint.dir", where)
    jsc = spark.sparkContext._jsc
    if not jsc.sc().getCheckpointDir().isDefined():
        jsc.setCheckpointDir(where)
    return where


def relieve(spark: SparkSession) -> None:
    """Collect the driver's garbage where its heap has grown past ``_HEAP_SHARE`` since it was last collected.

    Each plan leaves broadcasts, task binaries and results behind. The JVM rather grows than collects them, up to its
    limit, and gives nothing back by itself; a whole collection does, and Spark's cleaner then drops what no plan uses.
    """
    global _heap
    jvm = spark.sparkContext._jvm
    runtime = jvm.java.lang.Runtime.getRuntime()
    if runtime.totalMemory() > max(_heap, _HEAP_SHARE * runtime.maxMemory()):
        jvm.java.lang.System.gc()
        _heap = runtime.totalMemory()


def materialize(df: DataFrame, label: str, *, drop_shuffles: bool = False) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    The plan above then no longer depends on what came before: a lost executor costs its tasks alone, and a
    second reader does not compute it again. Files stay until the shared folder is cleared. ``drop_shuffles``: the
    write's own shuffle files go when it is done, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    if drop_shuffles:
        spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if drop_shuffles:
            spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    relieve(spark)
    return spark.read.schema(df.schema).parquet(path)


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable ``checkpoint()`` in the shared folder: keeps partitions and their row order."""
    shared_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    relieve(df.sparkSession)
    return out


def source_bytes(df: DataFrame) -> int | None:
    """The bytes of what ``df`` is read from, by Spark's own estimates (files' sizes; nothing is read), or None if it
    has no estimate for a source."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    unknown = df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes()
    return sum(sizes) if all(x < unknown for x in sizes) else None


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
