"""Session set-up and the shared work folder.

Every query assumes the session time zone is UTC (hours and dates of event time
must not follow the JVM's zone). Intermediate tables, stream checkpoints and
lineage cuts go below ``spark.checkpoint.dir``: on a cluster that is a shared
folder named by the cluster; only when it is unset (tests, local runs) do we set
our own.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_FALLBACK: str | None = None


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "zonecast",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests, bench and local runs. Cluster jobs get theirs from spark-submit."""
    master = master or os.environ.get("ZONECAST_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # AQE merges small shuffle partitions up to this size and splits skewed ones; scans
        # are cut at the same size. On a cluster set spark.sql.shuffle.partitions high
        # (input bytes / ~200 MB) and let AQE coalesce down.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.files.maxPartitionBytes", "128m")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("ZONECAST_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoint files go when the frames that use them do
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Event hour and date are defined in UTC (the events carry UTC offsets)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; set one only where it is unset."""
    global _LOCAL_FALLBACK
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir() or configured
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _LOCAL_FALLBACK is None:
        _LOCAL_FALLBACK = tempfile.mkdtemp(prefix="zonecast-ckpt-")
        atexit.register(shutil.rmtree, _LOCAL_FALLBACK, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(_LOCAL_FALLBACK)
    return spark.sparkContext.getCheckpointDir()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run of one job (tables, stream checkpoints), never reused. All of an application's folders lie
    below one, which ``clear_work`` removes."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def work_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/zonecast-work/{spark.sparkContext.applicationId}"


def clear_work(spark: SparkSession) -> None:
    """Remove this application's work folders: for the end of a job, when its results are written elsewhere."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(work_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def with_scalars(df, name: str, stats_df):
    """Attach the single row of ``stats_df`` (an ungrouped aggregate) to every row of ``df`` as
    struct column ``name``: one scalar subquery, evaluated once; read fields with ``name.field``.

    Referencing a scalar subquery once keeps Spark from running it once per reference."""
    from pyspark.sql import functions as F

    return df.withColumn(name, stats_df.select(F.struct(*stats_df.columns)).scalar())


def materialize(df):
    """Compute ``df`` once and cut its lineage with a reliable checkpoint in the shared folder.

    Use for small intermediate results read by several branches of one plan (column
    pruning makes the branches differ, so Spark would otherwise recompute them)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
