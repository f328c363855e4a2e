"""Spark session defaults and lineage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "parcelrisk",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings every job here assumes.

    Locally (tests, bench) we pin the master, driver memory and a small shuffle
    width so tiny tables are not split 200 ways. On a cluster (spark-submit sets
    the master) sizing is left to the cluster's configuration; AQE coalesces
    shuffle partitions to its advisory size and splits skewed join partitions.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (SparkSession.builder.appName(app)
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.sources.partitionOverwriteMode", "dynamic"))
    local = master is not None or not os.environ.get("SPARK_MASTER")
    if local:
        builder = (builder.master(master or f"local[{cpus}]")
                   .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
                   .config("spark.driver.memory", os.environ.get("PARCELRISK_DRIVER_MEM", "16g")))
    elif shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; we only invent one (a fresh temp
    folder) when the setting is absent and the master is local, as in tests.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "")
        if master and not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="parcelrisk-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    try:
        sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(path)
    except Exception:  # noqa: BLE001  (Connect sessions read spark.checkpoint.dir themselves)
        pass
    return path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000    # that an executor and a Python worker hold as one batch; rows may have long texts


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Later stages read the files, so a lost executor costs no recomputation, and the shuffle files that led to them
    are deleted as soon as they are written. Spark knows the size of what it reads back. Python workers get small batches.
    """
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    before = {k: spark.conf.get(k, default) for k, default in ((_CLEANUP, "false"), (_BATCH, "10000"))}
    spark.conf.set(_CLEANUP, "true")
    spark.conf.set(_BATCH, str(min(BATCH_ROWS, int(before[_BATCH])) if int(before[_BATCH]) > 0 else BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
