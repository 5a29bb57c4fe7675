"""Session defaults for the jobs.

The jobs are written for a large cluster; the settings below are the ones
that matter for their plans (AQE with skew-join splitting, UTC time, ANSI
arithmetic) and are applied only when the caller has not set them.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Target size of partitions after AQE coalesces or splits them: large
    # enough for few tasks, small enough to sort and aggregate without spilling.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Size-checked broadcast: the planner (statically) and AQE (at runtime,
    # from real shuffle sizes) only broadcast relations below this bound and
    # fall back to a shuffle join beyond it.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Remove a checkpoint's files once the frame that wrote it is gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "parcelbeam", driver_memory: str | None = None) -> SparkSession:
    """Local or cluster session with the job defaults.

    On a cluster ``master`` and memory are left to spark-submit.  In local mode
    the driver JVM is the only executor, so its heap is the knob that matters
    (``driver_memory``, default 8g for ``local[...]`` masters).  The Spark UI
    is kept off: the jobs are batch jobs and open no port of their own.
    """
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", driver_memory or "8g")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets it to shared storage and it is only read
    here; unset on a cluster is an error.  Only for a local master (tests,
    local runs) is a scratch folder created when it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:  # already set (by spark.checkpoint.dir at start-up or an earlier call)
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: point it at a folder every executor "
                             "can reach (HDFS, object store); a machine-local folder cannot hold checkpoints")
        configured = tempfile.mkdtemp(prefix="parcelbeam-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def stable(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame that several outputs read: reliable
    ``checkpoint()`` into the shared ``spark.checkpoint.dir`` (persisted first
    so it is computed once).  After an executor loss its blocks are re-read
    from the shared folder instead of re-running the joins above it."""
    ensure_checkpoint_dir(df.sparkSession)
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return kept.checkpoint(eager=True)
    finally:
        kept.unpersist()


_written: dict[str, list[str]] = {}


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared checkpoint folder.  Unlike a
    checkpoint it is computed once and read by column, so frames that are read several
    times go through it; like one it outlives its executors."""
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    # with the schema given, no job reads file footers
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder through Spark's file systems; a missing one is fine."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release_written(spark: SparkSession) -> None:
    """Delete the tables that ``written`` made in this application, once every result is delivered."""
    for path in _written.pop(spark.sparkContext.applicationId, []):
        delete_path(spark, path)
