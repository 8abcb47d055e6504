"""Session configuration and the shared scratch location.

Library functions never create sessions; this module is for entry points,
tests and the bench.  Scratch output (written drop folders, lineage cuts)
always goes under the cluster's ``spark.checkpoint.dir``; only a session on one
machine that has none gets a temporary one (tests, local runs).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  Shuffle partition count is sized by the caller;
# AQE coalesces small partitions and splits skewed join partitions at runtime.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "voltrail") -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "16g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared folder (``spark.checkpoint.dir``).

    On a cluster it must be set: a machine's own folder isn't seen by the others.  A session that
    runs on one machine (``local[..]``) and has none gets a temporary one.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="voltrail-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder, on whatever file system that is."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def file_system(spark: SparkSession, path: str):
    """(file system, path) through Spark's own connectors: any store that its readers reach."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def utc_session(spark: SparkSession) -> SparkSession:
    """``spark`` itself where its time zone is UTC, else a session beside it that differs in this alone.

    Ticks are UTC wall-clock times, and texts of them are made in the session's zone; the caller's
    own settings stay as they are.
    """
    if spark.conf.get("spark.sql.session.timeZone") == "UTC":
        return spark
    beside = spark.__dict__.get("_voltrail_utc")
    if beside is None:
        beside = spark.newSession()
        for key, value in spark.conf.getAll.items():
            if spark.conf.isModifiable(key):
                beside.conf.set(key, value)
        beside.conf.set("spark.sql.session.timeZone", "UTC")
        spark._voltrail_utc = beside
    return beside
