"""Spark session settings and shared-folder handling."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session-level SQL settings every tripmart job relies on. All are runtime
# settable, so they can be applied to a session someone else built.
SQL_CONF = {
    # Timestamps with a zone (ingestion_ts) are stored and shown in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, turn small joins into broadcasts.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Semi-joins of a large table with an increment: a Bloom filter of the
    # increment's keys, for increments of up to this size.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    # Exact sums list what lies outside the common window, nearly always
    # nothing: aggregate by hash up to this many groups of a task.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "20000",
    # HotSpot never compiles a method of more bytecode than this, and a fused
    # stage of many exact sums is one such method, interpreted row by row.
    # Beyond it Spark splits the expressions into methods that are compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SQL_CONF` to an existing session (idempotent)."""
    for key, value in SQL_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app: str = "tripmart",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with tripmart's settings.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to
    the data (roughly input bytes / 128 MB for the first shuffle; AQE
    coalesces from there). Locally it defaults to the core count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions is None and master and master.startswith("local"):
        shuffle_partitions = os.cpu_count() or 8
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SQL_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    return configure(spark)


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints and scratch tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Only on a ``local`` master, where neither need be set, a fresh local
    folder is made and registered. Elsewhere executors could not see such a
    folder, so a missing setting is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        jdir = sc._jsc.sc().getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else None
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tripmart-")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, *parts: str) -> str:
    """A new, unique directory path under the shared root (not created)."""
    return "/".join([shared_root(spark), "tripmart", *parts, uuid.uuid4().hex])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (possibly remote) file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder on its file system; none if missing."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively remove ``path`` (a scratch copy this package wrote)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))
