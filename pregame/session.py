"""Spark session helpers."""
from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "pregame") -> SparkSession:
    """Session for tests and the local benchmark (on a cluster, use the
    cluster's own session; nothing here is required by the library)."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or cpus
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder.

    On a cluster the folder is the shared one named in ``spark.checkpoint.dir``;
    we never invent one there.  Only a local-mode session with nothing set
    (tests, the local benchmark) gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder of the cluster")
    path = tempfile.mkdtemp(prefix="pregame-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """What a query shuffles goes as the query ends, and not when the driver happens to
    collect its garbage: for steps whose result is written and read back, so that no
    step's files lie beside the next one's.  Tables kept by ``persist`` are untouched."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
