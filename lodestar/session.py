"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def _default_driver_memory() -> str:
    """About 60 % of physical memory (1 to 24 GiB): local mode runs everything in the driver JVM."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    gib = max(1, min(24, int(total * 0.6 / 2**30)))
    return f"{gib}g"


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "lodestar") -> SparkSession:
    """Local session used by tests and the bench. On a cluster, build the session there instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LODESTAR_DRIVER_MEMORY", _default_driver_memory()))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only in local mode, when nothing is configured (tests), a folder of our own is set; on a cluster a
    folder of the driver's machine would be another one on every executor, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="lodestar-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def bounded_batches(spark: SparkSession, most: int = 2 << 20) -> None:
    """Let an Arrow batch between the JVM and its Python workers hold about ``most`` bytes, unless the session sets a bound itself.

    Spark's 10,000 rows are a whole file split of long texts, which the JVM, its send buffer and the worker then each hold once a task.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(most))
