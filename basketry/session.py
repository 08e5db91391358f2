"""SparkSession construction and checkpoint-directory handling."""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "basketry", extra_conf: dict | None = None) -> SparkSession:
    """Session tuned for the analytics jobs.

    AQE stays on (runtime coalescing, skew-join splitting, broadcast
    conversion from measured sizes).  The session time zone is UTC so that
    day arithmetic is identical on every executor.  A master given by
    ``spark-submit`` (``spark.master``) is respected; local defaults (8
    shuffle partitions, driver memory) apply only to local sessions.
    """
    SparkContext._ensure_initialized()   # attach to the JVM so spark-submit's conf is visible
    submitted = SparkConf().get("spark.master", None)
    master = master or os.environ.get("BASKETRY_MASTER") or submitted or "local[8]"
    local = master.startswith("local")
    builder = SparkSession.builder.appName(app_name)
    if master != submitted:
        builder = builder.master(master)
    if shuffle_partitions is None and local:
        shuffle_partitions = int(os.environ.get("BASKETRY_SHUFFLE_PARTITIONS", "8"))
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (builder
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true")
               # files of checkpoints that nothing refers to any more are removed
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if local:
        builder = builder.config("spark.driver.memory",
                                 os.environ.get("BASKETRY_DRIVER_MEMORY", "16g"))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a directory.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that
    setting always wins.  Only a local-mode session without the setting
    (tests, benches) gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # not set in the SQL conf either
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is unset; name a shared folder for reliable checkpoints")
    scratch = tempfile.mkdtemp(prefix="basketry-ckpt-")
    sc.setCheckpointDir(scratch)
    return scratch
