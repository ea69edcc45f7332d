"""Session helpers.

Library code never sets engine configuration; that is the job of
``spark-submit``. The one exception is the checkpoint directory: operators
that cut lineage need it, so it is read from the session and only filled
in with a scratch directory when the session runs in local mode (tests,
bench). On a cluster an unset directory is an error, because a
machine-local folder would not survive the loss of an executor.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "tastemap", driver_memory: str = "16g") -> SparkSession:
    """Local session for tests and the bench (never used by the operators)."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    shuffle_partitions = shuffle_partitions or cores
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.worker.reuse", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None)
    return conf or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory; set a scratch one only in local mode."""
    d = checkpoint_dir(spark)
    if d:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
        return spark.sparkContext.getCheckpointDir() or d
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder (HDFS, object store)")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tastemap-ckpt-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint directory for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch-{name}-{uuid.uuid4().hex[:12]}"
