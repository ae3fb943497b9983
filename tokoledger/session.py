"""Spark session helpers.

On a cluster the session is created by the platform; ``configure`` only fills
in settings that are still unset, so cluster-wide choices (shuffle partitions,
checkpoint directory, broadcast thresholds) always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on; applied only where the session has none.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot outlet's partition even when that costs an extra shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # invoice timestamps are zone-less (T-SQL datetime)
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
}


def configure(spark: SparkSession) -> SparkSession:
    conf = spark.conf
    for key, value in DEFAULTS.items():
        if conf.get(key, None) in (None, ""):
            conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only where the session has none and runs in one process (local tests), a scratch
    folder is created; on a cluster a missing setting is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="tokoledger-ckpt-")
    spark.sparkContext.setCheckpointDir(current)
    return current


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tokoledger") -> SparkSession:
    """Local session for tests and the bench (UI off, no extra ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TOKOLEDGER_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
