"""SparkSession helpers.

On a cluster the session is created by the platform and already carries the
right settings (`spark.checkpoint.dir`, shuffle partitions, memory).  The
helpers here only fill in what is missing, so the same code runs unchanged in
tests on ``local[*]`` and on a 1000-executor cluster.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for every job in this package.  AQE re-plans joins and
# coalesces shuffle partitions from runtime statistics; skew-join splitting is
# what keeps a hot customer / product / rep key from landing in one task.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "quotalake") -> SparkSession:
    """A local session for tests and the benchmark (UI off, no ports opened)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("QUOTALAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_scratch(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the package defaults on an existing session, keeping explicit settings."""
    for key, value in _DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    if spark.conf.get("spark.sql.ansi.enabled").lower() != "true":
        raise ValueError("spark.sql.ansi.enabled must be true: sums in BIGINT cents would wrap silently")
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process (or the session tells nothing else)."""
    return spark.conf.get("spark.master", "").split("[")[0] == "local"


def shared_scratch(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` for intermediate tables.

    Only a local session gets a fresh scratch folder where none is named; on a
    cluster executors would each write to a disk of their own, so it raises.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="quotalake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")
