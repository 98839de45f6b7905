"""Session conventions.  The library never creates or stops a session itself;
these helpers are for tests, the bench and examples."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "settleline") -> SparkSession:
    """Local test session: UTC, ANSI and AQE on, UI off, checkpoint dir in scratch."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SETTLELINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the session's shared checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder and
    is used as is; a local scratch folder is only chosen when nothing is
    configured, which is the test situation.
    """
    current = configured_checkpoint_dir(spark)
    if not current:
        current = fallback or tempfile.mkdtemp(prefix="settleline-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, current)
        spark.sparkContext.setCheckpointDir(current)
    return current


def configured_checkpoint_dir(spark: SparkSession) -> str | None:
    """The cluster's shared checkpoint folder, if the session names one."""
    current = spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    return current or None


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` when set,
    else ``fallback`` (callers pass a folder next to their output tables, which
    lives on the same shared storage); raises when neither exists."""
    current = configured_checkpoint_dir(spark) or fallback
    if not current:
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set: configure a shared folder for intermediate tables"
        )
    return current
