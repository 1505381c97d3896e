"""Session helpers: the few settings the mart relies on, and the shared scratch location.

The mart needs UTC session time (epoch seconds <-> timestamps must not move with the
machine's zone) and AQE. Everything else is left to whoever built the session.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the mart's semantics depend on (not tuning).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Defaults that are only applied when the session has no value of its own.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "flowmart") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**DEFAULT_CONF, **REQUIRED_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_conf(spark: SparkSession) -> None:
    """Pin the settings the mart's results depend on; keep the caller's tuning."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    for k, v in DEFAULT_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for materialised tables and checkpoints: the one that the cluster names in
    ``spark.checkpoint.dir`` (or that was set on the context).

    Only a local session (one machine: tests, the bench) may go without; it gets a scratch
    folder. Anywhere else the executors could not see a folder of the driver, so a missing
    setting is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not (sc.master or "").startswith("local") or (sc.master or "").startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="flowmart-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
