"""Session helpers: a local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "counterpoise") -> SparkSession:
    """Return the active session or build a local one configured for this library."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = (
        SparkSession.builder.master(master or "local[*]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("COUNTERPOISE_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage (``spark.checkpoint.dir``).

    The cluster names it; we only read it.  When it is unset and the session
    runs in local mode (tests, benches) a private folder is created; on a
    cluster an unset checkpoint folder is an error, because a machine-local
    folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="counterpoise-cp-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder for tables this library writes."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_held = {"lock": threading.Lock(), "users": 0, "before": None}


@contextmanager
def small_batches(spark: SparkSession, most: int = 16 << 20):
    """While inside, batches to Python hold at most about ``most`` bytes; several threads may be inside at once."""
    known = spark.conf.isModifiable(_BATCH_BYTES)
    with _held["lock"]:
        if known and not _held["users"]:
            _held["before"] = spark.conf.get(_BATCH_BYTES)
            spark.conf.set(_BATCH_BYTES, str(most))
        _held["users"] += 1
    try:
        yield
    finally:
        with _held["lock"]:
            _held["users"] -= 1
            if known and not _held["users"]:
                spark.conf.set(_BATCH_BYTES, _held["before"])
