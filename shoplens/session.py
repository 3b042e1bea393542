"""Session construction and the shared work folder.

Cluster jobs get their session from the platform; this module only fills in
settings that are unset, so a cluster's own values always win. Tests and the
bench call :func:`get_session` to build a local one.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC day/hour boundaries and AQE for runtime
# re-planning (partition coalescing, skew-join splitting, broadcast switch).
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster (~100 TB input, ~1000 executors). AQE starts
# from many shuffle partitions and coalesces them to ~256 MB each, so the same
# job neither spills on big stages nor schedules thousands of empty tasks on
# small ones; skewed partitions above 512 MB and 5x the median are split.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Spark's own defaults for the keys above: a session still holding one of
# these values has not been tuned by its owner and may take ours.
_SPARK_DEFAULTS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": None,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5.0",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.shuffle.partitions": "200",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
}


def apply_scale_settings(spark: SparkSession) -> dict[str, str]:
    """Apply :data:`SCALE_SETTINGS` where the session still has Spark's
    default (explicit choices of the cluster owner win). Returns what changed.
    The state-store provider only takes effect for queries started afterwards
    with a new checkpoint."""
    changed = {}
    for key, value in SCALE_SETTINGS.items():
        current = spark.conf.get(key, None)
        untuned = current in (None, "") or (key in _SPARK_DEFAULTS and current == _SPARK_DEFAULTS[key])
        if untuned and current != value:
            spark.conf.set(key, value)
            changed[key] = value
    return changed


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for what is started inside; put back after."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def state_partitions(spark: SparkSession) -> int:
    """Partitions of a new streaming query's state: two a core, never more than
    the session's shuffle partitions. Each costs a task and, for each state
    operator, files in the checkpoint with every micro-batch, however few rows
    it holds; a checkpoint keeps the number that it was made with."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - Spark Connect: the cluster's cores are not known
        return most
    return min(most, max(16, 2 * cores))


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "shoplens") -> SparkSession:
    """Return the active session or build a local one for tests / bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("SHOPLENS_DRIVER_MEMORY", "4g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, stream state and staged tables.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach; it is read from the session and never replaced. Only when it is
    unset (local tests) a scratch folder is created and set.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        sc = None
    if sc is None:
        if not current:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        return current
    current = current or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="shoplens-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def work_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts, uuid.uuid4().hex])
