"""Spark session helpers.

Cluster jobs receive a session from the caller; ``get_session`` only fills in
settings that are unset, so a cluster's own configuration always wins.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job in this library relies on.  Time zone: all timestamps in
# the data model are zone-less, so day boundaries must not depend on the host.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Sensible defaults, applied only where the session leaves them unset.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming state (dedup keys, per-window users) grows with traffic:
    # RocksDB keeps it on local disk with bounded memory, checkpointed to the
    # shared checkpoint folder like any state store.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, app_name: str = "splitlens",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        configure(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", os.environ.get("SPLITLENS_DRIVER_MEMORY", "16g")))
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**DEFAULT_CONF, **REQUIRED_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply required settings and defaults that the session does not set yet."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    for k, v in DEFAULT_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared folder
    there).  Where it is unset, a cluster gets an error, because a folder of
    one machine is not seen by the others; a ``local`` session, whose driver
    is its only executor, gets a scratch folder, registered so that every
    later call agrees on it.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all "
                             f"executors share (master: {master})")
        d = tempfile.mkdtemp(prefix="splitlens-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - a core setting may be read-only at runtime
            pass
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


@contextmanager
def co_located(spark: SparkSession):
    """Within, plans made over tables bucketed by user join and fold on (run, user) without a
    shuffle: rows of one user are together whatever their run.  Outside, Spark wants
    all keys of a join in the partitioning, which is safer where single users are hot."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield spark
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


# What size_for_input has set, by application: only that may it change again.
_SIZED: dict[tuple[str, str], str] = {}


def size_for_input(spark: SparkSession, input_bytes: int, partition_bytes: int = 256 << 20,
                   expansion: float = 3.0) -> dict:
    """Partition settings for a job reading about ``input_bytes`` of Parquet,
    applied only where the session -- its start-up configuration or a later
    ``spark.conf.set`` -- leaves them unset: shuffle partitions so that each
    holds about ``partition_bytes`` of rows before adaptive coalescing (rows
    take about ``expansion`` times their compressed files), split size for the
    scans, and the advisory / skew sizes adaptive execution works with.
    Returns the values in effect."""
    n = max(1, -(-int(input_bytes * expansion) // partition_bytes))
    wanted = {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes * 2),
    }
    out = {}
    for k, v in wanted.items():
        own = (spark.sparkContext.applicationId, k)
        if spark.conf.get(k, None) in (None, _SIZED.get(own)):
            spark.conf.set(k, v)
            _SIZED[own] = v
        out[k] = spark.conf.get(k)
    return out
