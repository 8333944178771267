"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

from tramloom.errors import TransitError

#: Run-time settings the plans rely on.  All of them can be set on a live session.
RUNTIME_SETTINGS = {
    # Facts are UTC; every local conversion names its zone explicitly.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot join key even where that costs one more exchange above it.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Lets the rebalance before a partitioned write cut hot partitions up.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Rows that lie together by part of a join's keys are not shuffled again for the join.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.parquet.compression.codec": "zstd",
    # The JVM leaves larger methods uncompiled; splitting such a stage is far faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_own_dirs: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "tramloom", cores: str = "*", **extra: str) -> SparkSession:
    """A single-machine session, for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Small test tables should still use all cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.driver.memory", extra.pop("driver_memory", "8g"))
        .config("spark.sql.shuffle.partitions", extra.pop("shuffle_partitions", "8"))
    )
    for key, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    A local session without the setting gets a folder of its own.  A cluster
    session without it is an error: a path only one machine sees would lose data
    with that machine.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise TransitError("set spark.checkpoint.dir to a folder shared by the cluster")
    key = context.applicationId
    if key not in _own_dirs:
        _own_dirs[key] = tempfile.mkdtemp(prefix="tramloom-")
        context.setCheckpointDir(_own_dirs[key])
    return _own_dirs[key]
