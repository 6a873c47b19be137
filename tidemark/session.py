"""Session construction and shared settings.

Settings that matter for correctness (UTC session zone, ANSI) and for scale
(AQE with skew-join splitting and partition coalescing) live here so tests,
bench and the driver entry all run the same engine configuration.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Largest side, in bytes (in memory), that may be broadcast.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
# Static (plan-time) broadcast threshold of the planner: Spark's default.
PLANNER_BROADCAST_BYTES = 10 * 1024 * 1024
# Target bytes per shuffle partition and per input split.
PARTITION_BYTES = 256 * 1024 * 1024
SPLIT_BYTES = 128 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, cores: int = 8, partition_bytes: int = PARTITION_BYTES) -> int:
    """Initial shuffle width for an input of ``input_bytes``: enough
    partitions that each holds about ``partition_bytes`` (so a reducer's
    hash table and sort buffer fit in executor memory), never fewer than the
    cores. AQE then coalesces the small ones. 100 TB gives ~400k; sf0.1
    gives the core count."""
    return max(cores, -(-int(input_bytes) // partition_bytes))


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidemark", input_bytes: int | None = None,
                  driver_memory: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the marts rely on.

    ``input_bytes`` (the size of the largest input) sizes the shuffle width
    with :func:`shuffle_partitions_for`, unless ``shuffle_partitions`` or
    ``TIDEMARK_SHUFFLE_PARTITIONS`` says otherwise. ``driver_memory`` (or
    ``TIDEMARK_DRIVER_MEMORY``) is for local runs that start their own JVM. What is not given (the
    master too) is left to the cluster's own settings.
    """
    parts = shuffle_partitions or os.environ.get("TIDEMARK_SHUFFLE_PARTITIONS")
    if parts is None and input_bytes is not None:
        parts = shuffle_partitions_for(input_bytes)
    builder = SparkSession.builder
    if master:
        builder = builder.master(master)
    memory = driver_memory or os.environ.get("TIDEMARK_DRIVER_MEMORY")
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    if parts:
        builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    builder = (
        builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", str(SPLIT_BYTES))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # split a hot key's partition even when that costs an extra shuffle
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Python call-site capture only enriches error messages but costs
        # several JVM round trips per Column call while plans are built
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # the planner's static estimate is a compressed file size: keep its
        # threshold conservative; AQE decides again from measured shuffle
        # sizes and may broadcast up to the in-memory bound
        .config("spark.sql.autoBroadcastJoinThreshold", str(PLANNER_BROADCAST_BYTES))
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", str(BROADCAST_LIMIT_BYTES))
        # AQE sizes reducers to ~128 MiB and splits partitions over 256 MiB
        # that are 5x the median (hot keys); a cluster run starts from many
        # shuffle partitions (TIDEMARK_SHUFFLE_PARTITIONS) and lets AQE coalesce.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(128 * 1024 * 1024))
        .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", str(256 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


# Spark removes an execution's shuffle files at its end where this is set; otherwise when the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """What is written within leaves no shuffle files: its rows are read from the table from then on, so a query of
    several writes holds on disk what one of them shuffles, not their sum. The setting is put back afterwards."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...)
    and is read from the session unchanged; without it a cluster run raises.
    A local scratch folder is only made for a local master, as in tests.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current
