"""Session helpers: the shared output folder and recommended settings."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def _local_only(master: str) -> bool:
    """Whether driver and executors are one process, so that a local folder is shared."""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate tables.

    Read from ``spark.checkpoint.dir`` (the folder the cluster names for
    checkpoints, reachable by every executor). Only a session on a local master
    gets a fresh local folder when it is unset, as in tests; on a cluster each
    executor would write to its own disk, so that raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a session without a SparkContext (e.g. Spark Connect)
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _local_only(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="loglens-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def session_key(spark: SparkSession) -> str:
    """An identifier of the running application."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under :func:`shared_dir` for one written table."""
    return os.path.join(shared_dir(spark), "loglens", f"{name}-{uuid.uuid4().hex}")


# Settings for a production run. AQE coalesces small shuffle partitions and
# splits skewed ones at run time; the rest keep the plans JVM-side.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Spark broadcasts the k winners of a top-k report, but computing them
    # includes the ranking stage over every user or session, which at 100 TB can
    # run longer than the default 300 s broadcast timeout
    "spark.sql.broadcastTimeout": "3600",
    # tables partitioned by date are written without sorting a task's rows first
    "spark.sql.maxConcurrentOutputFileWriters": "64",
}


MiB = 1024 * 1024


def cluster_conf(
    input_bytes: int,
    scan_split_bytes: int = 256 * MiB,
    shuffle_fraction: float = 0.05,
    shuffle_partition_bytes: int = 128 * MiB,
) -> dict[str, str]:
    """Partition sizing for an input of ``input_bytes`` (e.g. 100 TB of logs).

    * Scan splits of ``scan_split_bytes`` keep each task's input well inside
      executor memory (100 TB -> ~400k scan tasks).
    * The analyses shuffle partial aggregates; only the high-cardinality keys
      (user, session, IP) shuffle a noticeable share of the input, taken here
      as ``shuffle_fraction``. The initial shuffle partition count gives each
      reducer about ``shuffle_partition_bytes`` of that; AQE then coalesces
      small partitions to the advisory size and splits skewed ones, so the
      low-cardinality analyses end up with a handful of reducers.
    """
    shuffle_bytes = max(1, int(input_bytes * shuffle_fraction))
    partitions = max(200, math.ceil(shuffle_bytes / shuffle_partition_bytes))
    return {
        **RECOMMENDED_CONF,
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_partition_bytes),
        # coalesce by size, not to keep every core busy on tiny partitions
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply :data:`RECOMMENDED_CONF`, or :func:`cluster_conf` for a known input size."""
    conf = cluster_conf(input_bytes) if input_bytes else RECOMMENDED_CONF
    for key, value in conf.items():
        spark.conf.set(key, value)
    return spark
