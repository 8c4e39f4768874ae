"""SparkSession defaults and the shared scratch/checkpoint location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Session settings every job relies on: UTC so month keys never shift, ANSI so
# bad casts fail loudly (we use try_* where NULL is the intended answer), AQE so
# join strategy, skew splitting and partition coalescing are decided at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_session(master: str | None = None, app: str = "finlake",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine defaults.

    ``master`` is only set for local runs; on a cluster the launcher decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master).config("spark.ui.enabled", "false")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Apply the runtime-settable defaults to an existing session."""
    for k, v in DEFAULT_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on an already running context
            pass


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints, stream state and lineage cuts.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared file system
    there). Only when it is unset – local tests – do we create one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir() or None
        except Exception:  # Spark Connect: no SparkContext
            root = None
    if not root:  # local runs and tests only
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", None) or ""):
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="finlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:
            pass
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/finlake/{name}-{uuid.uuid4().hex[:12]}"


def absent(e: AnalysisException) -> bool:
    """Whether a read failed because there is no such path, or no data file under it."""
    return (e.getCondition() or "") in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def local_path(path: str) -> str | None:
    """Return a local filesystem path for ``file:`` or plain paths, else None."""
    if path.startswith("file:"):
        return path[len("file:"):].replace("///", "/", 1) if path.startswith("file:///") else path[5:]
    if "://" in path:
        return None
    return os.path.abspath(path)


SCAN_TASKS = 100_000        # file splits grow beyond this many scan tasks
SHUFFLE_TASKS = 20_000


def scale_conf(input_bytes: int, cores: int, partition_mb: int = 256,
               broadcast_mb: int = 64, shuffle_share: float = 0.05) -> dict[str, str]:
    """Session settings sized for a job that reads ``input_bytes`` on ``cores`` task slots.

    * file splits of ``partition_mb``, larger where that gave more than
      ``SCAN_TASKS`` tasks;
    * a shuffle width for what is left after the partial aggregates
      (``shuffle_share`` of the input), at least 3 tasks per core and at most
      ``SHUFFLE_TASKS`` unless the cores ask for more: the blocks of a shuffle
      are scan tasks times this width. AQE coalesces small partitions;
    * skew handling: a shuffle partition 5x the median and over 1 GB is split
      (joins, and the REBALANCE before partitioned writes);
    * broadcast only under ``broadcast_mb`` of measured size.

    For 100 TB on 1,000 executors x 8 cores this gives 1 GB scan splits
    (100,000 scan tasks), 24,000 shuffle partitions of about 220 MB and
    2.4 billion shuffle blocks.
    """
    split_mb = max(partition_mb, -(-input_bytes // (SCAN_TASKS << 20)))
    shuffled = int(input_bytes * shuffle_share)
    width = max(3 * cores, min(SHUFFLE_TASKS, -(-shuffled // (partition_mb << 20))))
    return {
        "spark.sql.files.maxPartitionBytes": f"{split_mb}m",
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{partition_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": f"{broadcast_mb}m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": f"{broadcast_mb}m",
        "spark.sql.files.maxRecordsPerFile": "20000000",
    }
