"""Session construction and the shared scratch folder.

Scratch output (stream sinks, one-file writers, lineage cuts) always goes
under the folder named by ``spark.checkpoint.dir``.  On a cluster that
setting points at shared storage; we only fill it in when it is unset
(local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def cluster_conf(shuffle_bytes: int = 10 * 2**40, target_partition_bytes: int = 256 * 2**20) -> dict:
    """Settings for a large cluster (~1000 executors, ~100 TB input).

    Shuffles start with enough partitions for ~256 MB each at the expected
    shuffle volume (default 10 TB: pruned columns and map-side partial
    aggregation shrink a 100 TB scan's shuffles by about 10x); AQE coalesces the small ones and splits skewed join
    partitions (a key may hold a third of all rows).  Broadcasts stay small:
    static broadcast threshold 64 MB, the same at run time.
    """
    parts = max(200, min(100_000, shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 2**20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 2**20),
        "spark.sql.files.maxPartitionBytes": str(256 * 2**20),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.speculation": "true",
        "spark.task.maxFailures": "8",
    }


def get_spark(master: str | None = None, app: str = "corvid",
              shuffle_partitions: int | None = None, cluster: bool = False) -> SparkSession:
    """Build (or reuse) a session with AQE and skew handling switched on.

    ``cluster=True`` adds :func:`cluster_conf` (100 TB settings)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("CORVID_DRIVER_MEMORY", "16g"),
    }
    if cluster:
        conf.update(cluster_conf())
        conf.pop("spark.driver.memory")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only if unset."""
    d = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(_CHECKPOINT_KEY, None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="corvid-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, d)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/corvid/{name}-{uuid.uuid4().hex}"
