"""Session construction and the shared scratch location.

Production code never builds its own session; it receives one. ``local_session``
exists for tests, the bench and the command line. ``shared_dir`` returns the
cluster-wide folder named by ``spark.checkpoint.dir`` and only invents a local
one when that setting is absent (tests on one machine).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock, adaptive execution with skew
# splitting, and Arrow for the (rare) pandas boundary.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Spark 4.1.2 takes a union of tables bucketed alike for bucketed and groups it without a
    # shuffle, but reads it as separate partitions: rows of one key stay apart.
    "spark.sql.unionOutputPartitioning": "false",
    # Skip capturing the Python call site of every Column call while plans are
    # built (a driver-side cost only; error messages lose the Python origin).
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "wellspark", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (one JVM, ``cores`` threads)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or (8 if cores == "*" else cores))
    conf["spark.driver.memory"] = os.environ.get("WELLSPARK_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors, taken from ``spark.checkpoint.dir``.

    On a cluster the operator of the cluster sets it (HDFS/S3/ABFS). Only when it
    is unset -- a laptop or a test -- a fresh local folder is created and set, so
    ``DataFrame.checkpoint()`` and staged writes work the same way everywhere.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHARED:
        return _SHARED[app]
    current = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors "
                               "(HDFS, S3, ABFS, ...) when running on a cluster")
        current = tempfile.mkdtemp(prefix="wellspark-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    _SHARED[app] = current
    return current


_SHARED: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-path of the shared folder for one staged table."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/wellspark/{name}-{uuid.uuid4().hex[:12]}"


def scale_conf(shuffle_bytes_estimate: int, executor_cores_total: int,
               target_partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Settings sized for a large cluster (e.g. ~100 TB input, ~1000 executors).

    * initial shuffle partitions ~ shuffle bytes / target size, at least 3x the
      cores so every wave keeps all cores busy; AQE coalesces small ones;
    * input splits of 512 MB so a scan task reads a sizeable, but spill-free,
      slice of parquet;
    * skew handling: a partition 5x the median and above 1 GB is split.
    """
    n = max(3 * executor_cores_total, shuffle_bytes_estimate // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(512 * 1024 ** 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 ** 3),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        **{k: v for k, v in RECOMMENDED_CONF.items() if k != "spark.ui.enabled"},
    }
