"""Spark session construction and shared scratch locations.

Everything that must survive an executor loss (staged inputs, written results,
stream checkpoints made by the query helpers) goes under the cluster's shared
checkpoint folder (``spark.checkpoint.dir``).  A local folder is set only when the
session has none, which is the case in tests and on a laptop.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for a batch/streaming session.  The session time zone is pinned to UTC
# because the data is epoch milliseconds in UTC; the operators themselves are written
# zone-free, so a session in another zone gives the same results.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Target ~128 MiB per post-shuffle partition; AQE merges the small ones.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_spark(app: str = "eventflow", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with :data:`DEFAULT_CONF` applied; ``conf`` overrides it,
    e.g. ``build_spark(**{"spark.sql.shuffle.partitions": "8"})``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder (``spark.checkpoint.dir``).

    Only a ``local`` master (tests, a laptop) gets a temporary folder when none is
    configured; on a cluster a machine-local folder would not survive the loss of
    the executor that wrote it, so an unset folder is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        # "local-cluster[...]" is a cluster: its executors have folders of their own
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (e.g. on HDFS or S3)")
        configured = tempfile.mkdtemp(prefix="eventflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _scratch_root(spark: SparkSession) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/eventflow/{spark.sparkContext.applicationId}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch folders.  For the end of a job: results that
    are still to be read from them are lost."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
