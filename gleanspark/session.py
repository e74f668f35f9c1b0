"""Session helpers.

On a cluster the session is created by the platform; these helpers only fill in
settings that are unset, so a cluster's own configuration always wins.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job here relies on. Applied only when the key is not already set.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Small shuffles of CPU-heavy rows (HTML pages) are not merged into one task;
    # large shuffles are sized by bytes / parallelism as usual.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # broadcast only sides the planner has measured below this size
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_spark(app: str = "gleanspark", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session. ``master``/``shuffle_partitions`` are for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; only when it is unset (local tests) do we
    make our own scratch folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    master = _master(spark)
    if not d:
        if master is None or not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder on shared storage "
                               "(a machine-local folder does not survive a lost executor)")
        d = tempfile.mkdtemp(prefix="gleanspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
    except Exception:  # a remote (Connect) session reads spark.checkpoint.dir itself
        pass
    return d


def _master(spark: SparkSession) -> str | None:
    try:
        return spark.sparkContext.master
    except Exception:
        return spark.conf.get("spark.master", None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder, for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark).rstrip("/"), name)
