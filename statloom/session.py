"""Spark session set-up shared by the library, the tests and the bench.

Settings that matter at scale:

* AQE re-plans joins from the real size of each shuffle stage, so a side is
  broadcast only after Spark has measured it (``autoBroadcastJoinThreshold``),
  and a sort-merge join is the fallback beyond that size.
* Skew-join splitting and partition coalescing stay on, so one hot key (one
  region or indicator holding a third of all rows) is split across tasks.
* Partition sizes come from data volume, not fixed counts: AQE coalesces
  shuffle partitions towards an advisory size, and scans split files at a
  fixed byte size, so tasks stay within executor memory at any scale.
* The checkpoint folder is read from the session (``spark.checkpoint.dir``).
  Only when it is unset and the master is local (tests) is a scratch folder
  created; on a cluster a missing setting is an error, because executors don't
  share the driver's disk.
* Checkpoint files are removed when nothing refers to them any more.

Every default below is applied only where the cluster's configuration does
not already set the key.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a side is broadcast once its shuffled size has been measured to be below this
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "statloom",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the scale settings above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    cluster = spark.sparkContext.getConf()
    for key, value in _SCALE_CONF.items():
        if not cluster.contains(key) and key not in (extra_conf or {}):
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    jsc = spark.sparkContext
    current = jsc.getCheckpointDir()
    if current:
        return current
    return jsc.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; create a scratch one only when it is unset and the master is local."""
    current = checkpoint_dir(spark)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="statloom-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for intermediate tables)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, *parts) if "://" not in base else "/".join([base.rstrip("/"), *parts])

