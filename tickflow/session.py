"""Session construction and the shared scratch/checkpoint folder.

Everything that must survive an executor loss (lineage cuts, replay
inputs, stream checkpoints, job outputs) goes under the folder the
cluster names in ``spark.checkpoint.dir``. Only when that setting is
missing (local runs, tests) do we create one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Starting point for a large cluster (~1000 executors, ~100 TB of ticks):
# many initial shuffle partitions that AQE coalesces to ~256 MB each,
# 512 MB scan splits, skew splitting for hot symbols, a broadcast bound
# well above the small derived tables (bucket maps, registries).
CLUSTER = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # large state: commit a changelog per batch instead of a full snapshot
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


_SCRATCH: list[str] = []


def build_session(app: str = "tickflow", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None, cluster: bool = False) -> SparkSession:
    """Session with UTC time, AQE and no UI. ANSI mode is left on.
    ``cluster=True`` adds the ``CLUSTER`` sizing."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULTS)
    if cluster:
        conf.update(CLUSTER)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder, as the URI Spark knows it by.

    Only a local session may set a folder of its own; on a cluster a
    machine-local folder would be written piecemeal by each executor, so
    a missing setting is an error there.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
        if not conf_dir:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            conf_dir = tempfile.mkdtemp(prefix="tickflow-ckpt-")
        sc.setCheckpointDir(conf_dir)
        d = sc.getCheckpointDir()
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared checkpoint folder."""
    path = os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders that this process has made so far; returns how many there were.

    For the caller to use once results are written elsewhere: tables that
    are read back from a scratch folder are gone after it.
    """
    gone = 0
    while _SCRATCH:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        gone += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return gone
