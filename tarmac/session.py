"""Session construction and shared-storage helpers.

Library operators never build a session themselves; they take DataFrames.
This module is for entry points (tests, bench, the driver contract) and for
the few operators that need a shared scratch location (streaming outputs,
lineage cuts), which always comes from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours should carry. AQE coalesces small shuffle
# partitions and splits skewed ones at run time; the session time zone is
# pinned so that window bounds and epoch conversions are reproducible.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(executors: int = 1000, cores_per_executor: int = 4) -> dict[str, str]:
    """Settings for a large cluster run (defaults: ~100 TB input, 1000 executors).

    * Scan splits of 256 MB: ~400k scan tasks for 100 TB, each small enough to
      decode without spilling.
    * Shuffle starts wide (4x the task slots, at least 2000) and AQE coalesces
      to ~256 MB partitions after each stage, splitting skewed ones.
    * Streaming state in RocksDB with changelog checkpointing: state size is
      bounded by disk, not heap, and each commit uploads only the changes.
    """
    slots = executors * cores_per_executor
    base = {k: v for k, v in BASE_CONF.items() if not k.startswith("spark.ui.")}
    return {
        **base,
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.shuffle.partitions": str(max(2000, 4 * slots)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.execution.sortBeforeRepartition": "true",
        "spark.speculation": "true",
    }


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tarmac", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("TARMAC_DRIVER_MEMORY", "4g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is; if it is missing there, this raises rather than fall back to
    a machine-local folder that other executors cannot see. Only a local
    master (tests, benchmarks) gets a folder of our own when it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage (HDFS, object store)")
        conf_dir = tempfile.mkdtemp(prefix="tarmac-ckpt-")
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)  # our own folder, for this process only
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return spark.sparkContext.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir.

    Every call returns a new location, so nothing ever has to be cleared
    and concurrent or repeated runs never collide.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "tarmac", *parts, uuid.uuid4().hex])
