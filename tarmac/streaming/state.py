"""Reading a finished query's state (STR4, STR10).

The state of a windowed aggregate is what has not been emitted yet. Spark's ``statestore``
source reads it from the checkpoint as a table, so that its bound can be checked: after the last
micro-batch only windows that the watermark has not closed are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: State on disk with changelog checkpoints, for state that outgrows the heap.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a checkpoint: operatorId, operatorName, numPartitions, the batches kept."""
    return spark.read.format("state-metadata").load(checkpoint)


def read_state(spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None) -> DataFrame:
    """The state (key, value, partition_id) of one operator after ``batch``, by default the last one."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint)


def open_windows(spark: SparkSession, checkpoint: str, key: str, scale: int = 2, operator: int = 0) -> DataFrame:
    """The windows of a ``window_stats`` query (with ``mean_decimals``) that are still open, as it would emit them now."""
    v = F.col("value")
    return read_state(spark, checkpoint, operator).select(
        "key.window", F.col(f"key.{key}").alias(key),
        F.round(v["min"], scale).alias("min_value"), F.round(v["max"], scale).alias("max_value"),
        F.round(F.try_divide(v["sum"].cast("double"), v["count"].cast("double")), scale).alias("avg_value"),
        F.round(F.when(v["n"] > 1, F.sqrt(v["m2"] / (v["n"] - 1))), scale).alias("std_value"),
        v["count"].alias("count"))
