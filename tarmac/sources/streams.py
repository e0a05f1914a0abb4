"""Stream sources (SRC3, SRC4) and ordered event-file staging.

Kafka is the production transport; its connector is not bundled here, so
:func:`topic_options` only assembles reader options. The file source is the
tested twin: ``maxFilesPerTrigger`` plays the role of ``maxOffsetsPerTrigger``.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.streaming.runner import state_slots


def topic_options(servers: str, topic: str, start: str = "latest", max_offsets: int | None = None,
                  fail_on_data_loss: bool | None = None) -> dict[str, str]:
    """Reader options for a topic stream."""
    if start not in ("latest", "earliest") and not start.startswith("{"):
        raise ValueError("start must be 'latest', 'earliest' or a JSON offset spec")
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if max_offsets is not None:
        if max_offsets <= 0:
            raise ValueError("max_offsets must be positive")
        opts["maxOffsetsPerTrigger"] = str(max_offsets)
    if fail_on_data_loss is not None:
        opts["failOnDataLoss"] = str(fail_on_data_loss).lower()
    return opts


def topic_sink_options(servers: str, topic: str) -> dict[str, str]:
    """Writer options for a topic sink (``run_stream(fmt="kafka", options=...)``;
    the frame must carry a ``value`` column, e.g. from ``to_stat_json``)."""
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Streaming read of a topic (needs the Kafka connector on the classpath)."""
    try:
        return spark.readStream.format("kafka").options(**options).load()
    except Exception as e:  # noqa: BLE001
        if "kafka" in str(e).lower() and "data source" in str(e).lower():
            raise RuntimeError("the Kafka connector is not on the classpath; add the "
                               "spark-sql-kafka-0-10 package matching this Spark version") from e
        raise


def stream_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                 max_files: int | None = 1, **options) -> DataFrame:
    """Streaming read of files arriving under ``path``.

    ``max_files`` bounds each micro-batch (files are taken oldest first, by
    modification time). A schema is mandatory: streams never infer.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        reader = reader.option("header", options.pop("header", True))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def stage_event_files(df: DataFrame, path: str, ts: str, files: int, fmt: str = "parquet") -> str:
    """Write ``df`` as ``files`` files, range-partitioned and sorted by ``ts``,
    with modification times pinned in time order.

    A file-source stream with ``maxFilesPerTrigger=1`` then replays the table
    in event-time order, one slice per micro-batch. Rows are ranged on
    ``(ts, row hash)``, so even a single timestamp holding a large share of the
    rows is spread over several files instead of one. The write is one
    parallel job; only file times are set from the driver, and checked.
    """
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    (df.repartitionByRange(files, F.col(ts), tie).sortWithinPartitions(ts)
       .write.mode("overwrite").format(fmt).save(path))
    pin_file_order(df.sparkSession, path)
    return path


#: Rows of a staged file at most, on average: a task of the replay reads one file, copies its rows into their windows and
#: groups them in memory, however small the file is on disk.
ROWS_PER_FILE = 100_000


def stage_event_batches(df: DataFrame, path: str, ts: str, batches: int, fmt: str = "parquet",
                        bytes_per_file: int = 1 << 30, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Stage ``df`` for a replay in at least ``batches`` event-time-ordered micro-batches.

    The number of files follows the input's rows, and its size in bytes as the optimiser knows it
    (at least one per batch). A micro-batch has no more files by rows than the cluster has task slots, so
    that a task reads one of them and a state partition gets as many rows as one holds; a larger input is
    replayed in more micro-batches. Returns the files per micro-batch, to be used as
    ``maxFilesPerTrigger``.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    rows = df.count()
    by_rows = min(-(-rows // (rows_per_file * batches)), state_slots(df.sparkSession))
    per_batch = max(1, -(-size // (bytes_per_file * batches)), by_rows)
    stage_event_files(df, path, ts, per_batch * max(batches, -(-rows // (rows_per_file * per_batch))), fmt)
    return per_batch


def pin_file_order(spark: SparkSession, path: str, base_ms: int = 1_000_000_000_000, step_ms: int = 1000) -> None:
    """Set modification times of the data files under ``path`` in name order.

    A store may ignore the request (Hadoop's base file system does); the times are
    listed again, and an order that did not hold raises instead of letting a replay
    deliver rows late. Times are set over several connections at once.
    """
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def listed() -> list[tuple[str, int]]:
        return sorted((st.getPath().toString(), st.getModificationTime()) for st in fs.listStatus(hpath)
                      if st.isFile() and not st.getPath().getName().startswith(("_", ".")))

    wanted = [(name, base_ms + i * step_ms) for i, (name, _) in enumerate(listed())]
    with ThreadPool(16) as pool:
        pool.map(lambda f: fs.setTimes(jvm.org.apache.hadoop.fs.Path(f[0]), f[1], -1), wanted)
    check_file_order(wanted, listed())


def check_file_order(wanted: list[tuple[str, int]], found: list[tuple[str, int]]) -> None:
    """Raise unless the files' modification times rise in the wanted order."""
    times = dict(found)
    order = [times.get(name) for name, _ in wanted]
    if None in order or any(a >= b for a, b in zip(order, order[1:])):
        raise RuntimeError("the file system does not keep modification times; a file replay in event-time order "
                           "needs one that does")
