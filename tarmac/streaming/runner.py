"""Running streaming queries (STR4-STR9).

A query always has a checkpoint: offsets, state and the sink's commit log
live there, so a restart after a failure resumes where it stopped instead of
replaying from the start.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tarmac.functions.scalar import event_time_of
from tarmac.roles import duration_seconds

MODES = ("append", "update", "complete")


def with_event_time(df: DataFrame, ts: str, watermark: str | None) -> DataFrame:
    """Event time as ``timestamp`` (watermarks reject ``timestamp_ntz``; a
    wall-clock value is read as UTC), plus an optional watermark bounding
    lateness and state."""
    out = df.withColumn(ts, event_time_of(df, ts))
    if watermark:
        duration_seconds(watermark)  # validate early
        out = out.withWatermark(ts, watermark)
    return out


def run_stream(df: DataFrame, checkpoint: str, writer: Callable[[DataFrame, int], None] | None = None,
               mode: str = "append", trigger: str = "availableNow", fmt: str | None = None,
               path: str | None = None, options: dict | None = None, name: str | None = None,
               state_partitions: int | None = None, state_conf: dict[str, str] | None = None) -> StreamingQuery:
    """Start ``df`` towards a ``foreachBatch`` ``writer`` or a ``fmt`` sink.

    ``trigger``: ``"availableNow"`` (process what is there, then stop),
    ``"once"``, or a processing-time interval such as ``"5 seconds"``.
    ``state_partitions`` fixes the number of state-store partitions of a new
    query (every micro-batch commits each of them, so it should follow the
    cluster's task slots rather than a batch-job shuffle width; a restarted
    query keeps the number recorded in its checkpoint). ``state_conf`` holds further settings of
    the state store for this query, such as ``streaming.state.ROCKSDB``.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if not checkpoint:
        raise ValueError("a checkpoint location is required")
    if (writer is None) == (fmt is None):
        raise ValueError("give exactly one of writer= or fmt=")
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    elif trigger == "once":
        w = w.trigger(once=True)
    else:
        duration_seconds(trigger)
        w = w.trigger(processingTime=trigger)
    if writer is not None:
        w = w.foreachBatch(writer)
    else:
        w = w.format(fmt)
        for k, v in (options or {}).items():
            w = w.option(k, v)
        if path:
            w = w.option("path", path)
    settings = dict(state_conf or {})
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(int(state_partitions))
    # The query clones the session when it starts, so the settings apply to
    # this query only and the caller's session is restored right away.
    conf = df.sparkSession.conf
    before = {k: conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            conf.set(k, v)
        return w.start()
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def run_to_completion(df: DataFrame, checkpoint: str, timeout_s: int | None = None, **kwargs) -> StreamingQuery:
    """Run with ``availableNow`` and wait until every available input is processed."""
    kwargs.setdefault("trigger", "availableNow")
    q = run_stream(df, checkpoint, **kwargs)
    q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream did not finish within {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    return q


def run_batches(df: DataFrame, checkpoint: str, batches: int, trigger: str = "1 second", timeout_s: int = 3600,
                **kwargs) -> StreamingQuery:
    """Run a stream without an end, such as a paced one, until ``batches`` micro-batches are done, then stop it.

    Batches are counted over the life of the checkpoint. One more may have begun, so the source must have nothing
    to add by then or the caller must not mind.
    """
    q = run_stream(df, checkpoint, trigger=trigger, **kwargs)
    end = time.monotonic() + timeout_s
    try:
        while q.isActive and (q.lastProgress is None or q.lastProgress["batchId"] < batches - 1):
            if time.monotonic() > end:
                raise TimeoutError(f"{batches} micro-batches took over {timeout_s}s")
            time.sleep(0.1)
    finally:
        q.stop()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    return q


def state_slots(spark) -> int:
    """State-store partitions matching the cluster's task slots."""
    try:
        return max(1, spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - no context view (remote session)
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
