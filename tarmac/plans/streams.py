"""Streaming queries on ``events`` replayed through the file source.

Each query stages ``events`` as time-ordered files in a fresh folder under the
shared checkpoint dir, runs the stream with ``availableNow`` and a bounded number of files per
micro-batch, and returns the sink's content read back. The SQL twins state
what the stream must produce: in append mode, every window closed by the
final watermark (``end <= max(ts) - 3 minutes``); in update mode collapsed by
key, every window.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.scalar import instant_to_ntz, ntz_to_instant
from tarmac.operators.dedupe import dedupe, dedupe_within_watermark
from tarmac.operators.windows import flatten_window, quality_rows, window_quality, window_stats
from tarmac.plans.registry import register
from tarmac.plans.tables import events
from tarmac.plans.windows import QUALITY, TUMBLING, VALUE_DECIMALS, _stats_sql, quality_input, quality_sql
from tarmac.schema import KEYED_STATISTICS_SCHEMA, WINDOW_QUALITY_SCHEMA
from tarmac.session import scratch_path
from tarmac.sinks.payload import from_stat_json, to_stat_json
from tarmac.sinks.writers import batch_writer, fold_upserts, read_upserted, reset_table, upsert_writer
from tarmac.sources.events import arrival_times, decode_events, encode_events
from tarmac.sources.results import read_results, result_tasks
from tarmac.sources.streams import stage_event_batches, stream_table
from tarmac.streaming.runner import run_stream, run_to_completion, state_slots, with_event_time

EVENT_BATCHES = 5
WATERMARK = "3 minutes"
QUALITY_KEYS = ["window_start", "window_end", "airport_name"]
UPSERT_KEYS = ["window_start", "group_value"]

QUALITY_RESULT_SCHEMA = WINDOW_QUALITY_SCHEMA
CLOSED = "WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 3 MINUTE"
CLOSED_QUALITY_SQL = quality_sql(QUALITY, CLOSED)


def stage_events(spark, sf_dir, tag: str, batches: int = EVENT_BATCHES):
    """Fresh folder with ``events`` as time-ordered files for at least ``batches``
    micro-batches; returns (root, input path, schema, files per micro-batch)."""
    root = scratch_path(spark, tag)
    src = events(spark, sf_dir)
    per_batch = stage_event_batches(src, f"{root}/input", "ts", batches)
    return root, f"{root}/input", src.schema, per_batch


def _ntz(df, *cols):
    return df.withColumns({c: instant_to_ntz(c) for c in cols})


def run_quality_stream(spark, sf_dir, staged=None, checkpoint=None, output=None, method="auto"):
    root, src, schema, per_batch = staged or stage_events(spark, sf_dir, "quality-stream")
    stream = stream_table(spark, src, schema, max_files=per_batch)
    scored = quality_input(stream).withColumn("ts", ntz_to_instant("ts"))
    q = window_quality(scored, QUALITY, "place", "label", "pred", ts="ts", lat="lat", lon="lon",
                       watermark=WATERMARK, method=method)
    output = output or f"{root}/output"
    run_to_completion(quality_rows(q), checkpoint or f"{root}/checkpoint-quality",
                      writer=batch_writer(output, fmt="csv"), mode="append",
                      state_partitions=state_slots(spark))
    return root, output


@register("stream_window_quality",
          ("STR4", "STR5", "STR7", "STR8", "STR9", "SNK2", "SNK3", "SRC4", "SRC6", "SET2", "SET3", "PRJ14"),
          sql=CLOSED_QUALITY_SQL)
def stream_window_quality(spark, sf_dir):
    _, output = run_quality_stream(spark, sf_dir)
    results = read_results(spark, output, QUALITY_RESULT_SCHEMA, key_as_string="airport_name")
    return _ntz(dedupe(results, QUALITY_KEYS, tasks=result_tasks(spark, output)), "window_start", "window_end")


@register("stream_sliding_panes", ("STR2", "AGG11", "STR5"), sql=CLOSED_QUALITY_SQL)
def stream_sliding_panes(spark, sf_dir):
    """The same windows by two chained stateful aggregates: panes, then the windows that hold them."""
    _, output = run_quality_stream(spark, sf_dir, method="panes")
    results = read_results(spark, output, QUALITY_RESULT_SCHEMA, key_as_string="airport_name")
    return _ntz(results, "window_start", "window_end")


@register("stream_deduplicated", ("SET3", "STR4"), sql=CLOSED_QUALITY_SQL)
def stream_deduplicated(spark, sf_dir):
    """Every event is delivered twice, the second time two minutes later and often in
    another micro-batch; the copies go in the stream, before the windows."""
    root = scratch_path(spark, "twice")
    ev = events(spark, sf_dir)
    again = ev.withColumn("arrived", F.col("ts") + F.expr("INTERVAL 2 MINUTES"))
    twice = ev.withColumn("arrived", F.col("ts")).unionByName(again)
    per_batch = stage_event_batches(twice, f"{root}/input", "arrived", EVENT_BATCHES)
    stream = stream_table(spark, f"{root}/input", twice.schema, max_files=per_batch)
    timed = stream.withColumn("ts", ntz_to_instant("ts"))
    once = dedupe_within_watermark(timed, ["event_id"], "ts", WATERMARK)
    # The watermark is set where copies go and holds for the windows too.
    q = window_quality(quality_input(once), QUALITY, "place", "label", "pred", ts="ts", lat="lat", lon="lon", watermark=None)
    run_to_completion(quality_rows(q), f"{root}/checkpoint", writer=batch_writer(f"{root}/output"), mode="append",
                      state_partitions=state_slots(spark))
    results = read_results(spark, f"{root}/output", QUALITY_RESULT_SCHEMA, key_as_string="airport_name")
    return _ntz(results, "window_start", "window_end")


def run_stats_stream(spark, sf_dir, staged=None, checkpoint=None, table=None, reset=True):
    root, src, schema, per_batch = staged or stage_events(spark, sf_dir, "stats-stream")
    stream = stream_table(spark, src, schema, max_files=per_batch)
    timed = with_event_time(stream.select("ts", "event_type", "value"), "ts", WATERMARK)
    stats = window_stats(timed, TUMBLING, "event_type", "value", ts="ts", mean_decimals=VALUE_DECIMALS)
    table = table or f"{root}/table"
    writer = upsert_writer(table, UPSERT_KEYS, transform=from_stat_json, spark=spark,
                           reset_schema=KEYED_STATISTICS_SCHEMA if reset else None)
    run_to_completion(to_stat_json(stats, "event_type"), checkpoint or f"{root}/checkpoint-stats",
                      writer=writer, mode="update", state_partitions=state_slots(spark))
    return root, table


def _keyed_sql() -> str:
    return f"""
SELECT window_start, window_end, event_type AS group_value,
       min_value, max_value, avg_value, std_value, count
FROM ({_stats_sql(TUMBLING)})"""


@register("stream_stats_upsert", ("STR6", "STR10", "SNK1", "SNK4", "SNK5", "STR3"), sql=_keyed_sql())
def stream_stats_upsert(spark, sf_dir):
    _, table = run_stats_stream(spark, sf_dir)
    out = read_upserted(spark, table, UPSERT_KEYS, KEYED_STATISTICS_SCHEMA)
    return _ntz(out, "window_start", "window_end")


@register("stream_upsert_rerun", ("SNK4", "STR7"), sql=f"""
SELECT window_start, window_end, event_type AS group_value, min_value, max_value, avg_value, std_value, count
FROM ({_stats_sql(TUMBLING).replace('SELECT ts, event_type, value FROM events',
                                    'SELECT ts, event_type, value * 2 AS value FROM events')})""")
def stream_upsert_rerun(spark, sf_dir):
    """Two runs into one keyed table, the second on a fresh checkpoint with doubled
    values and a processing-time trigger. The table, partitioned by window day, is folded after
    each of them, and the last run must win whatever its batch numbers."""
    root, src, schema, per_batch = stage_events(spark, sf_dir, "upsert-rerun")
    table = f"{root}/table"
    reset_table(spark, table, KEYED_STATISTICS_SCHEMA, day_of="window_start")
    for run, factor in ((1, 1), (2, 2)):
        stream = stream_table(spark, src, schema, max_files=per_batch)
        rows = stream.select("ts", "event_type", (F.col("value") * factor).alias("value"))
        stats = window_stats(with_event_time(rows, "ts", WATERMARK), TUMBLING, "event_type", "value", ts="ts",
                             mean_decimals=VALUE_DECIMALS)
        q = run_stream(to_stat_json(stats, "event_type"), f"{root}/checkpoint-{run}", mode="update",
                       trigger="availableNow" if run == 1 else "1 second", state_partitions=state_slots(spark),
                       writer=upsert_writer(table, UPSERT_KEYS, transform=from_stat_json, day_of="window_start"))
        if run == 1:
            q.awaitTermination()
        else:
            q.processAllAvailable()
            q.stop()
        fold_upserts(spark, table, UPSERT_KEYS, KEYED_STATISTICS_SCHEMA, "window_start")
    return _ntz(read_upserted(spark, table, UPSERT_KEYS, KEYED_STATISTICS_SCHEMA), "window_start", "window_end")


@register("stream_late_resumed", ("STR4", "STR8"), sql="""
WITH half AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS mid, max(ts) - INTERVAL 3 MINUTE AS mark FROM events),
w AS (
  SELECT time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS window_start, ts, event_type, value FROM events)
SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, event_type, count(value) AS count
FROM w, half
WHERE window_start + INTERVAL '1 hour' <= mark AND ts >= mid
GROUP BY 1, 2, 3
""")
def stream_late_resumed(spark, sf_dir):
    """The later half of the events first; then, resumed on the same checkpoint, the
    earlier half, which is late by more than the watermark allows and is dropped. A window
    that the halves share lost its early rows too, since it closed in the first run."""
    root = scratch_path(spark, "late-stream")
    ev = events(spark, sf_dir)
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    mid = F.lit(str(lo + (hi - lo) / 2)).cast("timestamp_ntz")
    for half in (F.col("ts") >= mid, F.col("ts") < mid):
        ev.where(half).write.mode("append").parquet(f"{root}/input")
        stream = stream_table(spark, f"{root}/input", ev.schema, max_files=None)
        timed = with_event_time(stream.select("ts", "event_type", "value"), "ts", WATERMARK)
        counts = window_stats(timed, TUMBLING, "event_type", "value", ts="ts")
        rows = flatten_window(counts).select("window_start", "window_end", "event_type", "count")
        run_to_completion(rows, f"{root}/checkpoint", writer=batch_writer(f"{root}/output", fmt="parquet"),
                          mode="append", state_partitions=state_slots(spark))
    schema = T.StructType([T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType()),
                           T.StructField("event_type", T.StringType()), T.StructField("count", T.LongType())])
    return _ntz(read_results(spark, f"{root}/output", schema, fmt="parquet"), "window_start", "window_end")


@register("replayed_windows", ("SRC5", "PRJ16", "PRJ2", "STR1"), sql="""
SELECT window_start, event_type, count(*) AS count, min(event_id) AS first_id, max(event_id) AS last_id
FROM (SELECT event_type, event_id, time_bucket(INTERVAL '10 minutes',
        TIMESTAMP '2024-01-01' + to_seconds(floor((row_number() OVER (ORDER BY event_id) - 1) * 0.5)::BIGINT),
        TIMESTAMP '1970-01-01') AS window_start FROM events)
GROUP BY 1, 2
""")
def replayed_windows(spark, sf_dir):
    """Events produced half a second apart, decoded, and counted in ten-minute windows."""
    wire = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()),
                         T.StructField("timestamp", T.TimestampType())])
    rows = events(spark, sf_dir).select("event_id", "event_type")
    stamped = arrival_times(rows, 1_704_067_200, 0.5, order_by=["event_id"])
    encoded = encode_events(stamped, wire, ts_col=F.timestamp_seconds("timestamp"))
    decoded = decode_events(encoded, wire)
    out = decoded.groupBy(F.window("timestamp", "10 minutes").alias("window"), "event_type").agg(
        F.count("*").alias("count"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))
    return _ntz(out.select(F.col("window.start").alias("window_start"), "event_type", "count", "first_id", "last_id"),
                "window_start")
