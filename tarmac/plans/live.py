"""Queries on chained, paced and inspected streams, and on results of differing headers."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.scalar import ntz_to_instant
from tarmac.ml.model import score
from tarmac.ml.sampling import SPLIT_SEED, hash_split
from tarmac.operators.profile import audit_columns, stage_observed
from tarmac.operators.windows import flatten_window, quality_rows, window_quality, window_stats
from tarmac.plans.registry import register, sql_unit
from tarmac.plans.streams import (CLOSED, EVENT_BATCHES, QUALITY_RESULT_SCHEMA, UPSERT_KEYS, WATERMARK, _keyed_sql, _ntz,
                                  stage_events)
from tarmac.plans.tables import events, is_error
from tarmac.plans.windows import QUALITY, TUMBLING, VALUE_DECIMALS, _stats_sql, quality_input, quality_sql
from tarmac.roles import WindowSpec
from tarmac.schema import KEYED_STATISTICS_SCHEMA
from tarmac.session import scratch_path
from tarmac.sinks.payload import from_stat_json, to_stat_json
from tarmac.sinks.writers import batch_writer, read_upserted, upsert_writer
from tarmac.sources.events import number_rows, paced_rows, send_time
from tarmac.sources.results import read_results
from tarmac.sources.streams import stream_table
from tarmac.streaming.runner import run_batches, run_to_completion, state_slots, with_event_time
from tarmac.streaming.state import ROCKSDB, open_windows


@register("results_by_name", ("SRC6", "SET2", "PRJ14"), sql="""
SELECT time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS window_start, event_type, count(*) AS count,
       CASE WHEN event_type <> 'view' THEN max(value) END AS max_value
FROM events GROUP BY window_start, event_type
""")
def results_by_name(spark, sf_dir):
    """Results written by three runs: columns in one order, in another, and without one of them."""
    root = scratch_path(spark, "by-name")
    hours = events(spark, sf_dir).groupBy(F.window(ntz_to_instant("ts"), "1 hour").alias("window"), "event_type").agg(
        F.count("*").alias("count"), F.max("value").alias("max_value"))
    rows = hours.select(F.col("window.start").alias("window_start"), "event_type", "count", "max_value")
    of = F.col("event_type")
    runs = [(of == "view", ["event_type", "window_start", "count"]),
            (of == "error", ["max_value", "count", "event_type", "window_start"]),
            (~of.isin("view", "error"), ["window_start", "event_type", "count", "max_value"])]
    for i, (some, columns) in enumerate(runs):
        batch_writer(f"{root}/run_{i}")(rows.where(some).select(*columns), 0)
    return _ntz(read_results(spark, root, rows.schema), "window_start")


@register("results_or_nothing", ("SRC7", "SNK3"), sql="""
SELECT event_id, event_type, value FROM events WHERE event_type = 'error'
""")
def results_or_nothing(spark, sf_dir):
    """Two streams' results, one of which wrote nothing at all: its rows are none, of the same schema."""
    root, src, schema, per_batch = stage_events(spark, sf_dir, "or-nothing")
    parts = []
    for name, kept in (("errors", is_error()), ("none", F.col("event_type") == "no such type")):
        stream = stream_table(spark, src, schema, max_files=per_batch).where(kept).select("event_id", "event_type", "value")
        run_to_completion(stream, f"{root}/checkpoint-{name}", writer=batch_writer(f"{root}/{name}"))
        parts.append(read_results(spark, f"{root}/{name}", stream.schema))
    return parts[0].unionByName(parts[1])


@register("paced_windows", ("SRC5", "PRJ16", "STR6", "STR7", "SNK4"), sql="""
SELECT window_start, event_type, count(*) AS count, min(event_id) AS first_id, max(event_id) AS last_id
FROM (SELECT event_type, event_id, time_bucket(INTERVAL '10 minutes',
        TIMESTAMP '2024-01-01' + to_seconds(floor((row_number() OVER (ORDER BY event_id) - 1) * 0.5)::BIGINT),
        TIMESTAMP '1970-01-01') AS window_start FROM events)
GROUP BY 1, 2
""")
def paced_windows(spark, sf_dir):
    """A live replay, a fifth of the events a second, of which every event carries the time it was sent at;
    counted in ten-minute windows and kept in a keyed table."""
    root = scratch_path(spark, "paced")
    number_rows(events(spark, sf_dir).select("event_id", "event_type"), ["event_id"]).write.parquet(f"{root}/numbered")
    numbered = spark.read.parquet(f"{root}/numbered")
    n = numbered.count()
    live = paced_rows(numbered, max(1, -(-n // EVENT_BATCHES))).select(
        "event_id", "event_type", F.timestamp_seconds(send_time("row", 1_704_067_200, 0.5)).alias("sent"))
    counts = live.withWatermark("sent", WATERMARK).groupBy(F.window("sent", "10 minutes").alias("window"), "event_type").agg(
        F.count("*").alias("count"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))
    rows = counts.select(F.col("window.start").alias("window_start"), "event_type", "count", "first_id", "last_id")
    keys = ["window_start", "event_type"]
    run_batches(rows, f"{root}/checkpoint", EVENT_BATCHES, trigger="1 second", mode="update", state_partitions=state_slots(spark),
                writer=upsert_writer(f"{root}/table", keys, day_of="window_start"))
    return _ntz(read_upserted(spark, f"{root}/table", keys, rows.schema), "window_start")


def _closed_stats(sql: str) -> str:
    return f"SELECT * FROM ({sql}) {CLOSED}"


@register("chained_payloads", ("SNK1", "SNK4", "STR5", "STR9"), sql=_closed_stats(_keyed_sql()))
def chained_payloads(spark, sf_dir):
    """Two streams joined by files: the first writes closed windows as JSON payloads (a file sink, whose log says
    which files count), the second reads them and keeps the keyed table."""
    root, src, schema, per_batch = stage_events(spark, sf_dir, "chained")
    timed = with_event_time(stream_table(spark, src, schema, max_files=per_batch).select("ts", "event_type", "value"),
                            "ts", WATERMARK)
    stats = window_stats(timed, TUMBLING, "event_type", "value", ts="ts", mean_decimals=VALUE_DECIMALS)
    run_to_completion(to_stat_json(stats, "event_type"), f"{root}/checkpoint-1", fmt="text", path=f"{root}/payloads",
                      mode="append", state_partitions=state_slots(spark))
    payloads = stream_table(spark, f"{root}/payloads", T.StructType([T.StructField("value", T.StringType())]), fmt="text",
                            max_files=None)
    run_to_completion(payloads, f"{root}/checkpoint-2",
                      writer=upsert_writer(f"{root}/table", UPSERT_KEYS, transform=from_stat_json, day_of="window_start"))
    return _ntz(read_upserted(spark, f"{root}/table", UPSERT_KEYS, KEYED_STATISTICS_SCHEMA), "window_start", "window_end")


@register("open_windows_in_state", ("STR10", "STR4"), sql=f"""
SELECT * FROM ({_stats_sql(TUMBLING)}) WHERE window_end > (SELECT max(ts) FROM events) - INTERVAL 1 DAY
""")
def open_windows_in_state(spark, sf_dir):
    """What a finished stream still holds: with a watermark of a day, the windows of the last day and no others."""
    root, src, schema, per_batch = stage_events(spark, sf_dir, "state")
    timed = with_event_time(stream_table(spark, src, schema, max_files=per_batch).select("ts", "event_type", "value"),
                            "ts", "1 day")
    stats = window_stats(timed, TUMBLING, "event_type", "value", ts="ts", mean_decimals=VALUE_DECIMALS)
    run_to_completion(flatten_window(stats), f"{root}/checkpoint", writer=batch_writer(f"{root}/output", fmt="parquet"),
                      mode="append", state_partitions=state_slots(spark), state_conf=ROCKSDB)
    return _ntz(flatten_window(open_windows(spark, f"{root}/checkpoint", "event_type")), "window_start", "window_end")


@register("observed_training_set", ("PRJ9", "PRJ10", "AGG12"), sql=f"""
SELECT count(*) AS n_rows, count(*) - count(event_id) AS missing_event_id, count(*) - count(label) AS missing_label,
       count(*) - count(value) AS missing_value, count(*) - count(k) AS missing_k,
       count(*) FILTER (WHERE label = 0) AS count_label_0, count(*) FILTER (WHERE label = 1) AS count_label_1
FROM (SELECT event_id, (event_type = 'error')::INTEGER AS label, nullif(value, 50) AS value,
             nullif(json_extract_string(props, '$.k')::INTEGER, 7) AS k
      FROM events WHERE {sql_unit('event_id', SPLIT_SEED)} < 0.8)
""")
def observed_training_set(spark, sf_dir):
    """Missing values and class counts of the training split, observed while it is written."""
    ev = events(spark, sf_dir).select(
        "event_id", is_error().cast("int").alias("label"), F.nullif("value", F.lit(50.0)).alias("value"),
        F.nullif(F.from_json("props", "k int")["k"], F.lit(7)).alias("k"))
    train, _ = hash_split(ev, "event_id", (0.8, 0.2), method="md5")
    train = train.select("event_id", "label", "value", "k")
    _, seen = stage_observed(train, scratch_path(spark, "observed"), audit_columns(train, {"label": [0, 1]}))
    return spark.createDataFrame([tuple(seen.values())], T.StructType([T.StructField(n, T.LongType()) for n in seen]))


SENTINEL_SOURCE = """SELECT ts, user_id::VARCHAR AS airport_name, (event_type = 'error')::INTEGER AS label,
       -1.0::DOUBLE AS pred, value AS lat, event_id::DOUBLE AS lon FROM events"""


@register("stream_without_model", ("SRC8", "STR11"), sql=quality_sql(QUALITY, CLOSED, SENTINEL_SOURCE))
def stream_without_model(spark, sf_dir):
    """The scored stream where no model has been saved: every prediction is the sentinel, the schema the same."""
    root, src, schema, per_batch = stage_events(spark, sf_dir, "no-model")
    rows = quality_input(stream_table(spark, src, schema, max_files=per_batch).withColumn("ts", ntz_to_instant("ts")))
    scored = score(rows.drop("pred"), f"{root}/no-model-here", ["ts", "place", "label", "predicted_delay", "lat", "lon"])
    q = window_quality(scored, QUALITY, "place", "label", "predicted_delay", ts="ts", lat="lat", lon="lon", watermark=WATERMARK,
                       method="panes")
    run_to_completion(quality_rows(q), f"{root}/checkpoint", writer=batch_writer(f"{root}/output"), mode="append",
                      state_partitions=state_slots(spark))
    results = read_results(spark, f"{root}/output", QUALITY_RESULT_SCHEMA, key_as_string="airport_name")
    return _ntz(results, "window_start", "window_end")


@register("window_spec_forms", ("STR3", "STR1"), sql=f"""
SELECT form, t.* FROM ({_stats_sql(TUMBLING)}) t, (VALUES ('duration alone'), ('slide of the duration'), ('kind')) f(form)
""")
def window_spec_forms(spark, sf_dir):
    """Three ways to state one tumbling window, two of them by default; wrong statements are errors before any data is read."""
    forms = {"duration alone": WindowSpec("1 hour"), "slide of the duration": WindowSpec(3600, "60 minutes"),
             "kind": WindowSpec("1 hour", kind="tumbling")}
    for wrong in (("1 hour", "2 hours"), ("0 seconds",), ("an hour",), ("1 hour", "10 minutes", "tumbling"), ("1 hour", None, "hopping")):
        try:
            WindowSpec(*wrong)
        except ValueError:
            continue
        raise AssertionError(f"{wrong} was taken")
    parts = [flatten_window(window_stats(events(spark, sf_dir), spec, "event_type", "value", ts="ts", mean_decimals=VALUE_DECIMALS))
             .withColumn("form", F.lit(form)) for form, spec in forms.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
