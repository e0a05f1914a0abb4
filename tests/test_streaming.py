"""Streaming: lateness, append/update equivalence with batch, restart and replay."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tables import SF_SMALL
from tarmac.operators.windows import flatten_window, window_stats
from tarmac.roles import WindowSpec
from tarmac.schema import KEYED_STATISTICS_SCHEMA
from tarmac.sinks.writers import batch_writer, read_upserted
from tarmac.sources.results import read_results
from tarmac.sources.streams import stream_table, topic_options
from tarmac.streaming.runner import run_stream, run_to_completion, with_event_time

SCHEMA = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("k", T.StringType()),
                       T.StructField("v", T.DoubleType())])
STATS_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType()),
    T.StructField("k", T.StringType()), T.StructField("min_value", T.DoubleType()),
    T.StructField("max_value", T.DoubleType()), T.StructField("avg_value", T.DoubleType()),
    T.StructField("std_value", T.DoubleType()), T.StructField("count", T.LongType()),
])


def write_files(folder, batches):
    """One JSON-lines file per batch, modification times in batch order."""
    os.makedirs(folder, exist_ok=True)
    for i, times in enumerate(batches):
        p = os.path.join(folder, f"batch-{i:03d}.json")
        with open(p, "w") as fh:
            for t in times:
                fh.write(json.dumps({"ts": f"2024-01-01T{t}Z", "k": "a", "v": 1.0}) + "\n")
        os.utime(p, (1_000_000 + i, 1_000_000 + i))
    return folder


def run_counts(spark, tmp_dir, batches, checkpoint=None, output=None):
    src = write_files(os.path.join(tmp_dir, "in"), batches)
    stream = with_event_time(stream_table(spark, src, SCHEMA, fmt="json", max_files=1), "ts", "3 minutes")
    stats = flatten_window(window_stats(stream, WindowSpec("5 minutes"), "k", "v", ts="ts"))
    output = output or os.path.join(tmp_dir, "out")
    run_to_completion(stats, checkpoint or os.path.join(tmp_dir, "ckpt"), writer=batch_writer(output), mode="append")
    res = read_results(spark, output, STATS_SCHEMA)
    return {r.window_start.strftime("%H:%M"): r["count"] for r in res.collect()}, output


def test_late_row_dropped_after_watermark_moves(spark, tmp_dir):
    counts, _ = run_counts(spark, tmp_dir, [["00:00:00", "00:20:00"], ["00:30:00"], ["00:00:30", "00:40:00"]])
    # the 00:00:30 row arrives two batches after the watermark passed it: dropped
    assert counts["00:00"] == 1
    # append emits only windows closed by the final watermark (00:37)
    assert set(counts) == {"00:00", "00:20", "00:30"}


def test_late_by_one_batch_is_counted(spark, tmp_dir):
    counts, _ = run_counts(spark, tmp_dir, [["00:00:00", "00:20:00"], ["00:00:30", "00:30:00"]])
    # the late-row filter uses the previous batch's watermark, so this row still counts
    assert counts["00:00"] == 2


def test_restart_with_same_checkpoint_adds_nothing(spark, tmp_dir):
    batches = [["00:00:00", "00:20:00"], ["00:30:00"], ["00:00:30", "00:40:00"]]
    ckpt = os.path.join(tmp_dir, "ckpt")
    first, out = run_counts(spark, tmp_dir, batches, checkpoint=ckpt)
    files_before = sorted(os.listdir(out))
    second, _ = run_counts(spark, tmp_dir, batches, checkpoint=ckpt, output=out)
    assert first == second and sorted(os.listdir(out)) == files_before


def test_stream_equals_batch_in_update_mode_after_upsert(spark):
    from tarmac.plans.streams import run_stats_stream, stage_events

    staged = stage_events(spark, SF_SMALL, "test-update")
    root, table = run_stats_stream(spark, SF_SMALL, staged)
    # replay with a fresh checkpoint into the same table: the keyed upsert absorbs it
    run_stats_stream(spark, SF_SMALL, staged, checkpoint=f"{root}/checkpoint-2", table=table, reset=False)
    got = read_upserted(spark, table, ["window_start", "group_value"], KEYED_STATISTICS_SCHEMA)
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    from tarmac.plans.windows import TUMBLING, VALUE_DECIMALS

    want = flatten_window(window_stats(ev.withColumn("ts", F.col("ts").cast("timestamp")), TUMBLING, "event_type",
                                       "value", ts="ts", mean_decimals=VALUE_DECIMALS))
    want = want.withColumnRenamed("event_type", "group_value")
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_replay_into_one_target_is_absorbed_by_dedupe(spark):
    from tarmac.operators.dedupe import dedupe
    from tarmac.plans.streams import QUALITY_KEYS, QUALITY_RESULT_SCHEMA, run_quality_stream, stage_events

    staged = stage_events(spark, SF_SMALL, "test-replay")
    root, out = run_quality_stream(spark, SF_SMALL, staged)
    single = read_results(spark, out, QUALITY_RESULT_SCHEMA).count()
    run_quality_stream(spark, SF_SMALL, staged, checkpoint=f"{root}/checkpoint-2", output=out)
    replayed = dedupe(read_results(spark, out, QUALITY_RESULT_SCHEMA), QUALITY_KEYS)
    assert replayed.count() == single


def test_empty_results_folder_gives_empty_frame(spark, tmp_dir):
    df = read_results(spark, os.path.join(tmp_dir, "nothing-here"), STATS_SCHEMA)
    assert df.count() == 0 and df.schema == STATS_SCHEMA


def test_empty_batches_are_skipped(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    w = batch_writer(out)
    w(spark.createDataFrame([], SCHEMA), 0)
    w(spark.createDataFrame([("2024-01-01 00:00:00", "a", 1.0)], "ts string, k string, v double"), 1)
    assert sorted(os.listdir(out)) == ["batch_1"]


def test_topic_options():
    o = topic_options("kafka:9092", "flights_topic", "earliest", max_offsets=50)
    assert o == {"kafka.bootstrap.servers": "kafka:9092", "subscribe": "flights_topic",
                 "startingOffsets": "earliest", "maxOffsetsPerTrigger": "50"}
    import pytest

    with pytest.raises(ValueError):
        topic_options("k", "t", "middle")


def test_run_stream_argument_checks(spark, tmp_dir):
    import pytest

    df = stream_table(spark, write_files(os.path.join(tmp_dir, "in"), [["00:00:00"]]), SCHEMA, fmt="json")
    with pytest.raises(ValueError):
        run_stream(df, "", fmt="memory")
    with pytest.raises(ValueError):
        run_stream(df, os.path.join(tmp_dir, "c"), mode="sometimes", fmt="memory")
    with pytest.raises(ValueError):
        run_stream(df, os.path.join(tmp_dir, "c"))


KV = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def state(spark, path):
    return sorted(tuple(r) for r in read_upserted(spark, path, ["k"], KV).collect())


DAYS = T.StructType([T.StructField("at", T.TimestampType()), T.StructField("k", T.StringType()),
                     T.StructField("v", T.LongType())])


def test_upsert_last_write_wins_and_replays_change_nothing(spark, tmp_dir):
    from tarmac.sinks.writers import upsert_writer

    path = os.path.join(tmp_dir, "table")
    w = upsert_writer(path, ["k"], spark=spark, reset_schema=KV)
    assert state(spark, path) == []
    for batch_id in range(4):
        w(spark.createDataFrame([("a", batch_id), ("b", 10 + batch_id)] if batch_id % 2 == 0 else [("a", 100)], KV), batch_id)
    got = state(spark, path)
    assert got == [("a", 100), ("b", 12)]
    w(spark.createDataFrame([("a", 100)], KV), 3)
    assert state(spark, path) == got
    # Two rows of one key in one batch: the larger one, whatever their order.
    w(spark.createDataFrame([("a", 5), ("a", 7)], KV).repartition(2), 4)
    assert state(spark, path) == [("a", 7), ("b", 12)]


def test_fresh_checkpoint_writes_last(spark, tmp_dir):
    from tarmac.sinks.writers import upsert_writer

    path = os.path.join(tmp_dir, "table")
    first = upsert_writer(path, ["k"], spark=spark, reset_schema=KV)
    for batch_id in range(3):
        first(spark.createDataFrame([("a", batch_id)], KV), batch_id)
    second = upsert_writer(path, ["k"], spark=spark)  # batches count from 0 again
    second(spark.createDataFrame([("a", 999), ("new", 1)], KV), 0)
    assert state(spark, path) == [("a", 999), ("new", 1)]


def test_fold_leaves_one_row_a_key_and_touches_only_its_days(spark, tmp_dir):
    import datetime as dt

    from tarmac.sinks.writers import fold_upserts, reset_table, upsert_writer

    path, keys = os.path.join(tmp_dir, "table"), ["at", "k"]
    day = lambda d, h=0: dt.datetime(2024, 1, d, h, tzinfo=dt.timezone.utc)
    reset_table(spark, path, DAYS, day_of="at")
    w = upsert_writer(path, keys, day_of="at")
    for batch_id in range(3):
        w(spark.createDataFrame([(day(1), "a", batch_id), (day(1, 23), "a", 9), (day(2), "b", batch_id * 2)], DAYS), batch_id)
    read = lambda: sorted((r.k, r.v) for r in read_upserted(spark, path, keys, DAYS).collect())
    raw = lambda: spark.read.parquet(path).groupBy("upsert_day").count().orderBy("upsert_day").collect()
    want = [("a", 2), ("a", 9), ("b", 4)]
    assert read() == want and [r["count"] for r in raw()] == [6, 3]
    fold_upserts(spark, path, keys, DAYS, "at", days=["2024-01-01"])
    assert read() == want and [r["count"] for r in raw()] == [2, 3]
    fold_upserts(spark, path, keys, DAYS, "at")
    assert read() == want and [r["count"] for r in raw()] == [2, 1]
    w(spark.createDataFrame([(day(1), "a", -1)], DAYS), 0)  # after a fold, on a fresh checkpoint
    assert read() == [("a", -1), ("a", 9), ("b", 4)]
    reset_table(spark, path, DAYS, day_of="at")
    assert read() == []
    import pytest

    with pytest.raises(ValueError):
        upsert_writer(path, ["k"], day_of="at")


def test_staged_files_scale_with_input(spark, tmp_dir):
    from tarmac.sources.streams import stage_event_batches

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    path = os.path.join(tmp_dir, "staged")
    per_batch = stage_event_batches(ev, path, "ts", 5, bytes_per_file=3_000)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert per_batch > 1 and 5 < len(files) <= 5 * per_batch
    stream = with_event_time(stream_table(spark, path, ev.schema, max_files=per_batch), "ts", "3 minutes")
    stats = flatten_window(window_stats(stream.select("ts", "event_type", "value"), WindowSpec("1 hour"),
                                        "event_type", "value", ts="ts"))
    out = os.path.join(tmp_dir, "out")
    q = run_to_completion(stats, os.path.join(tmp_dir, "ckpt"), writer=batch_writer(out, fmt="parquet"),
                          mode="update")
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) <= 5
    schema = T.StructType([T.StructField("event_type" if f.name == "k" else f.name, f.dataType)
                           for f in STATS_SCHEMA.fields])
    got = read_results(spark, out, schema, fmt="parquet")
    assert got.agg(F.sum("count")).first()[0] >= ev.count()  # update mode re-emits changed windows


def test_batch_writer_partitions(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    w = batch_writer(out, fmt="parquet", partition_by=["k"])
    w(spark.createDataFrame([("2024-01-01 00:00:00", "a", 1.0), ("2024-01-01 00:00:00", "b", 2.0)],
                            "ts string, k string, v double"), 3)
    assert sorted(d for d in os.listdir(os.path.join(out, "batch_3")) if d.startswith("k=")) == ["k=a", "k=b"]


def test_payload_omits_nulls_and_keeps_null_group(spark):
    from tarmac.sinks.payload import from_stat_json, to_stat_json

    df = spark.createDataFrame([("2024-01-01 00:00:01", "ATL", 5.0), ("2024-01-01 00:00:02", None, 7.0),
                                ("2024-01-01 00:00:03", None, 9.0)], "ts string, g string, v double") \
        .withColumn("ts", F.to_timestamp("ts"))
    stats = window_stats(df, WindowSpec("1 minute"), "g", "v", ts="ts")
    payload = {r.value for r in to_stat_json(stats, "g").collect()}
    single = [p for p in payload if '"group":"ATL"' in p][0]
    assert '"std_value"' not in single and '"count":1' in single  # single-row group: stddev NULL, omitted
    back = {r.group_value: r for r in from_stat_json(to_stat_json(stats, "g")).collect()}
    assert back["ATL"].std_value is None and back["ATL"].min_value == 5.0
    assert None in back and back[None]["count"] == 2  # NULL group stays NULL, not the text "None"
    assert back[None].window_start.isoformat().startswith("2024-01-01T00:00")


def test_interrupted_stream_resumes_to_the_same_result(spark):
    """Stop mid-stream, restart on the same checkpoint: no loss, no duplicates."""
    import time as _time

    from tarmac.functions.scalar import ntz_to_instant
    from tarmac.operators.windows import quality_rows, window_quality
    from tarmac.plans.streams import (QUALITY_RESULT_SCHEMA, WATERMARK, quality_input, run_quality_stream,
                                      stage_events)
    from tarmac.plans.windows import QUALITY

    staged = stage_events(spark, SF_SMALL, "test-interrupt")
    root, src, schema, per_batch = staged
    stream = stream_table(spark, src, schema, max_files=per_batch)
    rows = quality_rows(window_quality(quality_input(stream).withColumn("ts", ntz_to_instant("ts")), QUALITY,
                                       "place", "label", "pred", ts="ts", lat="lat", lon="lon", watermark=WATERMARK))
    out, ckpt = f"{root}/interrupted", f"{root}/checkpoint-interrupted"
    q = run_stream(rows, ckpt, writer=batch_writer(out), mode="append", trigger="1 second")
    deadline = _time.time() + 120
    while _time.time() < deadline and (q.lastProgress is None or q.lastProgress["batchId"] < 1):
        _time.sleep(0.2)
    q.stop()
    partial = read_results(spark, out, QUALITY_RESULT_SCHEMA).count()
    run_quality_stream(spark, SF_SMALL, staged, checkpoint=ckpt, output=out)  # resume to the end
    resumed = read_results(spark, out, QUALITY_RESULT_SCHEMA)
    _, single_out = run_quality_stream(spark, SF_SMALL, stage_events(spark, SF_SMALL, "test-single"))
    single = read_results(spark, single_out, QUALITY_RESULT_SCHEMA)
    assert partial < single.count()
    assert resumed.count() == single.count()
    assert resumed.exceptAll(single).count() == 0 and single.exceptAll(resumed).count() == 0


def test_paced_replay_resumes_and_ends(spark, tmp_dir):
    """Two runs on one checkpoint deliver every row once, in batches of the stated size."""
    from tarmac.sources.events import number_rows, paced_rows
    from tarmac.streaming.runner import run_batches

    number_rows(spark.range(0, 1000, 1, 7).withColumn("x", F.col("id") * 3), ["id"]).write.parquet(tmp_dir + "/n")
    numbered = spark.read.parquet(tmp_dir + "/n")
    assert numbered.where("row <> id").count() == 0
    for batches in (2, 5):
        run_batches(paced_rows(numbered, 300), tmp_dir + "/c", batches, writer=batch_writer(tmp_dir + "/out", fmt="parquet"))
        if batches == 2:
            first = spark.read.option("recursiveFileLookup", True).parquet(tmp_dir + "/out").count()
    out = spark.read.option("recursiveFileLookup", True).parquet(tmp_dir + "/out")
    assert 600 <= first <= 1000 and out.count() == 1000 and out.where("x <> 3 * row").count() == 0
    import pytest

    with pytest.raises(ValueError):
        paced_rows(numbered, 10**9)


def test_state_holds_open_windows_only(spark, tmp_dir):
    """What the watermark has closed is gone from the store, batch by batch."""
    from tarmac.streaming.state import ROCKSDB, open_windows, read_state, state_operators

    src = write_files(os.path.join(tmp_dir, "in"), [["00:00:00", "00:20:00"], ["00:30:00", "00:31:00"], ["00:40:00"]])
    stream = with_event_time(stream_table(spark, src, SCHEMA, fmt="json", max_files=1), "ts", "3 minutes")
    stats = flatten_window(window_stats(stream, WindowSpec("5 minutes"), "k", "v", ts="ts", mean_decimals=2))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    run_to_completion(stats, tmp_dir + "/c", writer=batch_writer(tmp_dir + "/out"), mode="append", state_partitions=2, state_conf=ROCKSDB)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    left = open_windows(spark, tmp_dir + "/c", "k").collect()
    assert [(r.window.start.strftime("%H:%M"), r.min_value, r.avg_value, r.std_value, r["count"]) for r in left] == [
        ("00:40", 1.0, 1.0, None, 1)]
    op = state_operators(spark, tmp_dir + "/c").first()
    assert op.operatorName == "stateStoreSave" and op.numPartitions == 2
    assert read_state(spark, tmp_dir + "/c", batch=1).count() == 2  # 00:20 and 00:30: the first file closed 00:00
    done = {r.window_start.strftime("%H:%M") for r in read_results(spark, tmp_dir + "/out", STATS_SCHEMA).collect()}
    assert done == {"00:00", "00:20", "00:30"}


def test_copies_go_in_the_stream_and_state_stays_bounded(spark, tmp_dir):
    from tarmac.operators.dedupe import dedupe_within_watermark

    rows = [[("00:00:00", 1), ("00:00:10", 2), ("00:00:00", 1)], [("00:02:00", 3), ("00:00:10", 2)], [("01:00:00", 4)], [("01:00:01", 5), ("01:00:00", 4)]]
    folder = os.path.join(tmp_dir, "in")
    os.makedirs(folder)
    for i, batch in enumerate(rows):
        p = os.path.join(folder, f"b{i}.json")
        with open(p, "w") as fh:
            fh.writelines(json.dumps({"ts": f"2024-01-01T{t}Z", "k": str(k), "v": 1.0}) + "\n" for t, k in batch)
        os.utime(p, (1_000_000 + i, 1_000_000 + i))
    stream = stream_table(spark, folder, SCHEMA, fmt="json", max_files=1)
    q = run_to_completion(dedupe_within_watermark(stream, ["k"], "ts", "3 minutes"), tmp_dir + "/c", state_partitions=2,
                          writer=batch_writer(tmp_dir + "/out", fmt="parquet"))
    got = read_results(spark, tmp_dir + "/out", SCHEMA, fmt="parquet")
    assert sorted(r.k for r in got.collect()) == ["1", "2", "3", "4", "5"]
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2  # keys of the first minutes have gone
    batch = spark.createDataFrame([("2024-01-01 00:00:05", "a", 2.0), ("2024-01-01 00:00:01", "a", 1.0)], "ts string, k string, v double")
    assert [r.v for r in dedupe_within_watermark(batch, ["k"], "ts", "3 minutes").collect()] == [1.0]


def test_large_replays_take_more_micro_batches(spark, tmp_dir):
    """No micro-batch has more files than there are task slots, and the windows are those of a batch job."""
    from tarmac.sources.streams import stage_event_batches
    from tarmac.streaming.runner import state_slots

    n, rows_per_file = 12_000, 100
    rows = spark.range(n).select(F.timestamp_seconds(F.col("id") * 10).alias("ts"), (F.col("id") % 3).cast("string").alias("k"),
                                 (F.col("id") % 11).cast("double").alias("v"))
    path, slots = os.path.join(tmp_dir, "staged"), state_slots(spark)
    per_batch = stage_event_batches(rows, path, "ts", 5, rows_per_file=rows_per_file)
    assert per_batch == min(slots, 24)
    spec = WindowSpec("1 hour", "30 minutes")
    stream = with_event_time(stream_table(spark, path, rows.schema, max_files=per_batch), "ts", "3 minutes")
    out = os.path.join(tmp_dir, "out")
    q = run_to_completion(flatten_window(window_stats(stream, spec, "k", "v", ts="ts")), os.path.join(tmp_dir, "ckpt"),
                          writer=batch_writer(out, fmt="parquet"), mode="append", state_partitions=slots)
    taken = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"] > 0]
    assert sum(taken) == n and max(taken) <= 2 * rows_per_file * per_batch and len(taken) >= n // (2 * rows_per_file * per_batch)
    want = flatten_window(window_stats(rows, spec, "k", "v", ts="ts")).where(
        F.col("window_end") <= F.lit(n * 10 - 10 - 180).cast("timestamp"))
    got = read_results(spark, out, want.schema, fmt="parquet")
    assert want.count() > 0 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
