"""Sources: CSV with a declared schema, URI paths, processing-time trigger, stamping."""

import os

import pytest
from pyspark.sql import functions as F

from tables import SF_SMALL
from tarmac.plans.prep import LINEITEM_SCHEMA
from tarmac.sinks.writers import batch_writer
from tarmac.sources.events import arrival_times, decode_events, encode_events
from tarmac.sources.results import read_results
from tarmac.sources.streams import check_file_order, stage_event_batches, stream_table, topic_sink_options
from tarmac.sources.tables import read_table, stage_parquet
from tarmac.streaming.runner import run_stream


def test_csv_with_schema_equals_parquet(spark, tmp_dir):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    csv_dir = os.path.join(tmp_dir, "csv")
    li.write.option("header", True).csv(csv_dir)
    back = read_table(spark, "file://" + csv_dir, schema=LINEITEM_SCHEMA, fmt="csv")
    assert back.schema == LINEITEM_SCHEMA
    assert back.exceptAll(li).count() == 0 and li.exceptAll(back).count() == 0
    staged = stage_parquet(back, os.path.join(tmp_dir, "staged"), partitions=2)
    assert read_table(spark, staged).count() == li.count()


def test_inferred_csv(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a", 2.5)], "x int, y string, z double")
    p = os.path.join(tmp_dir, "c")
    df.write.option("header", True).csv(p)
    got = read_table(spark, p, fmt="csv")
    assert dict(got.dtypes) == {"x": "int", "y": "string", "z": "double"}


def test_csv_is_bound_by_header_name(spark, tmp_dir):
    p = os.path.join(tmp_dir, "c.csv")
    with open(p, "w") as fh:
        fh.write("z,extra,y,x\n2.91,e,text,65.0\n,,,\nbad,e,t,9007199254740993\n")
    got = read_table(spark, p, schema="x long, y string, z double", fmt="csv")
    assert got.columns == ["x", "y", "z", "extra"]
    assert [tuple(r) for r in got.collect()] == [(65, "text", 2.91, "e"), (None, None, None, None),
                                                 (9007199254740993, "t", None, "e")]
    with pytest.raises(ValueError):
        read_table(spark, p, schema="x long, w string", fmt="csv")


def test_csv_files_with_different_headers_raise(spark, tmp_dir):
    for name, text in (("a", "x,y\n1,2\n"), ("b", "y,x\n2,1\n")):
        with open(os.path.join(tmp_dir, f"{name}.csv"), "w") as fh:
            fh.write(text)
    with pytest.raises(Exception, match="(?i)header"):
        read_table(spark, tmp_dir, schema="x int, y int", fmt="csv").collect()


def test_arrival_times_are_spaced(spark):
    rows = spark.range(100_000).repartition(7)
    got = arrival_times(rows, 1_000, 0.5, order_by=["id"])
    assert got.where(F.col("timestamp") != 1_000 + F.floor(F.col("id") * 0.5)).count() == 0
    kept = arrival_times(spark.range(0, 1000, 1, 4), 0, 1.0)
    assert kept.where("timestamp <> id").count() == 0 and kept.count() == 1000


def test_replay_order_is_verified(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    path = os.path.join(tmp_dir, "staged")
    per_batch = stage_event_batches(ev, path, "ts", 5, bytes_per_file=3_000)
    files = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    assert per_batch > 1 and len(files) <= 5 * per_batch
    times = [os.path.getmtime(os.path.join(path, f)) for f in files]
    assert times == sorted(times) and len(set(times)) == len(times)
    wanted = [("a", 1), ("b", 2)]
    check_file_order(wanted, [("a", 10), ("b", 20)])
    for ignored in ([("a", 10), ("b", 10)], [("a", 20), ("b", 10)], [("a", 10)]):
        with pytest.raises(RuntimeError, match="modification times"):
            check_file_order(wanted, ignored)


def test_processing_time_trigger(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = os.path.join(tmp_dir, "in")
    ev.write.parquet(src)
    stream = stream_table(spark, src, ev.schema, max_files=1)
    out = os.path.join(tmp_dir, "out")
    q = run_stream(stream.select("event_id", "value"), os.path.join(tmp_dir, "ckpt"),
                   writer=batch_writer(out, fmt="parquet"), trigger="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = read_results(spark, out, ev.select("event_id", "value").schema, fmt="parquet")
    assert got.count() == ev.count()


def test_stamp_arrival_time(spark):
    df = spark.createDataFrame([("a",)], "k string")
    enc = encode_events(df, stamp_now=True)
    from pyspark.sql import types as T

    s = T.StructType([T.StructField("k", T.StringType()), T.StructField("timestamp", T.LongType())])
    row = decode_events(enc, s).first()
    import time

    assert abs(row.timestamp - time.time()) < 600


def test_topic_sink_options():
    assert topic_sink_options("k:9092", "statistics_topic") == {"kafka.bootstrap.servers": "k:9092",
                                                                "topic": "statistics_topic"}


def test_event_time_from_epoch_seconds(spark):
    from tarmac.schema import FLIGHT_SCHEMA

    raw = spark.createDataFrame([('{"timestamp": 1704067200, "MONTH": 1}',)], "value string")
    row = decode_events(raw, FLIGHT_SCHEMA, columns=["MONTH", "timestamp"], event_time="timestamp") \
        .select(F.unix_timestamp("event_timestamp").alias("s")).first()
    assert row.s == 1704067200


def test_missing_kafka_connector_is_explained(spark):
    from tarmac.sources.streams import read_topic, topic_options

    with pytest.raises(RuntimeError, match="Kafka connector"):
        read_topic(spark, topic_options("localhost:9", "flights_topic"))


def test_results_are_bound_by_name_across_headers(spark, tmp_dir):
    """Files with other column orders, a missing and an unknown column, a quoted name, a header alone, nothing at all."""
    folder = os.path.join(tmp_dir, "batch 1")
    os.makedirs(folder)
    files = {"a.csv": "place,LATITUDE,n\nx,20.5,1\ny,,2\n", "b.csv": "n,place,LATITUDE\n3,z,1.5\n", "c.csv": "n,place\n4,w\n",
             "d.csv": '"LATITUDE","extra, one",place,n\n9.0,what,"q,r",5\n', "e.csv": "place,n\n", "f.csv": "",
             "g.csv": "\nplace,LATITUDE,n\nv,7.0,6\n"}
    for name, text in files.items():
        with open(os.path.join(folder, name), "w") as fh:
            fh.write(text)
    from tarmac.sources.results import headers_of

    got = read_results(spark, tmp_dir, spark.createDataFrame([], "place string, LATITUDE double, n int").schema)
    assert got.columns == ["place", "LATITUDE", "n"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[2]) == [
        ("x", 20.5, 1), ("y", None, 2), ("z", 1.5, 3), ("w", None, 4), ("q,r", 9.0, 5), ("v", 7.0, 6)]
    assert len(headers_of(spark, tmp_dir)) == 5


def test_large_result_file_has_one_header(spark, tmp_dir):
    """A file of several splits: only the first line of the first one is a header."""
    spark.range(200_000).selectExpr("id", "id % 7 AS b").coalesce(1).write.option("header", True).csv(tmp_dir + "/r")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        got = read_results(spark, tmp_dir + "/r", spark.createDataFrame([], "b long, id long").schema)
        assert got.agg(F.count("*"), F.sum("id"), F.sum("b")).first()[:2] == (200_000, 199_999 * 100_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_first_lines_are_found_without_sorting(spark, tmp_dir):
    from tarmac.sources.results import first_line_marks

    spark.range(3000).selectExpr("id", "id % 7 AS b").repartition(3).write.option("header", True).csv(tmp_dir + "/r")
    found = first_line_marks(spark, tmp_dir)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan
    assert found.count() == 3 and found.select("h", "c").distinct().count() == 1


def test_tasks_over_results_follow_their_size(spark, tmp_dir):
    """More rows are brought together by more tasks, whatever the session's shuffle width; the rows are the same."""
    from tarmac.operators.dedupe import dedupe
    from tarmac.sources.results import result_tasks
    from tarmac.streaming.runner import state_slots

    rows = spark.range(20_000).selectExpr("id % 9000 AS k", "IF(id % 5 = 0, NULL, concat('p', id % 9000)) AS p", "id AS v")
    rows.write.option("header", True).csv(tmp_dir + "/r")
    size = sum(os.path.getsize(os.path.join(tmp_dir, "r", f)) for f in os.listdir(tmp_dir + "/r") if f.endswith(".csv"))
    assert result_tasks(spark, tmp_dir + "/none") == result_tasks(spark, tmp_dir) == state_slots(spark)
    tasks = result_tasks(spark, tmp_dir, bytes_per_task=size // 40)
    assert max(state_slots(spark), 40) <= tasks <= max(state_slots(spark), 41)
    back = read_results(spark, tmp_dir, rows.schema)
    got, want = dedupe(back, ["k", "p"], tasks=40), dedupe(back, ["k", "p"])
    assert got.rdd.getNumPartitions() == 40
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_coercion_of_odd_numbers(spark):
    from pyspark.sql import types as T

    from tarmac.functions.scalar import coerce_to

    df = spark.createDataFrame([(x,) for x in ("17", " 17 ", "-3.9", "+4", "9007199254740993", "1e3", "", " ", "x", None, "99999999999999999999",
                                               "3000000000", "NaN", "0017", "1_0")], "s string")
    got = df.select(coerce_to("s", T.LongType()).alias("l"), coerce_to("s", T.IntegerType()).alias("i")).collect()
    assert [r.l for r in got] == [17, 17, -3, 4, 9007199254740993, 1000, None, None, None, None, None, 3000000000, None, 17, None]
    assert [r.i for r in got] == [17, 17, -3, 4, None, 1000, None, None, None, None, None, None, None, 17, None]
    numbers = spark.createDataFrame([(2.9, 5, True)], "d double, l long, b boolean")
    assert tuple(numbers.select(*(coerce_to(c, T.IntegerType()) for c in numbers.columns)).first()) == (2, 5, 1)


def test_staged_files_are_bounded_by_rows(spark, tmp_dir):
    """Rows that take few bytes on disk are still dealt over several files a micro-batch: a replay task reads a whole file."""
    rows = spark.range(1_200_000).select(F.timestamp_seconds(F.col("id") / 10).alias("ts"), (F.col("id") % 7).alias("k"))
    path = os.path.join(tmp_dir, "staged")
    per_batch = stage_event_batches(rows, path, "ts", 5)
    staged = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(
        F.count("*").alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi")).orderBy("file").collect()
    assert sum(r.n for r in staged) == 1_200_000 and max(r.n for r in staged) <= 150_000
    assert per_batch > 1 and all(a.hi <= b.lo for a, b in zip(staged, staged[1:]))
