"""Command line for the flight applications, with the reference's flags.

    python -m tarmac.cli batch --input data.csv [--month 3] [--carrier Delta]
           [--stats_col PLANE_AGE] [--group_by_col CARRIER_NAME]
    python -m tarmac.cli produce --input data.csv (--output events/ [--files 10] | --kafka_servers host:9092
           [--topic flights_topic]) [--interval 1.0] [--start EPOCH] [--ts_col COLUMN]
    python -m tarmac.cli stream-stats --input events/ --window_duration 60 --window_type tumbling
           --group_by DEPARTING_AIRPORT [--target_col PLANE_AGE] [--filter "CARRIER_NAME=='Delta'"]...
           --checkpoint ckpt/ (--table stats/ | --kafka_servers host:9092 --topic statistics_topic)
    python -m tarmac.cli stats-table (--input payloads/ | --kafka_servers host:9092 [--input_topic statistics_topic])
           --checkpoint ckpt/ --table stats/ [--reset]
    python -m tarmac.cli train --input data.csv --model model/
    python -m tarmac.cli stream-predict --input events/ --model model/ --window_duration 30
           --window_type sliding --slide_duration 5 --output predictions/ --checkpoint ckpt/
    python -m tarmac.cli report --output predictions/

Streams read JSON event files (one record per line) from ``--input``, or a topic with ``--kafka_servers``/``--topic``.
"""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import flights as app
from tarmac.roles import WindowSpec
from tarmac.schema import FLIGHT_CSV_SCHEMA, FLIGHT_SCHEMA
from tarmac.sinks.writers import batch_writer
from tarmac.sources.events import arrival_times, decode_events, encode_events
from tarmac.sources.streams import read_topic, stream_table, topic_options, topic_sink_options
from tarmac.sources.tables import read_table, stage_parquet
from tarmac.streaming.runner import run_stream, state_slots


def _table(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    return read_table(spark, path, schema=FLIGHT_CSV_SCHEMA if fmt == "csv" else None, fmt=fmt)


def _window(args) -> WindowSpec:
    slide = args.slide_duration if args.window_type == "sliding" else None
    return WindowSpec(int(args.window_duration), int(slide) if slide else None, kind=args.window_type)


def _events(spark: SparkSession, args) -> DataFrame:
    if args.kafka_servers:
        raw = read_topic(spark, topic_options(args.kafka_servers, args.input_topic, args.starting_offsets,
                                              args.max_offsets))
    else:
        raw = stream_table(spark, args.input, "value string", fmt="text", max_files=args.max_files)
    return decode_events(raw, FLIGHT_SCHEMA)


def _state_partitions(spark: SparkSession, args) -> int:
    return args.state_partitions or state_slots(spark)


def _show(results: dict[str, DataFrame], rows: int) -> None:
    for name, df in results.items():
        print(f"--- {name} ---")
        df.show(rows, truncate=False)


def cmd_batch(spark, args):
    df = _table(spark, args.input, args.format)
    if args.stage:
        # one CSV parse, then every report job reads pruned, filter-pushed Parquet
        df = read_table(spark, stage_parquet(df, args.stage))
    _show(app.delay_report(df, args.month, args.carrier, args.stats_col, args.group_by_col, spark=spark), args.rows)


def cmd_produce(spark, args):
    df = _table(spark, args.input, args.format)
    if args.ts_col:
        out = encode_events(df, FLIGHT_SCHEMA, ts_col=args.ts_col)
    else:
        start = int(time.time()) if args.start is None else args.start
        stamped = arrival_times(df, start, args.interval)
        out = encode_events(stamped, FLIGHT_SCHEMA, ts_col=F.timestamp_seconds("timestamp"))
    if args.kafka_servers:
        out.write.format("kafka").options(**topic_sink_options(args.kafka_servers, args.topic)).save()
    else:
        (out.repartition(args.files) if args.files else out).write.mode("overwrite").text(args.output)


def cmd_stream_stats(spark, args):
    payload = app.window_statistics_stream(_events(spark, args), _window(args), args.group_by, args.target_col,
                                           filters=args.filter, watermark=args.watermark)
    if args.kafka_servers and args.topic:
        q = run_stream(payload, args.checkpoint, mode="update", trigger=args.trigger, fmt="kafka",
                       options=topic_sink_options(args.kafka_servers, args.topic),
                       state_partitions=_state_partitions(spark, args))
    else:
        q = run_stream(payload, args.checkpoint, mode="update", trigger=args.trigger,
                       writer=app.statistics_table_writer(args.table, spark, reset=args.reset),
                       state_partitions=_state_partitions(spark, args))
    q.awaitTermination()


def cmd_stats_table(spark, args):
    if args.kafka_servers:
        raw = read_topic(spark, topic_options(args.kafka_servers, args.input_topic, args.starting_offsets))
    else:
        raw = stream_table(spark, args.input, "value string", fmt="text", max_files=args.max_files)
    q = run_stream(raw.select(F.col("value").cast("string").alias("value")), args.checkpoint, mode="append",
                   trigger=args.trigger, writer=app.statistics_table_writer(args.table, spark, reset=args.reset))
    q.awaitTermination()


def cmd_train(spark, args):
    result, _ = app.train_delay_model(_table(spark, args.input, args.format), args.model,
                                      classifier=args.classifier, threshold=args.threshold)
    print(f"AUC={result.auc:.4f} weighted F1={result.f1:.4f} sample fraction={result.sample_fraction} "
          f"training rows={result.n_train}")


def cmd_stream_predict(spark, args):
    rows = app.predict_stream(_events(spark, args), args.model, _window(args), watermark=args.watermark,
                              on_missing=args.on_missing)
    q = run_stream(rows, args.checkpoint, mode="append", trigger=args.trigger,
                   writer=batch_writer(args.output, files=args.files_per_batch),
                   state_partitions=_state_partitions(spark, args))
    q.awaitTermination()


def cmd_report(spark, args):
    _show(app.prediction_report(spark, args.output), args.rows)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tarmac")
    sub = p.add_subparsers(dest="command", required=True)

    def table_args(sp):
        sp.add_argument("--input", required=True, help="table path (local, HDFS or object store)")
        sp.add_argument("--format", default="csv", choices=["csv", "parquet"])

    def stream_args(sp, start, offsets=None):
        sp.add_argument("--input", help="folder of JSON event files")
        sp.add_argument("--max_files", type=int, help="files in a micro-batch (default: all that are there)")
        sp.add_argument("--kafka_servers")
        sp.add_argument("--input_topic", default="flights_topic")
        sp.add_argument("--starting_offsets", default=start)
        sp.add_argument("--max_offsets", type=int, default=offsets)
        sp.add_argument("--window_duration", type=int, required=True, help="seconds")
        sp.add_argument("--window_type", required=True, choices=["tumbling", "sliding"])
        sp.add_argument("--slide_duration", default=None, help="seconds (sliding only)")
        sp.add_argument("--checkpoint", required=True)
        sp.add_argument("--trigger", default="5 seconds", help="'availableNow', 'once' or an interval")
        sp.add_argument("--state_partitions", type=int, default=None,
                        help="state-store partitions of a new query (default: the cluster's task slots)")

    b = sub.add_parser("batch")
    table_args(b)
    b.add_argument("--month", type=int)
    b.add_argument("--carrier")
    b.add_argument("--stats_col", default="PLANE_AGE")
    b.add_argument("--group_by_col", default="CARRIER_NAME")
    b.add_argument("--rows", type=int, default=20)
    b.add_argument("--stage", help="stage the input as Parquet here first (recommended for CSV)")
    b.set_defaults(fn=cmd_batch)

    pr = sub.add_parser("produce")
    table_args(pr)
    pr.add_argument("--output", help="folder for event files")
    pr.add_argument("--files", type=int, default=None)
    pr.add_argument("--kafka_servers")
    pr.add_argument("--topic", default="flights_topic")
    pr.add_argument("--interval", type=float, default=1.0, help="seconds between events")
    pr.add_argument("--start", type=int, help="epoch second of the first event (default: now)")
    pr.add_argument("--ts_col", help="take event times from this column instead")
    pr.set_defaults(fn=cmd_produce)

    s = sub.add_parser("stream-stats")
    stream_args(s, "latest")
    s.add_argument("--group_by", required=True)
    s.add_argument("--target_col", default="DEP_DEL15")
    s.add_argument("--filter", action="append", default=[])
    s.add_argument("--watermark", default="10 minutes")
    s.add_argument("--table")
    s.add_argument("--reset", action="store_true")
    s.add_argument("--topic")
    s.set_defaults(fn=cmd_stream_stats)

    st = sub.add_parser("stats-table")
    st.add_argument("--input", help="folder of statistics payload files")
    st.add_argument("--max_files", type=int)
    st.add_argument("--kafka_servers")
    st.add_argument("--input_topic", default="statistics_topic")
    st.add_argument("--starting_offsets", default="earliest")
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--trigger", default="5 seconds")
    st.add_argument("--table", required=True)
    st.add_argument("--reset", action="store_true")
    st.set_defaults(fn=cmd_stats_table)

    t = sub.add_parser("train")
    table_args(t)
    t.add_argument("--model", required=True)
    t.add_argument("--classifier", default="gbt", choices=["gbt", "lr", "rf", "rf_shallow"])
    t.add_argument("--threshold", type=float, default=0.25)
    t.set_defaults(fn=cmd_train)

    sp = sub.add_parser("stream-predict")
    stream_args(sp, "earliest", 50)
    sp.add_argument("--model", required=True)
    sp.add_argument("--on_missing", default="sentinel", choices=["sentinel", "error"],
                    help="without a model at --model: predict -1, or stop")
    sp.add_argument("--output", required=True)
    sp.add_argument("--watermark", default="3 minutes")
    sp.add_argument("--files_per_batch", type=int, default=None)
    sp.set_defaults(fn=cmd_stream_predict)

    r = sub.add_parser("report")
    r.add_argument("--output", required=True)
    r.add_argument("--rows", type=int, default=20)
    r.set_defaults(fn=cmd_report)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    if args.command in ("stream-stats",) and not (args.table or (args.kafka_servers and args.topic)):
        raise SystemExit("stream-stats needs --table or --kafka_servers with --topic")
    if args.command == "produce" and not (args.output or args.kafka_servers):
        raise SystemExit("produce needs --output or --kafka_servers")
    if args.command in ("stream-stats", "stream-predict", "stats-table") and not (args.input or args.kafka_servers):
        raise SystemExit("give --input (event files) or --kafka_servers")
    spark = spark or SparkSession.builder.appName(f"tarmac-{args.command}").getOrCreate()
    args.fn(spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
