"""

Prints one JSON line::

    {"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ..., ...}

Each query is executed in full with the ``noop`` sink (nothing is collected
to the driver). Headline queries: one warm-up, median of 3; streaming and
model-fitting queries (which write their own outputs): one warm-up, one run.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_REPEAT`` (default 3), ``BENCH_ONLY`` (comma list).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from tarmac.plans.registry import all_queries  # noqa: E402
from tarmac.session import local_session, scratch_path  # noqa: E402

# Queries that write their own intermediate files or fit a model: one warm-up, one timed run.
HEAVY = {"model_scores", "stream_scored_quality", "stream_window_quality", "stream_stats_upsert",
         "stream_upsert_rerun", "stream_late_resumed", "csv_scan", "csv_by_name", "stream_sliding_panes",
         "stream_deduplicated", "stream_without_model", "paced_windows", "chained_payloads", "open_windows_in_state",
         "results_by_name", "results_or_nothing", "saved_user_index", "classifier_predictions", "observed_training_set"}


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def median_of(fn, repeat: int) -> float:
    fn()  # warm-up
    return statistics.median(timed(fn) for _ in range(repeat))


def comparisons(spark, sf_dir: str, repeat: int) -> dict:
    from tarmac.operators.metrics import contrast, group_stats
    from tarmac.operators.windows import window_stats
    from tarmac.plans.prep import LINEITEM_SCHEMA
    from tarmac.plans.streams import run_quality_stream, run_stats_stream
    from tarmac.plans.tables import LINEITEM_MEASURES, lineitem, returned
    from tarmac.roles import WindowSpec
    from tarmac.sources.events import decode_events, encode_events
    from tarmac.sources.tables import read_table

    out = {}
    li = lineitem(spark, sf_dir)

    # 1. contrast: one pass vs two filtered scans (same numbers)
    def two_scans():
        for pred in (returned(), ~returned()):
            run_noop(li.filter(pred).agg(*[F.round(F.avg(m), 2) for m in LINEITEM_MEASURES]))

    out["contrast_one_pass_sec"] = round(median_of(lambda: run_noop(contrast(li, returned(), LINEITEM_MEASURES)),
                                                   repeat), 3)
    out["contrast_two_scans_sec"] = round(median_of(two_scans, repeat), 3)

    # 1b. delay counts for three keys: one GROUPING SETS pass vs three aggregates
    from tarmac.operators.metrics import count_by, count_by_dimensions

    li_m = li.withColumn("month", F.month("l_shipdate"))
    keys = ["month", "l_suppkey", "l_linestatus"]

    def three_passes():
        for k in keys:
            run_noop(count_by(li_m, k, returned()))

    out["counts_one_pass_sec"] = round(median_of(lambda: run_noop(count_by_dimensions(li_m, keys, returned())),
                                                 repeat), 3)
    out["counts_three_passes_sec"] = round(median_of(three_passes, repeat), 3)

    # 1c. sliding windows (30 days every day): per-pane merge vs copying every row into 30 windows
    from tarmac.operators.windows import window_stats as ws

    spec30 = WindowSpec("30 days", "1 day")
    for method in ("panes", "expand"):
        out[f"sliding_{method}_sec"] = round(median_of(
            lambda method=method: run_noop(ws(li, spec30, "l_returnflag", "l_extendedprice", ts="l_shipdate",
                                              mean_decimals=2, method=method)), repeat), 3)

    # 2. CSV scan vs Parquet for the group statistics query
    csv_dir = scratch_path(spark, "bench-csv")
    li.write.option("header", True).csv(csv_dir)
    csv_df = read_table(spark, csv_dir, LINEITEM_SCHEMA, "csv")
    out["group_stats_csv_sec"] = round(median_of(lambda: run_noop(group_stats(csv_df, "l_suppkey", "l_quantity")),
                                                 repeat), 3)
    out["group_stats_parquet_sec"] = round(median_of(lambda: run_noop(group_stats(li, "l_suppkey", "l_quantity")),
                                                     repeat), 3)

    # 3. full vs reduced JSON schema for a window statistics query
    json_dir = scratch_path(spark, "bench-json")
    wire = LINEITEM_SCHEMA
    encode_events(li, wire).write.text(json_dir)
    raw = spark.read.text(json_dir)
    spec = WindowSpec("30 days")

    def win(columns):
        d = decode_events(raw, wire, columns=columns)
        return run_noop(window_stats(d, spec, "l_returnflag", "l_quantity", ts="l_shipdate"))

    out["json_full_schema_sec"] = round(median_of(lambda: win(None), repeat), 3)
    out["json_reduced_schema_sec"] = round(median_of(lambda: win(["l_shipdate", "l_returnflag", "l_quantity"]),
                                                     repeat), 3)

    from tarmac.plans.streams import stage_events

    n_events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    t_append = timed(lambda: run_quality_stream(spark, sf_dir, stage_events(spark, sf_dir, "bench-append", 10)))
    t_update = timed(lambda: run_stats_stream(spark, sf_dir, stage_events(spark, sf_dir, "bench-update", 10)))
    out["stream_append_rows_per_sec"] = round(n_events / t_append, 1)
    out["stream_update_rows_per_sec"] = round(n_events / t_update, 1)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]
    ckpt = tempfile.mkdtemp(prefix="tarmac-bench-ckpt-")
    spark = local_session(cpus, shuffle_partitions=max(2 * cpus, 8), app="tarmac-bench",
                          extra={"spark.checkpoint.dir": ckpt})
    results, runs = {}, {}
    for name, q in all_queries().items():
        if only and name not in only:
            continue
        fn = (lambda q=q: run_noop(q.fn(spark, sf_dir)))
        if name in HEAVY:
            fn()  # warm-up
            results[name] = round(timed(fn), 3)
            runs[name] = 1
        else:
            results[name] = round(median_of(fn, repeat), 3)
            runs[name] = repeat
    extras = {} if only else comparisons(spark, sf_dir, repeat)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    line = {
        "metric": "total_query_sec",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "headline_sec": round(sum(v for k, v in results.items() if all_queries()[k].headline), 3),
        "comparisons": extras,
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
