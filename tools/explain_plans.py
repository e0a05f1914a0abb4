"""Summarise the physical plan of every registered batch query into PLANS.md.

    python tools/explain_plans.py [sf_dir] > PLANS.md

For each query: scans and the columns they read, filters pushed into the
scan, shuffles by kind, broadcasts, whether aggregates are combined map-side,
top-N, Expand and Window operators. Streaming and model-fitting queries run
jobs when called and are described in the README instead.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SKIP = {"stream_window_quality", "stream_stats_upsert", "stream_scored_quality", "stream_upsert_rerun", "stream_late_resumed",
        "csv_by_name", "model_scores", "csv_scan", "stream_sliding_panes", "stream_deduplicated", "stream_without_model",
        "paced_windows", "chained_payloads", "open_windows_in_state", "results_by_name", "results_or_nothing", "saved_user_index",
        "classifier_predictions", "observed_training_set"}


def facts(plan: str) -> dict:
    reads = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    pushed = [p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if p]
    ex = re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", plan)
    kinds = {}
    for k in ex:
        kinds[k] = kinds.get(k, 0) + 1
    return {
        "scans": plan.count("FileScan"),
        "columns read": "; ".join(r.replace(":", " ") for r in reads) or "-",
        "pushed filters": "; ".join(pushed) or "-",
        "shuffles": ", ".join(f"{v}x {k}" for k, v in kinds.items()) or "none",
        "broadcasts": plan.count("BroadcastExchange"),
        "map-side combine": "yes" if "partial_" in plan or re.search(r"Aggregate\(keys=\[[^\]]+\], functions=\[\]", plan)
        else ("n/a" if "Aggregate" not in plan else "no"),
        "top-N": "yes" if "TakeOrderedAndProject" in plan else "-",
        "other": ", ".join(op for op in ("Expand", "Window", "SortAggregate", "BroadcastHashJoin", "Generate")
                           if op in plan) or "-",
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from tarmac.plans.registry import all_queries
    from tarmac.session import local_session

    spark = local_session(8, 8, extra={"spark.sql.maxMetadataStringLength": "2000"})
    queries = all_queries()
    print("# Physical plans of the registered batch queries\n")
    print(f"Generated by `tools/explain_plans.py` on `{sf_dir}` (initial adaptive plan; AQE may coalesce "
          "partitions or switch joins at run time). Streaming and model-fitting queries are described in the "
          "README.\n")
    cols = ["query", "ids", "scans", "columns read", "pushed filters", "shuffles", "broadcasts", "map-side combine",
            "top-N", "other"]
    print("| " + " | ".join(cols) + " |")
    print("| " + " | ".join("---" for _ in cols) + " |")
    for name, q in queries.items():
        if name in SKIP:
            continue
        plan = q.fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        f = facts(plan)
        row = [f"`{name}`", ", ".join(q.ids)] + [str(f[c]) for c in cols[2:]]
        print("| " + " | ".join(x.replace("|", "/") for x in row) + " |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
