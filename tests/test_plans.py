"""Physical-plan properties the design relies on (pushdown, pruning, one pass, no cross joins)."""

import re

import pytest

from tables import SF_SMALL
from tarmac.plans.registry import all_queries

QUERIES = all_queries()
BATCH = sorted(n for n in QUERIES if not n.startswith("stream_") and n not in ("model_scores",))


def plan(spark, name):
    df = QUERIES[name].fn(spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def _ops(p):
    """Operator names of a plan string, top-down, ignoring sort-only nodes."""
    out = []
    for line in p.splitlines():
        m = re.match(r"^[\s:+\-|]*([A-Za-z]+)", line)
        if m and m.group(1) not in ("Sort", "AdaptiveSparkPlan", "Project"):
            out.append((m.group(1), line))
    return out


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_and_partial_aggregation(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    # a hash shuffle that feeds an aggregate is fed by an aggregate: map-side combine
    ops = _ops(p)
    for i, (op, line) in enumerate(ops):
        if op == "Exchange" and "hashpartitioning" in line and i > 0 and ops[i - 1][0].endswith("Aggregate"):
            assert i + 1 < len(ops) and ops[i + 1][0].endswith("Aggregate"), (name, line)


def test_top_n_is_take_ordered_over_pruned_pushed_scan(spark):
    p = plan(spark, "top_parts_by_delays")
    assert "TakeOrderedAndProject(limit=10" in p
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in p
    assert "ReadSchema: struct<l_partkey:bigint,l_returnflag:string>" in p


def test_one_pass_forms_scan_once(spark):
    for name in ("label_contrast", "delays_by_dimension", "missing_audit", "class_balance"):
        assert plan(spark, name).count("FileScan") == 1, name
    assert "Expand" in plan(spark, "delays_by_dimension")


def test_sliding_window_prunes_before_expand(spark):
    p = plan(spark, "window_stats_sliding")
    assert "Expand" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in p


def test_dedupe_and_latest_combine_map_side(spark):
    for name in ("latest_place_report", "sorted_results"):
        assert "partial_max" in plan(spark, name) or "partial_min" in plan(spark, name), name


def test_auc_joins_on_buckets(spark):
    p = plan(spark, "holdout_auc")
    assert "CartesianProduct" not in p
    # no forced broadcast: the engine decides by size, the only small side is the per-bucket offsets
    assert p.count("BroadcastExchange") <= 1
