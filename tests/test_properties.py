"""Property tests (hypothesis) for the deterministic operators, against brute force in Python."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tarmac.operators.dedupe import dedupe, latest_by
from tarmac.operators.metrics import count_by, top_n_by

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.integers(0, 5), st.integers(-3, 3)),
                   min_size=1, max_size=40)


@settings(max_examples=15, deadline=None)
@given(rows=rows_st, parts=st.integers(1, 5))
def test_dedupe_and_latest_match_brute_force(spark, rows, parts):
    df = spark.createDataFrame(rows, "k string, t int, v int").repartition(parts)
    got = sorted(tuple(r) for r in latest_by(df, "k", "t").collect())
    want = sorted(max((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2])) for k in {r[0] for r in rows})
    assert got == want
    first = sorted(tuple(r) for r in dedupe(df, ["k"], order=["t"]).collect())
    assert first == sorted(min((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2])) for k in {r[0] for r in rows})


@settings(max_examples=15, deadline=None)
@given(rows=rows_st, n=st.integers(1, 4))
def test_counts_and_top_n_match_brute_force(spark, rows, n):
    df = spark.createDataFrame(rows, "k string, t int, v int")
    label = "v > 0"
    from pyspark.sql import functions as F

    pos = [r for r in rows if r[2] > 0]
    counts = {}
    for r in pos:
        counts[r[0]] = counts.get(r[0], 0) + 1
    got = [tuple(r) for r in count_by(df, "k", F.expr(label)).collect()]
    assert got == sorted(counts.items())
    top = [tuple(r) for r in top_n_by(df, "k", F.expr(label), n=n).collect()]
    assert top == sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:n]


events_st = st.lists(st.tuples(st.integers(0, 3600), st.sampled_from(["x", "y"]), st.integers(0, 9999)),
                     min_size=1, max_size=30)


@settings(max_examples=12, deadline=None)
@given(rows=events_st, dur=st.sampled_from([600, 900]), slide=st.sampled_from([300, 600]),
       method=st.sampled_from(["panes", "expand"]))
def test_window_stats_match_brute_force(spark, rows, dur, slide, method):
    import datetime
    from decimal import ROUND_HALF_UP, Decimal

    from pyspark.sql import functions as F

    from tarmac.operators.windows import flatten_window, window_stats
    from tarmac.roles import WindowSpec

    data = [(datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=t), k, v / 100) for t, k, v in rows]
    df = spark.createDataFrame(data, "ts timestamp_ntz, k string, v double")
    spec = WindowSpec(dur, min(slide, dur))
    got = {(r.window_start, r.k): (r["count"], r.min_value, r.max_value, r.avg_value) for r in
           flatten_window(window_stats(df, spec, "k", "v", ts="ts", mean_decimals=2, method=method)).collect()}
    s = spec.slide_seconds
    want = {}
    for t, k, v in rows:
        last = t - t % s
        start = last
        while start > t - dur:
            want.setdefault((start, k), []).append(Decimal(v) / 100)
            start -= s
    base = datetime.datetime(2024, 1, 1)
    expect = {}
    for (start, k), vals in want.items():
        mean = (sum(vals) / len(vals)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        expect[(base + datetime.timedelta(seconds=start), k)] = (len(vals), float(min(vals)), float(max(vals)),
                                                                 float(mean))
    assert got == expect


quality_st = st.lists(st.tuples(st.integers(0, 1800), st.sampled_from(["A", "B"]),
                                st.sampled_from([0, 1, None]), st.sampled_from([0.0, 1.0])),
                      min_size=1, max_size=30)


@settings(max_examples=12, deadline=None)
@given(rows=quality_st, method=st.sampled_from(["panes", "expand"]))
def test_window_quality_match_brute_force(spark, rows, method):
    import datetime

    from tarmac.operators.windows import quality_rows, window_quality
    from tarmac.roles import WindowSpec

    base = datetime.datetime(2024, 1, 1)
    data = [(base + datetime.timedelta(seconds=t), p, y, pr) for t, p, y, pr in rows]
    df = spark.createDataFrame(data, "ts timestamp_ntz, place string, y int, pr double")
    got = {(r.window_start, r.airport_name): (r.total_flights, r.actual_delays, r.predicted_delays_count,
                                               r.accuracy_percent)
           for r in quality_rows(window_quality(df, WindowSpec(600, 300), "place", "y", "pr", ts="ts",
                                                watermark=None, method=method)).collect()}
    groups = {}
    for t, p, y, pr in rows:
        start = t - t % 300
        for w in (start, start - 300):
            groups.setdefault((base + datetime.timedelta(seconds=w), p), []).append((y, pr))
    expect = {}
    for key, vals in groups.items():
        labelled = [y for y, _ in vals if y is not None]
        correct = sum(1 for y, pr in vals if y is not None and y == int(pr))
        acc = round(correct / len(labelled) * 100, 2) if labelled else None
        expect[key] = (len(labelled), sum(labelled) if labelled else None, sum(pr for _, pr in vals), acc)
    assert got == expect
