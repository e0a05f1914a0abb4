"""Event-time window statistics (AGG10, AGG11, PRJ13, STR1, STR2, STR10).

The same functions run on batch tables and on streaming DataFrames; on a
stream, the aggregation state lives in the state store and is evicted by the
watermark. Columns are pruned to what the aggregate needs *before* the window
is assigned.

A sliding window puts each row into ``duration / slide`` windows. On batch
frames the default plan aggregates once per *pane* (a slice of
``gcd(duration, slide)``) and then merges the pane aggregates into the
windows that contain them, so only one small row per pane and key is copied
instead of every input row. Counts, sums, minima and maxima merge exactly,
the mean of a fixed-point measure from decimal pane sums. On a stream
``method="panes"`` chains two stateful aggregates in append mode: a pane goes on to its windows
when the watermark closes it, and windows close by the same watermark. The state then
holds each row's pane once instead of each of its windows. A row that is too late for its
pane is dropped, while the expanded form would still count it in the windows that are open. Variances merge
from pane counts, means and squared deviations by the parallel-variance
formula, which does not cancel.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.scalar import exact_mean, percent, window_bounds
from tarmac.roles import WindowSpec, col_of
from tarmac.schema import PLACE_COL, QUALITY_COLUMNS

StrOrCol = str | Column


def _with_watermark(df: DataFrame, ts: str, watermark: str | None) -> DataFrame:
    # On a batch frame withWatermark is a no-op; on a stream it bounds state.
    return df.withWatermark(ts, watermark) if watermark else df


def _use_panes(df: DataFrame, spec: WindowSpec, method: str, exact: bool = True) -> bool:
    """Whether to aggregate per pane. ``exact`` says whether every aggregate
    merges without loss; ``auto`` only uses panes then."""
    if method not in ("auto", "panes", "expand"):
        raise ValueError("method must be 'auto', 'panes' or 'expand'")
    if method == "expand" or not spec.is_sliding:
        return False
    if df.isStreaming:
        return method == "panes"
    return method == "panes" or exact


def _pane(spec: WindowSpec) -> str:
    return f"{math.gcd(spec.duration_seconds, spec.slide_seconds)} seconds"


def _merge_window(spec: WindowSpec, panes: DataFrame) -> Column:
    # Every window that contains an instant of a pane contains the whole pane (both
    # are aligned to the pane width), so Spark's own window assignment applied
    # to the pane start gives exactly the windows the pane belongs to. On a stream it is
    # applied to the pane's event time (its last instant), which carries the watermark on
    # to this second aggregate.
    return spec.column(F.window_time("pane") if panes.isStreaming else F.col("pane.start")).alias("window")


def _merge_spread(a: Column, b: Column) -> Column:
    """Count, mean and sum of squared deviations of two disjoint parts together."""
    n, delta = a["n"] + b["n"], b["mean"] - a["mean"]
    return F.struct(n.alias("n"), (a["mean"] + delta * b["n"] / n).alias("mean"),
                    (a["m2"] + b["m2"] + delta * delta * a["n"] * b["n"] / n).alias("m2"))


def window_stats(df: DataFrame, spec: WindowSpec, key: str, measure: str, ts: str = "timestamp",
                 scale: int = 2, watermark: str | None = None, mean_decimals: int | None = None,
                 method: str = "auto") -> DataFrame:
    """Rounded min/max/mean/sample-stddev and non-NULL count of ``measure``
    per window and ``key``.

    Output: ``window`` struct, ``key``, ``min_value``, ``max_value``,
    ``avg_value``, ``std_value``, ``count``. ``mean_decimals`` selects the
    exact fixed-point mean (see :func:`exact_mean`). ``method``: ``"auto"``,
    ``"panes"`` or ``"expand"`` (copy each row into its windows, as Spark's
    ``window`` does). ``auto`` expands on a stream and aggregates sliding windows of a batch frame
    per pane when ``mean_decimals`` is given: pane sums are then exact
    decimals, so the mean merges without loss. For plain doubles it keeps
    Spark's expanded form, whose sums add up in input order; ``"panes"``
    forces the pane form anyway.
    """
    m = F.col(measure)
    pruned = df.select(ts, key, measure) if measure != key else df.select(ts, key)
    pruned = _with_watermark(pruned, ts, watermark)
    if not _use_panes(df, spec, method, exact=mean_decimals is not None):
        return pruned.groupBy(spec.column(ts).alias("window"), F.col(key)).agg(
            F.round(F.min(m), scale).alias("min_value"),
            F.round(F.max(m), scale).alias("max_value"),
            F.round(exact_mean(m, mean_decimals), scale).alias("avg_value"),
            F.round(F.stddev_samp(m), scale).alias("std_value"),
            F.count(m).alias("count"),
        )
    # Fixed-point measures: exact decimal sums. Doubles: plain sums.
    x = m.cast(f"decimal(28,{mean_decimals})") if mean_decimals is not None else m.cast("double")
    panes = pruned.groupBy(F.window(ts, _pane(spec)).alias("pane"), F.col(key)).agg(
        F.min(m).alias("p_min"), F.max(m).alias("p_max"), F.count(m).alias("p_n"), F.sum(x).alias("p_sum"),
        F.avg(m.cast("double")).alias("p_mean"), (F.var_pop(m) * F.count(m)).alias("p_m2"),
    )
    # A window's list holds one entry per pane, at most duration / pane width of them.
    spread = F.struct(F.col("p_n").cast("double").alias("n"), F.col("p_mean").alias("mean"), F.col("p_m2").alias("m2"))
    merged = panes.groupBy(_merge_window(spec, panes), F.col(key)).agg(
        F.min("p_min").alias("mn"), F.max("p_max").alias("mx"), F.sum("p_n").alias("n"),
        F.sum("p_sum").alias("s"), F.collect_list(F.when(F.col("p_n") > 0, spread)).alias("parts"),
    )
    n = F.col("n")
    nd = n.cast("double")
    m2 = F.aggregate("parts", F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2")),
                     _merge_spread, lambda t: t["m2"])
    std = F.when(n > 1, F.sqrt(m2 / (nd - F.lit(1.0))))
    return merged.select(
        "window", key,
        F.round(F.col("mn"), scale).alias("min_value"),
        F.round(F.col("mx"), scale).alias("max_value"),
        F.round(F.try_divide(F.col("s").cast("double"), nd), scale).alias("avg_value"),
        F.round(std, scale).alias("std_value"),
        n.alias("count"),
    )


def flatten_window(df: DataFrame, window_col: str = "window", ntz: bool = False) -> DataFrame:
    """Replace the window struct by ``window_start`` / ``window_end`` columns, first."""
    rest = [c for c in df.columns if c != window_col]
    return df.select(*window_bounds(window_col, ntz), *rest)


def window_quality(df: DataFrame, spec: WindowSpec, place: StrOrCol, label: StrOrCol, prediction: StrOrCol,
                   ts: str = "event_timestamp", lat: StrOrCol | None = None, lon: StrOrCol | None = None,
                   watermark: str | None = "3 minutes", place_alias: str = PLACE_COL,
                   scale: int = 2, method: str = "auto") -> DataFrame:
    """Prediction quality per window and place.

    ``total_flights`` counts non-NULL labels; ``actual_delays`` and
    ``predicted_delays_count`` sum label and prediction; a row is correct when
    the int-cast label equals the int-cast prediction (a NULL label is never
    correct); ``accuracy_percent`` is ``correct / total * 100`` rounded, NULL
    for an all-NULL-label window. ``LATITUDE``/``LONGITUDE`` carry the largest
    coordinate seen. ``method`` as in :func:`window_stats` (all of these
    aggregates merge exactly across panes).
    """
    lab, pred = col_of(label), col_of(prediction)
    cols = [F.col(ts), col_of(place).alias(place_alias), lab.alias("_label"), pred.alias("_pred")]
    if lat is not None:
        cols.append(col_of(lat).alias("_lat"))
    if lon is not None:
        cols.append(col_of(lon).alias("_lon"))
    pruned = _with_watermark(df.select(*cols), ts, watermark)
    aggs = [
        F.count("_label").alias("total_flights"),
        F.sum("_label").alias("actual_delays"),
        F.sum("_pred").alias("predicted_delays_count"),
        F.count_if(F.col("_label").cast("int") == F.col("_pred").cast("int")).alias("correct_predictions"),
    ]
    merges = [F.sum(c).alias(c) for c in ("total_flights", "actual_delays", "predicted_delays_count",
                                           "correct_predictions")]
    if lat is not None:
        aggs.append(F.max("_lat").alias("LATITUDE"))
        merges.append(F.max("LATITUDE").alias("LATITUDE"))
    if lon is not None:
        aggs.append(F.max("_lon").alias("LONGITUDE"))
        merges.append(F.max("LONGITUDE").alias("LONGITUDE"))
    if _use_panes(df, spec, method):
        panes = pruned.groupBy(F.window(ts, _pane(spec)).alias("pane"), F.col(place_alias)).agg(*aggs)
        out = panes.groupBy(_merge_window(spec, panes), F.col(place_alias)).agg(*merges)
    else:
        out = pruned.groupBy(spec.column(ts).alias("window"), F.col(place_alias)).agg(*aggs)
    return out.withColumn("accuracy_percent", percent("correct_predictions", "total_flights", scale))


def quality_rows(df: DataFrame, ntz: bool = False, place_alias: str = PLACE_COL) -> DataFrame:
    """The flat result record of :func:`window_quality` (what the sinks write)."""
    flat = flatten_window(df, ntz=ntz)
    cols = [place_alias if c == PLACE_COL else c for c in QUALITY_COLUMNS]
    return flat.select(*[c for c in cols if c in flat.columns])
