"""The flight-delay applications, composed from the library with the flight
record's column roles and result names as defaults.

* :func:`delay_report` -- batch analysis of a flight table (profile, missing
  values, delay counts and rankings, grouped statistics, weather contrast).
* :func:`window_statistics_stream` -- filtered, windowed statistics of an event
  stream as JSON payloads, plus :func:`statistics_table_writer` for the keyed table.
* :func:`train_delay_model` -- balanced training and evaluation of the classifier.
* :func:`predict_stream` -- stream scoring with windowed prediction quality.
* :func:`prediction_report` -- per-airport report from the written results.

Each returns DataFrames (lazy) or starts a streaming query; nothing is
collected beyond one-row scalars.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.scalar import event_time_of
from tarmac.ml.model import TrainResult, score, train_model
from tarmac.operators import metrics as M
from tarmac.operators.clean import prepare_features
from tarmac.operators.profile import missing_audit, profile, schema_table
from tarmac.operators.report import clean_results, place_report
from tarmac.operators.windows import quality_rows, window_quality, window_stats
from tarmac.roles import WindowSpec
from tarmac.schema import (
    CARRIER_FLIGHTS_ALIAS,
    FLIGHT_CATEGORICAL_FEATURES,
    FLIGHT_LABEL,
    FLIGHT_NUMERIC_FEATURES,
    FLIGHT_WEATHER_MEASURES,
    FLIGHT_WEATHER_STEMS,
    KEYED_STATISTICS_SCHEMA,
    MONTHLY_WEATHER_ALIASES,
    PLACE_COL,
    PREDICTION_COL,
    SCORED_OUTPUT_COLUMNS,
    WINDOW_QUALITY_SCHEMA,
)
from tarmac.sinks.payload import from_stat_json, to_stat_json
from tarmac.sinks.writers import save_model, upsert_writer
from tarmac.sources.results import read_results
from tarmac.streaming.runner import with_event_time


def delay_report(df: DataFrame, month: int | None = None, carrier: str | None = None,
                 stats_col: str | None = "PLANE_AGE", group_by_col: str | None = "CARRIER_NAME",
                 label: str = FLIGHT_LABEL, top_n: int = 10, preview_rows: int = 10,
                 spark: SparkSession | None = None) -> dict[str, DataFrame]:
    """All outputs of the batch analysis, by name.

    Each entry is an independent job over ``df``; stage a CSV input as
    Parquet first (``sources.tables.stage_parquet``) so every job gets column
    pruning and filter pushdown instead of re-parsing text.
    """
    out: dict[str, DataFrame] = {
        "profile": profile(df),
        "preview": df.limit(preview_rows),
        "missing_values": missing_audit(df),
        "delays_per_month": M.count_by(df, "MONTH", label),
        "delays_per_carrier": M.count_by(df, "CARRIER_NAME", label),
        "top_delay_airports": M.top_n_by(df, "DEPARTING_AIRPORT", label, n=top_n),
    }
    if spark is not None:
        out["schema"] = schema_table(spark, df)
    if month is not None:
        in_month = [F.col("MONTH") == F.lit(month)]
        out["delays_in_month"] = M.count_by(df, "MONTH", label, where=in_month)
        out["carrier_delays_in_month"] = M.count_by(df, "CARRIER_NAME", label, where=in_month)
    if carrier is not None:
        out["carrier_delays_per_month"] = M.count_by(df, "MONTH", label,
                                                      where=[F.col("CARRIER_NAME") == F.lit(carrier)])
    if stats_col and group_by_col:
        out["group_statistics"] = M.group_stats(df, group_by_col, stats_col)
    out["airport_passengers"] = M.summary(df, "AVG_MONTHLY_PASS_AIRPORT")
    out["delay_weather_by_month"] = M.avg_by_period(df, "MONTH", ["TMAX", "PRCP"], label,
                                                    aliases=MONTHLY_WEATHER_ALIASES)
    out["carrier_flights_per_airport"] = M.avg_by_keys(df, ["DEPARTING_AIRPORT", "CARRIER_NAME"],
                                                       "AIRLINE_FLIGHTS_MONTH", n=top_n,
                                                       alias=CARRIER_FLIGHTS_ALIAS)
    out["weather_impact"] = M.contrast(df, label, FLIGHT_WEATHER_MEASURES, stems=FLIGHT_WEATHER_STEMS)
    return out


def window_statistics_stream(events: DataFrame, window: WindowSpec, group_by: str, target_col: str = FLIGHT_LABEL,
                             filters: Iterable[str] = (), ts: str = "timestamp",
                             watermark: str | None = "10 minutes") -> DataFrame:
    """Decoded flight events -> filters -> windowed statistics -> JSON ``value``
    (ready for a topic sink or :func:`statistics_table_writer`). Run in
    ``update`` mode; the watermark bounds the window state."""
    filtered = M.apply_filters(events, filters)
    timed = with_event_time(filtered, ts, watermark)
    return to_stat_json(window_stats(timed, window, group_by, target_col, ts=ts), group_by)


def statistics_table_writer(path: str, spark: SparkSession | None = None, reset: bool = False):
    """``foreachBatch`` writer of statistics payloads into the keyed table
    (key: window start and group value; the latest batch wins)."""
    return upsert_writer(path, ["window_start", "group_value"], transform=from_stat_json, spark=spark,
                         reset_schema=KEYED_STATISTICS_SCHEMA if reset else None)


def train_delay_model(df: DataFrame, model_path: str | None = None, classifier="gbt", threshold: float = 0.25,
                      key: str | None = None, numeric: Sequence[str] = FLIGHT_NUMERIC_FEATURES,
                      categorical: Sequence[str] = FLIGHT_CATEGORICAL_FEATURES,
                      label: str = FLIGHT_LABEL) -> tuple[TrainResult, DataFrame]:
    """Balanced 3:1 training on an 80 % hash split, threshold, hold-out AUC and
    weighted F1; saves the model when ``model_path`` is given."""
    result, scored = train_model(df, numeric, categorical, label, key, classifier=classifier, threshold=threshold)
    if model_path:
        save_model(result.model, model_path)
    return result, scored


def predict_stream(events: DataFrame, model, window: WindowSpec, ts: str = "timestamp",
                   watermark: str = "3 minutes", on_missing: str = "sentinel", numeric: Sequence[str] = FLIGHT_NUMERIC_FEATURES,
                   categorical: Sequence[str] = FLIGHT_CATEGORICAL_FEATURES) -> DataFrame:
    """Decoded flight events -> shared feature preparation -> model scores ->
    windowed prediction quality per airport (flat result rows; run in
    ``append`` mode). A missing model yields predictions of -1 with the same
    schema, or an error with ``on_missing="error"``."""
    timed = events.withColumn("event_timestamp", event_time_of(events, ts))
    prepared = prepare_features(timed, numeric, categorical)
    scored = score(prepared, model, SCORED_OUTPUT_COLUMNS, on_missing=on_missing)
    quality = window_quality(scored, window, "DEPARTING_AIRPORT", FLIGHT_LABEL, PREDICTION_COL,
                             ts="event_timestamp", lat="LATITUDE", lon="LONGITUDE", watermark=watermark)
    return quality_rows(quality)


def prediction_report(spark: SparkSession, output_dir: str) -> dict[str, DataFrame]:
    """Results written per batch -> deduplicated, time-ordered rows, the
    sorted list and count of airports, and the latest row per airport with
    its point and marker size."""
    rows = clean_results(read_results(spark, output_dir, WINDOW_QUALITY_SCHEMA, key_as_string=PLACE_COL))
    return {
        "results": rows,
        "airports": M.distinct_values(rows, PLACE_COL),
        "airport_count": M.distinct_count(rows, PLACE_COL),
        "latest_by_airport": place_report(rows),
    }
