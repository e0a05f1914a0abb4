"""Batch window queries on ``events`` (AGG10, AGG11, STR1, STR2, PRJ13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.operators.windows import flatten_window, quality_rows, window_quality, window_stats
from tarmac.plans.registry import register, sql_round
from tarmac.plans.tables import events, is_error
from tarmac.roles import WindowSpec

# events.value is a 2-decimal fixed-point reading: means are summed exactly.
VALUE_DECIMALS = 2
TUMBLING = WindowSpec("1 hour")
SLIDING = WindowSpec("1 hour", "10 minutes")
QUALITY = WindowSpec("30 minutes", "5 minutes")


def sql_windowed(source: str, ts: str, spec: WindowSpec) -> str:
    """SQL expanding each row of ``source`` into its windows (``window_start``,
    ``window_end``), aligned to the epoch like Spark's ``window``."""
    d, s = spec.duration_seconds, spec.slide_seconds
    n = spec.copies_per_row
    start = f"time_bucket(INTERVAL '{s} seconds', {ts}, TIMESTAMP '1970-01-01') - k * INTERVAL '{s} seconds'"
    return f"""
    SELECT src.*, {start} AS window_start, {start} + INTERVAL '{d} seconds' AS window_end
    FROM ({source}) src, range(0, {n}) r(k)
    WHERE {ts} >= {start} AND {ts} < {start} + INTERVAL '{d} seconds'"""


def _stats_sql(spec: WindowSpec, scale: int = 2) -> str:
    return f"""
SELECT window_start, window_end, event_type,
       {sql_round('min(value)', scale)} AS min_value,
       {sql_round('max(value)', scale)} AS max_value,
       {sql_round('sum(value::DECIMAL(28,2))::DOUBLE / count(value)', scale)} AS avg_value,
       {sql_round('stddev_samp(value)', scale)} AS std_value,
       count(value) AS count
FROM ({sql_windowed('SELECT ts, event_type, value FROM events', 'ts', spec)})
GROUP BY 1, 2, 3"""


@register("window_stats_tumbling", ("AGG10", "STR1", "PRJ13"), headline=True, sql=_stats_sql(TUMBLING))
def window_stats_tumbling(spark, sf_dir):
    return flatten_window(window_stats(events(spark, sf_dir), TUMBLING, "event_type", "value", ts="ts",
                                       mean_decimals=VALUE_DECIMALS))


@register("window_stats_sliding", ("AGG10", "STR2", "STR10"), headline=True, sql=_stats_sql(SLIDING))
def window_stats_sliding(spark, sf_dir):
    return flatten_window(window_stats(events(spark, sf_dir), SLIDING, "event_type", "value", ts="ts",
                                       mean_decimals=VALUE_DECIMALS))


@register("window_stats_sliding_6", ("AGG10", "STR2"), sql=_stats_sql(SLIDING, 6))
def window_stats_sliding_6(spark, sf_dir):
    """The sliding statistics to six places: what the merged panes give beyond two."""
    return flatten_window(window_stats(events(spark, sf_dir), SLIDING, "event_type", "value", ts="ts", scale=6,
                                       mean_decimals=VALUE_DECIMALS))


QUALITY_SOURCE = """SELECT ts, user_id::VARCHAR AS airport_name,
       (event_type = 'error')::INTEGER AS label,
       (value > 50)::INTEGER::DOUBLE AS pred, value AS lat, event_id::DOUBLE AS lon FROM events"""


def quality_sql(spec: WindowSpec, extra_where: str = "", source: str = QUALITY_SOURCE) -> str:
    return f"""
SELECT window_start, window_end, airport_name,
       max(lat) AS LATITUDE, max(lon) AS LONGITUDE,
       count(label) AS total_flights,
       sum(label)::BIGINT AS actual_delays,
       sum(pred) AS predicted_delays_count,
       {sql_round('sum(CASE WHEN label = pred::INTEGER THEN 1 ELSE 0 END)::DOUBLE / count(label) * 100')}
           AS accuracy_percent
FROM ({sql_windowed(source, 'ts', spec)})
{extra_where}
GROUP BY 1, 2, 3"""


def quality_input(df):
    """Events in the scored-row shape: place, 0/1 label, 0/1 prediction, coordinates."""
    return df.select(
        F.col("ts"),
        F.col("user_id").cast("string").alias("place"),
        is_error().cast("int").alias("label"),
        (F.col("value") > 50).cast("int").cast("double").alias("pred"),
        F.col("value").alias("lat"),
        F.col("event_id").cast("double").alias("lon"),
    )


@register("window_quality", ("AGG11", "STR2"), headline=True, sql=quality_sql(QUALITY))
def window_quality_batch(spark, sf_dir):
    scored = quality_input(events(spark, sf_dir))
    q = window_quality(scored, QUALITY, "place", "label", "pred", ts="ts", lat="lat", lon="lon", watermark=None)
    return quality_rows(q)
