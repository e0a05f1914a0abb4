"""Per-place report over windowed quality results (SET3, SET4, SRT1, PRJ17, PRJ18).

The reference draws this on a map; we build the table the map is drawn from:
the latest window per place, its point and a marker size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.scalar import geo_point, marker_size
from tarmac.operators.dedupe import dedupe, latest_by
from tarmac.schema import PLACE_COL


def clean_results(df: DataFrame, keys=("window_start", "window_end", PLACE_COL),
                  order_by: str = "window_end") -> DataFrame:
    """Drop repeated result rows (replays, overlapping batches) and sort by time."""
    return dedupe(df, list(keys)).orderBy(order_by, *[k for k in keys if k != order_by])


def place_report(df: DataFrame, place: str = PLACE_COL, ts: str = "window_end",
                 lat: str = "LATITUDE", lon: str = "LONGITUDE", total: str = "total_flights") -> DataFrame:
    """Latest result row per place, with ``geometry`` (lon, lat) and ``marker_size``."""
    latest = latest_by(df, place, ts)
    return latest.withColumn("geometry", geo_point(lon, lat)).withColumn("marker_size", marker_size(total))


def flat_points(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Expose the point struct as ``point_lon`` / ``point_lat`` columns."""
    return df.withColumn("point_lon", F.col(f"{geometry}.lon")).withColumn(
        "point_lat", F.col(f"{geometry}.lat")).drop(geometry)
