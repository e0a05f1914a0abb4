"""Result reporting queries (SET3, SET4, SRT1, PRJ17, PRJ18)."""

from __future__ import annotations

from tarmac.operators.report import clean_results, flat_points, place_report
from tarmac.operators.windows import quality_rows, window_quality
from tarmac.plans.registry import register
from tarmac.plans.tables import events
from tarmac.plans.windows import QUALITY, quality_input, quality_sql


def _quality(spark, sf_dir):
    scored = quality_input(events(spark, sf_dir))
    q = window_quality(scored, QUALITY, "place", "label", "pred", ts="ts", lat="lat", lon="lon", watermark=None)
    return quality_rows(q)


@register("latest_place_report", ("SET4", "PRJ17", "PRJ18"), sql=f"""
SELECT window_start, window_end, airport_name, LATITUDE, LONGITUDE, total_flights, actual_delays,
       predicted_delays_count, accuracy_percent,
       greatest(50.0, total_flights / 5.0) AS marker_size,
       LONGITUDE AS point_lon, LATITUDE AS point_lat
FROM ({quality_sql(QUALITY)})
QUALIFY row_number() OVER (PARTITION BY airport_name ORDER BY window_end DESC) = 1
""")
def latest_place_report(spark, sf_dir):
    return flat_points(place_report(_quality(spark, sf_dir)))


@register("sorted_results", ("SET1", "SET3", "SRT1"), sql=f"SELECT * FROM ({quality_sql(QUALITY)}) ORDER BY window_end")
def sorted_results(spark, sf_dir):
    results = _quality(spark, sf_dir).checkpoint()  # aggregated once, like a written result
    return clean_results(results.unionByName(results))  # every row delivered twice
