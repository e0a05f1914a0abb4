"""Record and result schemas.

The flight record layout and the model's feature lists below are fixed
values that must equal the reference's for producers, consumers and saved
models to interoperate; they are listed plainly, in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: the 27-field flight event record, in wire order -----------
FLIGHT_FIELDS = [
    ("MONTH", "int"),
    ("DAY_OF_WEEK", "int"),
    ("DEP_DEL15", "int"),
    ("DISTANCE_GROUP", "int"),
    ("DEP_BLOCK", "string"),
    ("SEGMENT_NUMBER", "int"),
    ("CONCURRENT_FLIGHTS", "int"),
    ("NUMBER_OF_SEATS", "int"),
    ("CARRIER_NAME", "string"),
    ("AIRPORT_FLIGHTS_MONTH", "int"),
    ("AIRLINE_FLIGHTS_MONTH", "int"),
    ("AIRLINE_AIRPORT_FLIGHTS_MONTH", "int"),
    ("AVG_MONTHLY_PASS_AIRPORT", "int"),
    ("AVG_MONTHLY_PASS_AIRLINE", "int"),
    ("FLT_ATTENDANTS_PER_PASS", "float"),
    ("GROUND_SERV_PER_PASS", "float"),
    ("PLANE_AGE", "int"),
    ("DEPARTING_AIRPORT", "string"),
    ("LATITUDE", "float"),
    ("LONGITUDE", "float"),
    ("PREVIOUS_AIRPORT", "string"),
    ("PRCP", "float"),
    ("SNOW", "float"),
    ("SNWD", "float"),
    ("TMAX", "int"),
    ("AWND", "int"),
    ("timestamp", "timestamp"),
]

# --- fixed values: model inputs, label and decision threshold ----------------
FLIGHT_NUMERIC_FEATURES = [
    "MONTH", "DAY_OF_WEEK", "DISTANCE_GROUP",
    "CONCURRENT_FLIGHTS", "AIRPORT_FLIGHTS_MONTH",
    "AIRLINE_FLIGHTS_MONTH", "AVG_MONTHLY_PASS_AIRPORT",
    "AVG_MONTHLY_PASS_AIRLINE", "PLANE_AGE",
    "TMAX", "AWND", "LATITUDE", "LONGITUDE",
]
FLIGHT_CATEGORICAL_FEATURES = ["CARRIER_NAME", "DEPARTING_AIRPORT"]
FLIGHT_LABEL = "DEP_DEL15"
DEFAULT_THRESHOLD = 0.25
SCORED_OUTPUT_COLUMNS = [
    "event_timestamp", "DEP_DEL15", "predicted_delay",
    "CARRIER_NAME", "DEPARTING_AIRPORT", "LATITUDE", "LONGITUDE",
]
# Weather measures contrasted between delayed and on-time flights.
FLIGHT_WEATHER_MEASURES = ["PRCP", "SNOW", "TMAX", "AWND"]

# --- fixed values: result column names of the reports -------------------------
DELAY_COUNT_COL = "DelayedFlightsNum"
GROUP_COUNT_COL = "total_records"
PREDICTION_COL = "predicted_delay"
PLACE_COL = "airport_name"
# stems of the contrast columns avg_<stem>_delayed / avg_<stem>_on_time
FLIGHT_WEATHER_STEMS = {"PRCP": "prcp", "SNOW": "snow", "TMAX": "temp", "AWND": "wind"}
MONTHLY_WEATHER_ALIASES = {"TMAX": "AvgTMAX", "PRCP": "AvgPRCP"}
CARRIER_FLIGHTS_ALIAS = "AvgMonthlyFlightsPerCarrier"
# fields of the nested statistics record on the wire
STAT_FIELDS = ["min_value", "max_value", "avg_value", "std_value", "count"]
QUALITY_COLUMNS = ["window_start", "window_end", "airport_name", "LATITUDE", "LONGITUDE",
                   "total_flights", "actual_delays", "predicted_delays_count", "accuracy_percent"]
# ------------------------------------------------------------------------------

_TYPES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct_of(fields: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t], True) for n, t in fields])


FLIGHT_SCHEMA = struct_of(FLIGHT_FIELDS)
# The table form carries every field but the producer-stamped ``timestamp``.
# Measures that the wire cuts to whole numbers keep their fraction in a table.
FLIGHT_MEASURES = ("TMAX", "AWND", "FLT_ATTENDANTS_PER_PASS", "GROUND_SERV_PER_PASS", "LATITUDE", "LONGITUDE",
                   "PRCP", "SNOW", "SNWD")
FLIGHT_CSV_SCHEMA = struct_of([(n, "double" if n in FLIGHT_MEASURES else t) for n, t in FLIGHT_FIELDS
                               if n != "timestamp"])

# Result schemas -----------------------------------------------------------

STATISTICS_SCHEMA = T.StructType([
    T.StructField("min_value", T.DoubleType()),
    T.StructField("max_value", T.DoubleType()),
    T.StructField("avg_value", T.DoubleType()),
    T.StructField("std_value", T.DoubleType()),
    T.StructField("count", T.LongType()),
])


def stat_payload_schema(group_type: T.DataType = T.StringType()) -> T.StructType:
    """Schema of the nested JSON statistics record."""
    return T.StructType([
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("group", group_type),
        T.StructField("statistics", STATISTICS_SCHEMA),
    ])


KEYED_STATISTICS_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("group_value", T.StringType()),
    T.StructField("min_value", T.DoubleType()),
    T.StructField("max_value", T.DoubleType()),
    T.StructField("avg_value", T.DoubleType()),
    T.StructField("std_value", T.DoubleType()),
    T.StructField("count", T.LongType()),
])

WINDOW_QUALITY_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("airport_name", T.StringType()),
    T.StructField("LATITUDE", T.DoubleType()),
    T.StructField("LONGITUDE", T.DoubleType()),
    T.StructField("total_flights", T.LongType()),
    T.StructField("actual_delays", T.LongType()),
    T.StructField("predicted_delays_count", T.DoubleType()),
    T.StructField("accuracy_percent", T.DoubleType()),
])
