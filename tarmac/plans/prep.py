"""Cleaning and JSON queries (SRC1, SRC5, PRJ2-PRJ8, PRJ15, PRJ16)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.scalar import instant_to_ntz
from tarmac.operators.clean import coerce_rows, prepare_features
from tarmac.plans.registry import register
from tarmac.plans.tables import events, lineitem
from tarmac.schema import FLIGHT_FIELDS, FLIGHT_SCHEMA
from tarmac.session import scratch_path
from tarmac.sources.events import decode_events, encode_events
from tarmac.sources.tables import read_table

LINEITEM_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()),
    T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()),
    T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()),
    T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()),
    T.StructField("l_tax", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()),
    T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_shipdate", T.TimestampNTZType()),
])


@register("scan_with_schema", ("SRC1", "SRC2"), sql="SELECT * FROM lineitem")
def scan_with_schema(spark, sf_dir):
    return read_table(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet", schema=LINEITEM_SCHEMA)


@register("csv_scan", ("SRC1", "SRC2"), sql="SELECT * FROM lineitem")
def csv_scan(spark, sf_dir):
    """lineitem staged as header CSV (a Spark write under the shared checkpoint
    dir), then read back with the declared schema instead of inference."""
    path = scratch_path(spark, "csv")
    lineitem(spark, sf_dir).write.option("header", True).csv(path)
    return read_table(spark, path, schema=LINEITEM_SCHEMA, fmt="csv")


@register("csv_by_name", ("SRC1", "PRJ15"), sql="SELECT * FROM lineitem")
def csv_by_name(spark, sf_dir):
    """lineitem staged as CSV with its columns in another order and whole numbers
    written as ``17.0``, then bound by header name and coerced."""
    path = scratch_path(spark, "csv-by-name")
    li = lineitem(spark, sf_dir)
    text = [F.concat(F.col(f.name).cast("string"), F.lit(".0")).alias(f.name)
            if isinstance(f.dataType, (T.IntegerType, T.LongType)) else F.col(f.name) for f in LINEITEM_SCHEMA.fields]
    li.select(*text[5:], *reversed(text[:5])).write.option("header", True).csv(path)
    return read_table(spark, path, schema=LINEITEM_SCHEMA, fmt="csv")


@register("json_round_trip", ("SRC5", "PRJ2", "PRJ3", "PRJ16"), headline=True, sql="SELECT * FROM lineitem")
def json_round_trip(spark, sf_dir):
    """lineitem -> typed JSON events (ship date as epoch seconds) -> decoded rows."""
    wire = T.StructType([f if f.name != "l_shipdate" else T.StructField("l_shipdate", T.TimestampType())
                         for f in LINEITEM_SCHEMA.fields])
    encoded = encode_events(lineitem(spark, sf_dir), wire, ts_col="l_shipdate", ts_name="l_shipdate")
    decoded = decode_events(encoded, wire)
    return decoded.withColumn("l_shipdate", instant_to_ntz("l_shipdate"))


@register("props_decode", "PRJ2", sql="""
SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS k FROM events
""")
def props_decode(spark, sf_dir):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return decode_events(events(spark, sf_dir), schema, value_col="props", keep=["event_id"])


@register("prepared_features", ("PRJ4", "PRJ5", "PRJ6", "PRJ7", "PRJ8"), sql="""
SELECT l_orderkey,
       l_linenumber::DOUBLE AS l_linenumber,
       l_quantity,
       coalesce(nullif(l_tax, 0.0), 0.0) AS l_tax,
       coalesce(nullif(l_linestatus, 'O'), 'N/A') AS l_linestatus,
       (CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END)::INTEGER AS label
FROM lineitem WHERE l_returnflag IN ('R', 'A')
""")
def prepared_features(spark, sf_dir):
    raw = lineitem(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        F.nullif("l_linestatus", F.lit("O")).alias("l_linestatus"),
        # label arrives as text; 'N' rows have no label
        F.when(F.col("l_returnflag") == "R", "1").when(F.col("l_returnflag") == "A", "0").alias("label"),
    )
    return prepare_features(raw, numeric=["l_linenumber", "l_quantity", "l_tax"], categorical=["l_linestatus"],
                            label="label", drop_null_label=True)


@register("coerced_rows", "PRJ15", sql="""
SELECT l_orderkey,
       trunc(l_quantity)::INTEGER AS l_quantity,
       trunc(l_extendedprice)::INTEGER AS l_extendedprice,
       l_discount,
       nullif(l_tax, 0.0) AS l_tax,
       l_returnflag
FROM lineitem
""")
def coerced_rows(spark, sf_dir):
    """Raw text rows (as a CSV read without inference yields) coerced to types."""
    raw = lineitem(spark, sf_dir).select(
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        F.col("l_quantity").cast("string").alias("l_quantity"),
        F.col("l_extendedprice").cast("string").alias("l_extendedprice"),
        F.col("l_discount").cast("string").alias("l_discount"),
        F.coalesce(F.nullif("l_tax", F.lit(0.0)).cast("string"), F.lit("")).alias("l_tax"),
        "l_returnflag",
    )
    target = T.StructType([
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_quantity", T.IntegerType()),
        T.StructField("l_extendedprice", T.IntegerType()),
        T.StructField("l_discount", T.DoubleType()),
        T.StructField("l_tax", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()),
    ])
    return coerce_rows(raw, target)


# What each field of the 27-field record is taken from, as SQL that both engines read alike.
FLIGHT_FROM_LINEITEM = {
    "MONTH": "month(l_shipdate)", "DAY_OF_WEEK": "l_linenumber", "DEP_DEL15": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
    "DISTANCE_GROUP": "l_linenumber", "DEP_BLOCK": "l_linestatus", "SEGMENT_NUMBER": "l_linenumber",
    "CONCURRENT_FLIGHTS": "l_quantity", "NUMBER_OF_SEATS": "l_partkey", "CARRIER_NAME": "l_suppkey",
    "AIRPORT_FLIGHTS_MONTH": "l_suppkey", "AIRLINE_FLIGHTS_MONTH": "l_partkey", "AIRLINE_AIRPORT_FLIGHTS_MONTH": "l_suppkey",
    "AVG_MONTHLY_PASS_AIRPORT": "l_extendedprice", "AVG_MONTHLY_PASS_AIRLINE": "l_quantity",
    "FLT_ATTENDANTS_PER_PASS": "l_tax", "GROUND_SERV_PER_PASS": "l_discount", "PLANE_AGE": "nullif(l_linenumber, 7)",
    "DEPARTING_AIRPORT": "l_partkey", "LATITUDE": "l_discount", "LONGITUDE": "l_tax", "PREVIOUS_AIRPORT": "l_returnflag",
    "PRCP": "l_discount", "SNOW": "l_tax", "SNWD": "l_discount", "TMAX": "l_quantity", "AWND": "l_linenumber",
}
_SQL_TYPE = {"int": "BIGINT", "float": "FLOAT", "string": "VARCHAR"}


def _flight_field_sql(name: str, kind: str) -> str:
    if kind == "timestamp":
        return f"l_shipdate AS {name}"
    expr = f"trunc({FLIGHT_FROM_LINEITEM[name]})" if kind == "int" else f"({FLIGHT_FROM_LINEITEM[name]})"
    return f"{expr}::{_SQL_TYPE[kind]}{'::DOUBLE' if kind == 'float' else ''} AS {name}"


@register("flight_records", ("PRJ1", "PRJ2", "PRJ3", "PRJ15"), sql=f"""
SELECT l_orderkey, {', '.join(_flight_field_sql(n, k) for n, k in FLIGHT_FIELDS)} FROM lineitem
""")
def flight_records(spark, sf_dir):
    """Whole lineitem as raw text in the shape of the 27-field flight record, encoded by its schema
    and decoded again: whole-number fields hold fractions as text, PLANE_AGE is blank at times."""
    raw = lineitem(spark, sf_dir).select(
        "l_orderkey", "l_shipdate",
        *[F.coalesce(F.expr(e).cast("string"), F.lit("")).alias(n) for n, e in FLIGHT_FROM_LINEITEM.items()])
    sent = encode_events(raw.withColumnRenamed("l_orderkey", "key"), FLIGHT_SCHEMA, ts_col="l_shipdate")
    schema = T.StructType([*FLIGHT_SCHEMA.fields, T.StructField("key", T.LongType())])
    out = decode_events(sent, schema).withColumn("timestamp", instant_to_ntz("timestamp"))
    return out.select(F.col("key").alias("l_orderkey"), *[
        F.col(n).cast({"int": "long", "float": "double"}[k]).alias(n) if k in ("int", "float") else F.col(n) for n, k in FLIGHT_FIELDS])
