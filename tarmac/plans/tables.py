"""Access to the driver tables and the role mapping used by the registered queries.

Role mapping (which driver column plays which part of a flight record):

=================  =================================  ==========================
role               ``lineitem``                        ``events``
=================  =================================  ==========================
label (0/1)        ``l_returnflag = 'R'``              ``event_type = 'error'``
period             ``month(l_shipdate)``               --
event time         ``l_shipdate``                      ``ts``
entity / place     ``l_suppkey`` / ``l_partkey``       ``event_type`` / ``user_id``
measures           quantity, price, discount, tax      ``value``
prediction         ``l_discount > 0.05``               ``value > 50``
score              ``l_discount * 10``                 ``value``
=================  =================================  ==========================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINEITEM_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def returned() -> Column:
    """Label role on ``lineitem``."""
    return F.col("l_returnflag") == F.lit("R")


def is_error() -> Column:
    """Label role on ``events``."""
    return F.col("event_type") == F.lit("error")


def ship_month() -> Column:
    """Period role on ``lineitem``."""
    return F.month("l_shipdate").alias("month")


def with_nullable_tax(df: DataFrame) -> DataFrame:
    """Driver tables hold no NULLs; a zero tax stands in for a missing value."""
    return df.withColumn("l_tax", F.nullif(F.col("l_tax"), F.lit(0.0)))
