"""Nested JSON statistics payload (SNK1) and its decoding for the keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.scalar import ntz_to_instant
from tarmac.schema import STAT_FIELDS, stat_payload_schema


def to_stat_json(df: DataFrame, group_col: str, window_col: str = "window") -> DataFrame:
    """``{window_start, window_end, group, statistics{min,max,avg,std,count}}``
    as a JSON ``value``; NULL fields are omitted. The group column is passed by
    name, never found by position.
    """
    wtype = df.schema[window_col].dataType["start"].dataType
    conv = ntz_to_instant if isinstance(wtype, T.TimestampNTZType) else (lambda c: F.col(c).cast("timestamp"))
    payload = F.struct(
        conv(f"{window_col}.start").alias("window_start"),
        conv(f"{window_col}.end").alias("window_end"),
        F.col(group_col).alias("group"),
        F.struct(*[F.col(c) for c in STAT_FIELDS]).alias("statistics"),
    )
    return df.select(F.to_json(payload).alias("value"))


def from_stat_json(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Decode the payload into the flat keyed-statistics record.

    The group value is kept as text (NULL stays NULL, never the string
    ``"None"``); window bounds come back as timestamps.
    """
    schema = stat_payload_schema()
    p = df.select(F.from_json(F.col(value_col).cast("string"), schema).alias("p"))
    return p.select(
        F.col("p.window_start").alias("window_start"),
        F.col("p.window_end").alias("window_end"),
        F.col("p.group").cast("string").alias("group_value"),
        *[F.col(f"p.statistics.{c}").alias(c) for c in STAT_FIELDS],
    )
