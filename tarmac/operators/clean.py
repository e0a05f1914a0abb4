"""Feature preparation and typed coercion (PRJ4-PRJ8, PRJ15).

One function prepares features for both training and scoring, so the two
paths cannot drift apart (same casts, same fills, same types).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.scalar import coerce_to
from tarmac.roles import require_columns


def prepare_features(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
                     label: str | None = None, drop_null_label: bool = False,
                     numeric_fill: float = 0.0, categorical_fill: str = "N/A") -> DataFrame:
    """Cast numeric inputs to double (malformed -> NULL), fill NULL/NaN numerics
    with ``numeric_fill``, fill NULL categories with ``categorical_fill``, cast
    the label to int and optionally drop rows whose label is NULL.

    Built as a single projection, so analysis time stays flat however many
    columns are prepared; other columns pass through in place.
    """
    require_columns(df, *numeric, *categorical, *([label] if label else []))
    num, cat = set(numeric), set(categorical)
    out = []
    for name in df.columns:
        c = F.col(name)
        if name in num:
            d = c.try_cast("double")
            out.append(F.when(d.isNull() | F.isnan(d), F.lit(numeric_fill)).otherwise(d).alias(name))
        elif name in cat:
            out.append(F.coalesce(c.cast("string"), F.lit(categorical_fill)).alias(name))
        elif name == label:
            out.append(c.try_cast("double").try_cast("int").alias(name))
        else:
            out.append(c)
    prepared = df.select(*out)
    if label and drop_null_label:
        prepared = prepared.filter(F.col(label).isNotNull())
    return prepared


def coerce_rows(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Coerce raw text columns to ``schema``: integers by truncation of the
    decimal value, floats parsed, blanks and garbage to NULL, strings kept.

    Columns of ``df`` not in ``schema`` pass through; schema fields missing
    from ``df`` are ignored.
    """
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[coerce_to(c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns])

