"""Dataset profiling: shape, schema and missing-value audit (PRJ9, PRJ10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def missing_audit(df: DataFrame) -> DataFrame:
    """One row, one column per input column: how many values are NULL.

    A single scan with one global partial aggregate, whatever the width.
    """
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def profile(df: DataFrame) -> DataFrame:
    """One row: ``n_rows`` (one counting scan) and ``n_columns`` (from the schema)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_columns"))


def schema_table(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The schema as rows ``(position, column_name, data_type, nullable)``.

    Built from plan metadata only; no data is read.
    """
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    schema = T.StructType([
        T.StructField("position", T.IntegerType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("data_type", T.StringType(), False),
        T.StructField("nullable", T.BooleanType(), False),
    ])
    return spark.createDataFrame(rows, schema)


def audit_columns(df: DataFrame, classes: dict[str, list] | None = None) -> dict[str, Column]:
    """Aggregates by name: ``n_rows``, ``missing_<column>`` for every column and, for ``classes``
    (column to its known values), ``count_<column>_<value>``."""
    out = {"n_rows": F.count(F.lit(1))} | {f"missing_{c}": F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns}
    for c, values in (classes or {}).items():
        out |= {f"count_{c}_{v}": F.count_if(F.col(f"`{c}`") == F.lit(v)) for v in values}
    return out


def stage_observed(df: DataFrame, path: str, metrics: dict[str, Column], mode: str = "error") -> tuple[DataFrame, dict]:
    """Write ``df`` as Parquet and aggregate ``metrics`` in the same pass; returns the staged table and the metrics.

    An audit, a profile and class counts so cost no job of their own: the rows are counted as they go to
    the writer. Only the one row of metrics comes to the driver. Metrics are those of the write's
    tasks that succeeded; a task that is run again after a lost executor counts once.
    """
    seen = Observation()
    df.observe(seen, *[c.alias(n) for n, c in metrics.items()]).write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), dict(seen.get)
