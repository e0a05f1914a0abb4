"""Static table sources (SRC1, SRC2, SRC7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tarmac.operators.clean import coerce_rows
from tarmac.roles import require_columns


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str = "parquet", header: bool = True, **options) -> DataFrame:
    """Read a static table from any Hadoop-compatible path (local, HDFS, object store).

    CSV with a header and a schema is bound by column *name*: the text columns
    are read as the header names them, coerced to the schema's types (an
    integer field holding ``17.0`` is 17, blank or malformed text is NULL) and
    put in the schema's order; columns the schema does not name follow as
    text. A missing column is an error, and so is a file of the folder whose
    header differs from the others. Inference costs a full extra pass and is
    used only without a schema. Parquet keeps its own schema; a given schema
    then acts as a projection contract.
    """
    if fmt == "csv" and header and schema is not None:
        return _csv_by_name(spark, path, schema, options)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", header)
        if schema is None:
            reader = reader.option("inferSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def _csv_by_name(spark: SparkSession, path: str, schema: T.StructType | str, options: dict) -> DataFrame:
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    # With inference off every column is text under its own header name;
    # enforceSchema=False checks that name against the header of each file.
    raw = spark.read.options(**{"header": True, "enforceSchema": False, "mode": "FAILFAST", **options}).csv(path)
    require_columns(raw, *wanted.fieldNames())
    extra = [c for c in raw.columns if c not in set(wanted.fieldNames())]
    return coerce_rows(raw.select(*[f"`{c}`" for c in [*wanted.fieldNames(), *extra]]), wanted)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty DataFrame with a declared schema (the no-input case)."""
    return spark.createDataFrame([], schema)


def stage_parquet(df: DataFrame, path: str, partitions: int | None = None) -> str:
    """Write a table once as Parquet so later scans get pushdown and pruning.

    Replaces repeated CSV scans (every action re-parses the text) with one
    conversion; the written copy also cuts lineage.
    """
    out = df.repartition(partitions) if partitions else df
    out.write.mode("overwrite").parquet(path)
    return path

