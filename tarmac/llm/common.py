"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.plans.tables import table
from tarmac.session import scratch_path

__all__ = ["fits_broadcast", "importable", "is_held_out", "passing", "slices", "small", "stored", "table"]

FOLDS = 5


def is_held_out(doc_id: Column | str) -> Column:
    """True for the fifth of ids kept out of training; a NULL id is held out too."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % FOLDS == 0, F.lit(True))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: an executor lost later costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows (counts no more than it must)."""
    return df.limit(rows + 1).count() <= rows


def fits_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint when its counted size allows one; else as it
    is, so that the join is dealt out by key. The joined rows are the same."""
    return F.broadcast(df) if small(df, rows) else df


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows, so that few texts are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package when it is run from a checkout.

    On a cluster the package is installed or shipped with ``--py-files``; the entry then
    points nowhere and does nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def passing(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """All columns of ``docs`` under names of our own plus ``text``, and which is which."""
    names = {f"c{i}": c for i, c in enumerate(docs.columns)}
    return docs.select(*(F.col(f"`{c}`").alias(n) for n, c in names.items()), "text"), names
