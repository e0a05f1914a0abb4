"""Idempotent micro-batch sinks (SNK2-SNK5, STR9) and model persistence (SNK6).

Both writers are ``foreachBatch`` callbacks keyed by the batch id. A batch that
is re-run after a failure or a restart overwrites exactly its own output, so
replays never duplicate rows in what is read.

The keyed table is a plain Parquet table. Each batch appends its rows, stamped with the
time of the write and the batch id, and a read takes the last write per key: one
``groupBy`` with a ``max`` that combines in the tasks. :func:`fold_upserts` is the
ordinary job that replaces the appended rows by the last ones, day by day.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.roles import require_columns
from tarmac.session import scratch_path
from tarmac.sources.results import path_has_files
from tarmac.sources.tables import empty_table

BatchFn = Callable[[DataFrame, int], None]
#: When a row was written (microseconds) and by which batch; the day its table partition is named by.
WRITTEN_COL, BATCH_COL, DAY_COL = "upsert_written", "upsert_batch", "upsert_day"


def batch_writer(path: str, fmt: str = "csv", files: int | None = None, skip_empty: bool = True,
                 header: bool = True, transform: Callable[[DataFrame], DataFrame] | None = None,
                 partition_by: list[str] | None = None) -> BatchFn:
    """Write every non-empty micro-batch to ``<path>/batch_<id>``.

    ``files`` coalesces the batch to that many files (``1`` for one file per
    batch, as small scoring batches want; leave it unset for large batches so
    the write stays parallel). ``partition_by`` lays each batch out by those
    columns (e.g. a window date) for pruning downstream. The write overwrites
    its own folder, so a replayed batch replaces rather than appends. The
    batch is persisted while it is checked for emptiness and written, so it is
    computed once.
    """

    def write(batch_df: DataFrame, batch_id: int) -> None:
        out = transform(batch_df) if transform else batch_df
        out = out.persist()
        try:
            if skip_empty and out.isEmpty():
                return
            if files:
                out = out.coalesce(files)
            w = out.write.mode("overwrite").format(fmt)
            if partition_by:
                w = w.partitionBy(*partition_by)
            if fmt == "csv":
                w = w.option("header", header)
            w.save(f"{path.rstrip('/')}/batch_{batch_id}")
        finally:
            out.unpersist()

    return write


def _stamped(schema: T.StructType, day_of: str | None) -> T.StructType:
    day = [T.StructField(DAY_COL, T.DateType())] if day_of else []
    return T.StructType([*schema.fields, T.StructField(WRITTEN_COL, T.LongType()),
                         T.StructField(BATCH_COL, T.LongType()), *day])


def _save(rows: DataFrame, path: str, mode: str, day_of: str | None, overwrite: str = "static") -> None:
    w = rows.write.mode(mode).option("partitionOverwriteMode", overwrite)
    (w.partitionBy(DAY_COL) if day_of else w).parquet(path)


def reset_table(spark: SparkSession, path: str, schema: T.StructType, day_of: str | None = None) -> None:
    """Drop the keyed table at ``path`` and recreate it empty with ``schema``."""
    _save(empty_table(spark, _stamped(schema, day_of)), path, "overwrite", day_of)


def upsert_writer(path: str, keys: Sequence[str], transform: Callable[[DataFrame], DataFrame] | None = None,
                  spark: SparkSession | None = None, reset_schema: T.StructType | None = None,
                  day_of: str | None = None) -> BatchFn:
    """``foreachBatch`` callback appending each batch to the keyed table at ``path``.

    ``keys`` is the upsert key (checked on every batch); the last write wins, by the
    driver's clock and then by batch id, so a query on a fresh checkpoint writes after
    all before it. A batch that is run again appends the same rows with a later stamp, which
    changes nothing that is read. ``day_of`` names a timestamp of the key by whose UTC day the table is
    partitioned, so that reads of some days and folds touch only those. ``reset_schema`` (with
    ``spark``) drops and recreates the table first. One writer runs at a time.
    """
    keys = list(keys)
    if day_of is not None and day_of not in keys:
        raise ValueError("day_of must be part of the key, so that a key stays in one day")
    if reset_schema is not None:
        if spark is None:
            raise ValueError("reset needs the session")
        reset_table(spark, path, reset_schema, day_of)

    def write(batch_df: DataFrame, batch_id: int) -> None:
        out = transform(batch_df) if transform else batch_df
        require_columns(out, *keys)
        out = out.withColumns({WRITTEN_COL: F.lit(time.time_ns() // 1000), BATCH_COL: F.lit(batch_id).cast("long")})
        if day_of:
            out = out.withColumn(DAY_COL, F.date_from_unix_date(F.floor(F.unix_timestamp(day_of) / 86400).cast("int")))
        _save(out, path, "append", day_of)

    return write


def _last(rows: DataFrame, keys: Sequence[str], schema: T.StructType, by: Sequence[str] = ()) -> DataFrame:
    rest = [f.name for f in schema.fields if f.name not in keys]
    return rows.groupBy(*keys, *by).agg(F.max(F.struct(WRITTEN_COL, BATCH_COL, *rest)).alias("_row"))


def read_upserted(spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    """Current state of the keyed table: per key, the row of the latest write.

    Ties inside one batch are broken by the row values, so the result never depends
    on arrival order within a batch.
    """
    keys = list(keys)
    rows = empty_table(spark, _stamped(schema, None))
    if path_has_files(spark, path):
        rows = spark.read.schema(rows.schema).parquet(path)
    return _last(rows, keys, schema).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in schema.fieldNames()])


def fold_upserts(spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType, day_of: str,
                 days: Sequence[str] | None = None) -> None:
    """Leave one row per key in the keyed table, partitioned by the day of ``day_of``.

    An ordinary batch job for times when no stream writes: the last rows, with their stamps, are
    written to the shared scratch folder and from there over the days they belong to (dynamic partition
    overwrite). ``days`` (``yyyy-mm-dd``) restricts it to some days, which the scan prunes to.
    """
    if not path_has_files(spark, path):
        return
    stamped = _stamped(schema, day_of)
    rows = spark.read.schema(stamped).parquet(path)
    if days is not None:
        rows = rows.where(F.col(DAY_COL).isin([F.lit(d).cast("date") for d in days]))
    keys = list(keys)
    last = _last(rows, keys, schema, [DAY_COL]).select(
        *[F.col(c) if c in (*keys, DAY_COL) else F.col(f"_row.{c}").alias(c) for c in stamped.fieldNames()])
    folded = scratch_path(spark, "folded")
    last.write.parquet(folded)
    # One task for each day, or a few for a large one, so that a fold leaves few files.
    _save(spark.read.schema(stamped).parquet(folded).repartition(DAY_COL), path, "overwrite", day_of, "dynamic")


def save_model(model, path: str) -> str:
    """Persist a fitted pipeline, replacing what is there."""
    model.write().overwrite().save(path)
    return path
