"""JSON event encoding and decoding (SRC5, PRJ2, PRJ3, PRJ15, PRJ16).

The wire record is one flat JSON object per row; its event time travels as
integer epoch seconds. Encoding is a plain projection (``to_json(struct)``),
so replaying a table of any size as an event stream is an ordinary parallel
write, not a per-row loop on one machine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.scalar import coerce_to, epoch_seconds, event_time_of
from tarmac.roles import col_of
from tarmac.session import ensure_checkpoint_dir


def number_rows(df: DataFrame, order_by: Sequence[str] = (), row_name: str = "row") -> DataFrame:
    """Number the rows from 0 in the order of ``order_by``, or as the table is read, without gathering
    them: within each partition by Spark's own row ids, across partitions by their sizes (one small
    row for each partition). The table is checkpointed first, so that both passes see
    the same partitions.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by) if order_by else df
    placed = ordered.withColumns({"_part": F.spark_partition_id(), "_id": F.monotonically_increasing_id()}) \
        .checkpoint(eager=True)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    row = F.col("_offset") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(offsets, "_part").withColumn(row_name, row).drop("_part", "_id", "_offset")


def arrival_times(df: DataFrame, start: int, interval: float = 1.0, order_by: Sequence[str] = (),
                  ts_name: str = "timestamp") -> DataFrame:
    """Stamp each row with the epoch second at which a producer would send it:
    row ``i`` (see :func:`number_rows`) gets ``floor(start + i * interval)``."""
    return number_rows(df, order_by, "_row").withColumn(ts_name, send_time("_row", start, interval)).drop("_row")


def send_time(row: str | Column, start: int, interval: float = 1.0) -> Column:
    """The epoch second at which a producer that began at ``start`` sends row ``row``."""
    return F.floor(F.lit(float(start)) + col_of(row) * F.lit(float(interval))).cast("long")


def paced_rows(numbered: DataFrame, rows_per_batch: int, row_name: str = "row", first: int = 0,
               partitions: int | None = None) -> DataFrame:
    """A live replay of a numbered table: every micro-batch delivers the next ``rows_per_batch`` rows.

    The clock is Spark's ``rate-micro-batch`` source, whose offsets are in the checkpoint, so that a
    resumed replay goes on with the next rows; the pace is ``rows_per_batch`` times the query's trigger. Its
    counter is joined with the table (a stream-static join). The counter's rows, at most ``rows_per_batch``,
    are what is broadcast; the table is scanned by every micro-batch and never shuffled, so write it as
    Parquet sorted by its number (as :func:`number_rows` leaves it), and take batches that are a
    fair part of it. Rows before ``first`` are left out. When the table is through, batches are empty.
    """
    if not 0 < rows_per_batch <= 5_000_000:
        raise ValueError("rows_per_batch must be between 1 and 5,000,000: the counter's rows are broadcast")
    spark = numbered.sparkSession
    clock = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch)
             .option("numPartitions", partitions or spark.sparkContext.defaultParallelism).load()
             .select((F.col("value") + first).alias(row_name)))
    return F.broadcast(clock).join(numbered, row_name)


def encode_events(df: DataFrame, schema: T.StructType | None = None, ts_col: str | Column | None = None,
                  ts_name: str = "timestamp", stamp_now: bool = False) -> DataFrame:
    """Encode each row as a JSON ``value``.

    * ``schema``: coerce every column present in it to its type first
      (integers by truncation), so a fraction in an integer field is not lost
      to a NULL at decode time; blank text becomes NULL and is omitted.
    * ``ts_col``: event time, written as epoch seconds under ``ts_name``,
      replacing a column of that name (a ``timestamp_ntz`` wall clock is read
      as UTC). ``stamp_now`` stamps the processing time instead: one instant for
      all rows of a batch frame; :func:`arrival_times` spaces them.
    NULL fields are omitted from the JSON text.
    """
    types = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    cols: list[Column] = []
    for c in df.columns:
        if c == ts_name and (ts_col is not None or stamp_now):
            continue
        if c in types and not isinstance(types[c], (T.TimestampType, T.TimestampNTZType)):
            cols.append(coerce_to(c, types[c]).alias(c))
        else:
            cols.append(F.col(c))
    if ts_col is not None:
        t = event_time_of(df, ts_col) if isinstance(ts_col, str) else col_of(ts_col).cast("timestamp")
        cols.append(epoch_seconds(t).alias(ts_name))
    elif stamp_now:
        cols.append(F.unix_timestamp(F.current_timestamp()).alias(ts_name))
    return df.select(F.to_json(F.struct(*cols)).alias("value"))


def reduce_schema(schema: T.StructType, columns: Sequence[str] | None) -> T.StructType:
    """Keep only ``columns`` (in schema order).

    Catalyst does not prune a JSON schema once two or more fields are used,
    so parsing the full record when a query needs a few fields wastes CPU.
    """
    if not columns:
        return schema
    wanted = set(columns)
    unknown = wanted - set(schema.fieldNames())
    if unknown:
        raise ValueError(f"columns {sorted(unknown)} are not in the record schema")
    return T.StructType([f for f in schema.fields if f.name in wanted])


def decode_events(df: DataFrame, schema: T.StructType, value_col: str = "value",
                  columns: Sequence[str] | None = None, event_time: str | None = None,
                  event_time_col: str = "event_timestamp", keep: Sequence[str] = ()) -> DataFrame:
    """Parse the JSON ``value`` with ``schema`` and flatten it; transport
    columns are dropped.

    A number in a timestamp field is read as epoch seconds. A malformed record
    yields a row of NULLs; a field of the wrong type (``1.7`` in an int field,
    ``""`` in a number field) is NULL on its own. ``event_time`` names a field
    to expose as a ``timestamp`` column ``event_time_col``, ready for
    ``withWatermark``. ``keep`` lists input columns to carry alongside.
    """
    s = reduce_schema(schema, columns)
    parsed = df.select(*keep, F.from_json(col_of(value_col).cast("string"), s).alias("data")) \
        .select(*keep, "data.*")
    if event_time:
        parsed = parsed.withColumn(event_time_col, F.col(event_time).cast("timestamp"))
    return parsed
