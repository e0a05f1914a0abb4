"""Frequency-ordered category index computed on the cluster (ML3 at any cardinality).

StringIndexer collects its label list on the driver, which is right for
carriers and airports but not for ids. :func:`frequency_index` assigns the
same indices (count descending, then value ascending) without gathering
anything: the per-value counts are range-partitioned on that order and
checkpointed (which fixes the partitions), rows are numbered inside each
range, and each range is offset by the sizes of the ranges before it. The
offsets table has one row per partition, a proven bound. A hot count value
(a long tail of values seen once) is still split over many ranges because the
value itself is part of the range key.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.session import ensure_checkpoint_dir, scratch_path


#: Distinct values in a range, on average.
VALUES_PER_RANGE = 1_000_000


def frequency_index(df: DataFrame, col: str | Column, out_col: str = "index",
                    partitions: int | None = None) -> DataFrame:
    """``(value, count, <out_col>)`` for every distinct non-NULL value, the
    index being the value's rank by count descending, then value ascending
    (the order StringIndexer uses), as a double from 0."""
    c = F.col(col) if isinstance(col, str) else col
    counts = df.select(c.cast("string").alias("value")).filter(F.col("value").isNotNull()) \
        .groupBy("value").agg(F.count(F.lit(1)).alias("count"))
    ensure_checkpoint_dir(df.sparkSession)
    counts = counts.checkpoint(eager=True)
    # Ranges are sized from the distinct values, not from the input.
    n = max(1, partitions or -(-counts.count() // VALUES_PER_RANGE))
    ranged = counts.repartitionByRange(n, F.col("count").desc(), F.col("value").asc()) \
        .withColumn("_part", F.spark_partition_id()).checkpoint(eager=True)
    local = Window.partitionBy("_part").orderBy(F.col("count").desc(), F.col("value").asc())
    numbered = ranged.withColumn("_local", F.row_number().over(local) - 1)
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_offset"))
    return numbered.join(offsets, "_part").select(
        "value", "count", (F.col("_offset") + F.col("_local")).cast("double").alias(out_col))


def apply_index(df: DataFrame, index: DataFrame, col: str, out_col: str, index_col: str = "index",
                known: int | None = None) -> DataFrame:
    """Add ``out_col`` to ``df`` from a :func:`frequency_index` table; NULL and
    unseen values get one extra index (the number of known values), as
    StringIndexer's ``handleInvalid="keep"`` does.

    An equi-join on the value: Spark broadcasts the index when it is small and
    otherwise shuffles both sides, with adaptive skew handling splitting a hot
    value's partition on the data side. ``known`` gives the number of known values if it has been counted.
    """
    unseen = float(index.count() if known is None else known)  # the extra index for NULL and unseen values
    keyed = index.select(F.col("value").alias("_v"), F.col(index_col).alias(out_col))
    # NULLs match nothing; spread by the row they would not meet in one task.
    spread = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*df.columns), F.lit(1000)).cast("string"))
    joined = df.join(keyed, F.coalesce(df[col].cast("string"), spread) == keyed["_v"], "left").drop("_v")
    return joined.withColumn(out_col, F.coalesce(F.col(out_col), F.lit(unseen)))


class TableIndexer(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A pipeline stage that indexes a category of any cardinality by frequency.

    Gives what ``StringIndexer(handleInvalid="keep")`` gives, but its fitted state is a table, see
    :func:`frequency_index`, instead of a label list on the driver.
    """

    def __init__(self, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**{k: v for k, v in (("inputCol", inputCol), ("outputCol", outputCol)) if v is not None})

    def _fit(self, dataset: DataFrame) -> TableIndexerModel:
        path = scratch_path(dataset.sparkSession, "index")
        frequency_index(dataset, self.getInputCol()).select("value", "index").write.parquet(path)
        return TableIndexerModel._over(path, self.getInputCol(), self.getOutputCol(), self.uid)


class TableIndexerModel(Model, HasInputCol, HasOutputCol, MLReadable, MLWritable):
    """A fitted :class:`TableIndexer`: a table (value, index) and the number of its rows."""

    def __init__(self):
        super().__init__()
        self.path: str | None = None
        self.known = 0

    @classmethod
    def _over(cls, path: str, input_col: str, output_col: str, uid: str | None = None) -> TableIndexerModel:
        model = cls()
        if uid:
            model._resetUid(uid)
        model._set(inputCol=input_col, outputCol=output_col)
        model.path = path
        model.known = model.table(SparkSession.getActiveSession()).count()
        return model

    def table(self, spark: SparkSession) -> DataFrame:
        """The fitted state: value and index."""
        return spark.read.schema("value string, index double").parquet(self.path)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        table = self.table(dataset.sparkSession)
        return apply_index(dataset, table, self.getInputCol(), self.getOutputCol(), known=self.known)

    def write(self) -> MLWriter:
        return _TableIndexerWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableIndexerReader(cls)


class _TableIndexerWriter(MLWriter):
    def __init__(self, model: TableIndexerModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"known": self.model.known})
        self.model.table(self.sparkSession).write.parquet(f"{path}/data")


class _TableIndexerReader(MLReader):
    def __init__(self, cls: type[TableIndexerModel]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TableIndexerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.path, model.known = f"{path}/data", metadata["known"]
        return model
