"""Hold-out evaluation as distributed DataFrame jobs (ML10, ML11).

``auc`` is the exact area under the ROC curve (ties count one half), i.e. the
Mann-Whitney statistic. Each distinct score is reduced to its positive and
negative counts first (a map-side-combined aggregate, so one score holding a
third of all rows is a single row afterwards). The running count of negatives
below each score is computed per score bucket: bucket edges are approximate
quantiles of the distinct scores, the per-bucket totals (one row per bucket)
give each bucket's offset, and only the rows of one bucket are ordered
together. No step gathers the data into one task.

``weighted_f1`` reduces predictions to the confusion counts per
``(label, prediction)`` pair and combines them per class in one aggregate.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.session import ensure_checkpoint_dir


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def score_counts(df: DataFrame, label: str | Column, score: str | Column) -> DataFrame:
    """``(score, pos, neg)`` per distinct score; rows with a NULL/NaN score or label are left out."""
    lab, s = _c(label).cast("double"), _c(score).cast("double")
    rows = df.select(s.alias("score"), lab.alias("label")).filter(
        F.col("score").isNotNull() & ~F.isnan("score") & F.col("label").isNotNull())
    return rows.groupBy("score").agg(
        F.sum(F.when(F.col("label") == 1.0, 1.0).otherwise(0.0)).alias("pos"),
        F.sum(F.when(F.col("label") == 1.0, 0.0).otherwise(1.0)).alias("neg"),
    )


#: Distinct scores in a bucket, on average; no bucket holds more than 1.5 times as many.
ROWS_PER_BUCKET = 1_000_000


def auc(df: DataFrame, label: str | Column, score: str | Column, rows_per_bucket: int = ROWS_PER_BUCKET,
        scale: int | None = 12) -> DataFrame:
    """One row: ``auc``, ``n_positive``, ``n_negative``. NULL ``auc`` when a class is absent.

    Each bucket has about ``rows_per_bucket`` distinct scores. The distinct-score
    table is checkpointed (reliably, under ``spark.checkpoint.dir``).
    """
    # Written once to the shared checkpoint dir: the passes below (count,
    # quantiles, ranking) read it instead of re-aggregating the input.
    ensure_checkpoint_dir(df.sparkSession)
    return auc_from_counts(score_counts(df, label, score).checkpoint(eager=True), rows_per_bucket, scale)


def auc_from_counts(counts: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET, scale: int | None = 12) -> DataFrame:
    """:func:`auc` over a materialised ``(score, pos, neg)`` table.

    Bucket edges are quantiles of the distinct scores whose rank is off by at most a
    quarter of a bucket (``rel_error = 1 / (4 * buckets)``), so a bucket between two
    edges holds at most 1.5 times its share, whatever the number of buckets.
    """
    buckets = max(2, -(-counts.count() // rows_per_bucket))
    edges = counts.approxQuantile("score", [i / buckets for i in range(1, buckets)], 1 / (4 * buckets))
    infinite = float("-inf"), float("inf")
    # 0.0 splits an empty table, or one whose only scores are infinite.
    splits = [infinite[0], *(sorted({e for e in edges if e not in infinite}) or [0.0]), infinite[1]]
    bucketed = Bucketizer(splits=splits, inputCol="score", outputCol="bucket").transform(counts)
    # One row per bucket: total negatives, then the negatives in all lower buckets.
    per_bucket = bucketed.groupBy("bucket").agg(F.sum("neg").alias("bucket_neg"))
    lower = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select("bucket", F.coalesce(F.sum("bucket_neg").over(lower), F.lit(0.0)).alias("offset"))
    within = Window.partitionBy("bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = bucketed.join(offsets, "bucket").withColumn(
        "neg_below", F.col("offset") + F.coalesce(F.sum("neg").over(within), F.lit(0.0)))
    totals = ranked.agg(
        F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)).alias("u"),
        F.sum("pos").alias("p"),
        F.sum("neg").alias("n"),
    )
    value = F.try_divide(F.col("u"), F.col("p") * F.col("n"))
    if scale is not None:
        value = F.round(value, scale)
    return totals.select(value.alias("auc"), F.col("p").cast("long").alias("n_positive"),
                         F.col("n").cast("long").alias("n_negative"))


def confusion(df: DataFrame, label: str | Column, prediction: str | Column) -> DataFrame:
    """Counts per ``(label, prediction)``."""
    return df.select(_c(label).cast("double").alias("label"), _c(prediction).cast("double").alias("prediction")) \
        .filter(F.col("label").isNotNull() & F.col("prediction").isNotNull()) \
        .groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def weighted_f1(df: DataFrame, label: str | Column, prediction: str | Column, scale: int | None = 12) -> DataFrame:
    """One row: ``weighted_f1`` (per-class F1 weighted by true-class support)
    and ``accuracy``.

    Each confusion cell ``(label, prediction, n)`` adds ``n`` to the support
    (and, on the diagonal, the true positives) of its label's class and ``n``
    to the predictions of its predicted class; one aggregate per class then
    gives everything, with a single scan and no join.
    """
    return _f1_from_confusion(confusion(df, label, prediction), scale)


def _f1_from_confusion(conf: DataFrame, scale: int | None = 12) -> DataFrame:
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    parts = F.explode(F.array(
        F.struct(F.col("label").alias("cls"), F.col("n").alias("support"), hit.alias("tp"),
                 F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("long").alias("support"),
                 F.lit(0).cast("long").alias("tp"), F.col("n").alias("predicted")),
    )).alias("c")
    per_class = conf.select(parts).groupBy("c.cls").agg(
        F.sum("c.support").alias("support"), F.sum("c.tp").alias("tp"), F.sum("c.predicted").alias("predicted"))
    # Classes that were only predicted have no support and weigh nothing.
    classes = per_class.filter(F.col("support") > 0)
    f1 = F.when(F.col("tp") == 0, F.lit(0.0)).otherwise(
        F.lit(2.0) * F.col("tp") / (F.col("support") + F.col("predicted")))
    out = classes.agg(
        F.sum(F.col("support") * f1).alias("wsum"),
        F.sum("support").alias("total"),
        F.sum("tp").alias("correct"),
    )
    wf1 = F.try_divide(F.col("wsum"), F.col("total").cast("double"))
    acc = F.try_divide(F.col("correct").cast("double"), F.col("total").cast("double"))
    if scale is not None:
        wf1, acc = F.round(wf1, scale), F.round(acc, scale)
    return out.select(wf1.alias("weighted_f1"), acc.alias("accuracy"))


def mllib_auc(df: DataFrame, label: str, raw_prediction: str = "rawPrediction", num_bins: int = 0) -> float:
    """Area under ROC from MLlib's evaluator (``num_bins=0``: exact; MLlib's
    own default of 1000 down-samples the curve)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    data = df.withColumn(label, F.col(label).cast("double"))
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw_prediction,
                                         metricName="areaUnderROC", numBins=num_bins).evaluate(data)


def mllib_f1(df: DataFrame, label: str, prediction: str = "prediction") -> float:
    """Weighted F1 from MLlib's multiclass evaluator."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    data = df.withColumn(label, F.col(label).cast("double"))
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction,
                                             metricName="f1").evaluate(data)


def evaluate(df: DataFrame, label: str | Column, score: str | Column, prediction: str | Column,
             rows_per_bucket: int = ROWS_PER_BUCKET, scale: int | None = 12) -> tuple[float | None, float | None]:
    """``(auc, weighted_f1)`` from one pass over scored rows.

    The rows are reduced once to counts per ``(score, label, prediction)``
    (checkpointed); both metrics are then derived from that small table, so
    the model's predictions are computed a single time.
    """
    ensure_checkpoint_dir(df.sparkSession)
    lab, s, p = _c(label).cast("double"), _c(score).cast("double"), _c(prediction).cast("double")
    cells = df.select(s.alias("score"), lab.alias("label"), p.alias("prediction")).filter(
        F.col("label").isNotNull()).groupBy("score", "label", "prediction").agg(
        F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    counts = cells.filter(F.col("score").isNotNull() & ~F.isnan("score")).groupBy("score").agg(
        F.sum(F.when(F.col("label") == 1.0, F.col("n")).otherwise(0)).cast("double").alias("pos"),
        F.sum(F.when(F.col("label") == 1.0, 0).otherwise(F.col("n"))).cast("double").alias("neg")).checkpoint(eager=True)
    area = auc_from_counts(counts, rows_per_bucket, scale).first()["auc"]
    conf = cells.filter(F.col("prediction").isNotNull()).groupBy("label", "prediction").agg(
        F.sum("n").alias("n"))
    f1 = _f1_from_confusion(conf, scale).first()["weighted_f1"]
    return area, f1
