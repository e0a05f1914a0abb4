"""Delay classifier pipeline, decision threshold, persistence and scoring
(ML3-ML9, ML12, SRC8, SNK6, STR11).

Everything is MLlib: the fit is distributed, and the fitted ``PipelineModel``
transforms batch and streaming frames alike.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.ml.evaluate import evaluate
from tarmac.ml.indexing import TableIndexer
from tarmac.ml.sampling import hash_split, undersample
from tarmac.operators.clean import prepare_features
from tarmac.schema import DEFAULT_THRESHOLD, PREDICTION_COL

UNSCALED = "features_unscaled"
FEATURES = "features"


def classifier_for(kind: str | Estimator, label: str, seed: int = 42) -> Estimator:
    """The final stage: ``"gbt"`` (10 iterations, depth 5), ``"lr"`` (10
    iterations), ``"rf"`` (20 trees), ``"rf_shallow"`` (10 trees, depth 5), or
    any MLlib classifier instance."""
    if not isinstance(kind, str):
        return kind
    if kind == "gbt":
        return GBTClassifier(featuresCol=FEATURES, labelCol=label, maxIter=10, maxDepth=5, seed=seed)
    if kind == "lr":
        return LogisticRegression(featuresCol=FEATURES, labelCol=label, maxIter=10)
    if kind == "rf":
        return RandomForestClassifier(featuresCol=FEATURES, labelCol=label, numTrees=20, seed=seed)
    if kind == "rf_shallow":
        return RandomForestClassifier(featuresCol=FEATURES, labelCol=label, numTrees=10, maxDepth=5, seed=seed)
    raise ValueError(f"unknown classifier {kind!r}")


def build_pipeline(numeric: Sequence[str], categorical: Sequence[str], label: str,
                   classifier: str | Estimator = "gbt", seed: int = 42, large: Sequence[str] = ()) -> Pipeline:
    """Index categories (by frequency; unseen and NULL share one extra index; those named in
    ``large``, of any cardinality, by a :class:`TableIndexer`, the others by StringIndexer), assemble numeric + indexed inputs (rows with invalid values skipped),
    standardise to mean 0 / std 1, then classify.

    The scaler stays before the trees on purpose: it drops the nominal
    metadata of the indices, so high-cardinality categories are split as
    ordered values instead of exceeding the tree's bin limit.
    """
    indexed = [f"{c}_indexed" for c in categorical]
    stages = [TableIndexer(inputCol=c, outputCol=o) if c in large else
              StringIndexer(inputCol=c, outputCol=o, handleInvalid="keep") for c, o in zip(categorical, indexed)]
    stages.append(VectorAssembler(inputCols=[*numeric, *indexed], outputCol=UNSCALED, handleInvalid="skip"))
    stages.append(StandardScaler(inputCol=UNSCALED, outputCol=FEATURES, withMean=True, withStd=True))
    stages.append(classifier_for(classifier, label, seed))
    return Pipeline(stages=stages)


def with_threshold(model: PipelineModel, threshold: float = DEFAULT_THRESHOLD) -> PipelineModel:
    """Predict the positive class when ``P(positive) > threshold``.

    Set as class thresholds ``[1 - t, t]`` on the classifier, so it is saved
    and loaded with the model.
    """
    if not 0.0 < threshold < 1.0:
        raise ValueError("threshold must be in (0, 1)")
    model.stages[-1].setThresholds([1.0 - threshold, threshold])
    return model


def without_summary(model: PipelineModel) -> PipelineModel:
    """Let go of the training summaries of a fitted pipeline.

    A summary holds the scored training rows and their session, and travels with the model to every
    task. A session that has observed a query (``stage_observed``) cannot be shipped, so
    a model with a summary could no longer score.
    """
    for stage in model.stages:
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(SparkSession.getActiveSession().sparkContext._jvm.scala.Option.empty())
    return model


def decide(score: str | Column, threshold: float = DEFAULT_THRESHOLD) -> Column:
    """The thresholded decision as a 0.0/1.0 prediction, from a positive-class score."""
    s = F.col(score) if isinstance(score, str) else score
    return (s > F.lit(threshold)).cast("double")


def positive_probability(probability_col: str = "probability") -> Column:
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(probability_col))[1]


@dataclass
class TrainResult:
    model: PipelineModel
    sample_fraction: float | None
    auc: float
    f1: float
    n_train: int


def train_model(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str, key: str | None,
                classifier: str | Estimator = "gbt", threshold: float = DEFAULT_THRESHOLD,
                weights: Sequence[float] = (0.8, 0.2), ratio: float = 3.0, hash_method: str = "xxhash64",
                seed: int = 42, large: Sequence[str] = ()) -> tuple[TrainResult, DataFrame]:
    """Prepare, split by key hash (``key=None``: whole-row hash), undersample
    the majority, fit, set the threshold and evaluate on the hold-out. Returns
    the result and the scored hold-out rows."""
    prepared = prepare_features(df, numeric, categorical, label=label, drop_null_label=True)
    train, test = hash_split(prepared, key, weights, method=hash_method)
    balanced, fraction = undersample(train, label, key, ratio, method=hash_method)
    # The fit makes several passes (indexers, scaler, boosting); keep the
    # sample materialised. On executor loss it is recomputed deterministically.
    balanced = balanced.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_train = balanced.count()
        model = build_pipeline(numeric, categorical, label, classifier, seed, large).fit(balanced)
    finally:
        balanced.unpersist()
    with_threshold(without_summary(model), threshold)
    scored = model.transform(test)
    area, f1 = evaluate(scored, label, positive_probability(), "prediction")  # one pass over the hold-out
    result = TrainResult(model=model, sample_fraction=fraction, auc=area, f1=f1, n_train=n_train)
    return result, scored


def load_model(spark: SparkSession, path: str) -> PipelineModel | None:
    """Load a fitted pipeline; ``None`` when there is nothing at ``path``. Whatever
    else goes wrong (unreadable storage, a broken or half-written model) is raised."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath):
        return None
    return PipelineModel.load(path)


def score(df: DataFrame, model: PipelineModel | str | None, output_cols: Sequence[str],
          prediction_alias: str = PREDICTION_COL, sentinel: float = -1.0, on_missing: str = "sentinel") -> DataFrame:
    """Score rows (batch or stream) and project to ``output_cols``.

    ``model`` may be a fitted pipeline or a path. Without a model (``None``, or
    nothing at the path) ``on_missing="sentinel"`` gives every row ``sentinel`` as
    its prediction, with the very same output schema, and logs a warning;
    ``"error"`` raises. A model that is there but cannot be loaded always raises.
    """
    if on_missing not in ("sentinel", "error"):
        raise ValueError("on_missing must be 'sentinel' or 'error'")
    where = model
    if isinstance(model, str):
        model = load_model(df.sparkSession, model)
    if model is None and on_missing == "error":
        raise FileNotFoundError(f"no model at {where!r}")
    if model is None:
        logging.getLogger(__name__).warning("no model at %r: every prediction is %s", where, sentinel)
        out = df.withColumn(prediction_alias, F.lit(float(sentinel)))
    else:
        out = model.transform(df).withColumnRenamed("prediction", prediction_alias)
    # Same schema on both paths: a plain double without ML attribute metadata.
    out = out.withColumn(prediction_alias, F.col(prediction_alias).cast("double").alias(prediction_alias, metadata={}))
    return out.select(*output_cols)
