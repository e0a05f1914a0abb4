"""Machine-learning queries (ML1-ML12, SRC8, SNK6, STR11, SET1, AGG12).

Split and sample draws use the ``md5`` hash in the SQL-checked queries so
that any SQL engine can reproduce them; the library default is ``xxhash64``.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tarmac.functions.scalar import event_time_of, instant_to_ntz
from tarmac.ml.evaluate import auc, weighted_f1
from tarmac.ml.indexing import TableIndexer, frequency_index
from tarmac.ml.model import decide, load_model, score, train_model
from tarmac.ml.sampling import SAMPLE_SEED, SPLIT_SEED, hash_split, split_column, undersample
from tarmac.operators.clean import prepare_features
from tarmac.operators.dedupe import dedupe
from tarmac.operators.windows import quality_rows, window_quality
from tarmac.plans.registry import register, sql_round, sql_unit
from tarmac.plans.tables import events, is_error, lineitem, orders
from tarmac.plans.windows import QUALITY, quality_sql
from tarmac.session import scratch_path
from tarmac.sinks.writers import batch_writer, save_model
from tarmac.sources.results import read_results, result_tasks
from tarmac.sources.streams import stream_table
from tarmac.streaming.runner import run_to_completion, state_slots


@register("train_test_split", "ML1", sql=f"""
SELECT *, CASE WHEN {sql_unit('o_orderkey', SPLIT_SEED)} < 0.8 THEN 'train' ELSE 'test' END AS split
FROM orders
""")
def train_test_split(spark, sf_dir):
    return orders(spark, sf_dir).withColumn("split", split_column("o_orderkey", (0.8, 0.2), method="md5"))


@register("balanced_training_set", ("ML2", "SET1", "AGG12"), sql=f"""
WITH t AS (
  SELECT event_id, (event_type = 'error')::INTEGER AS label,
         {sql_unit('event_id', SPLIT_SEED)} AS u_split, {sql_unit('event_id', SAMPLE_SEED)} AS u_sample
  FROM events),
train AS (SELECT * FROM t WHERE u_split < 0.8),
f AS (SELECT least(1.0::DOUBLE, 3.0::DOUBLE * count(*) FILTER (WHERE label = 1)::DOUBLE
                                / count(*) FILTER (WHERE label = 0)::DOUBLE) AS frac FROM train)
SELECT event_id, label FROM train, f WHERE label = 1 OR (label = 0 AND u_sample < frac)
""")
def balanced_training_set(spark, sf_dir):
    ev = events(spark, sf_dir).select("event_id", is_error().cast("int").alias("label"))
    train, _ = hash_split(ev, "event_id", (0.8, 0.2), method="md5")
    balanced, _ = undersample(train, "label", "event_id", ratio=3.0, method="md5")
    return balanced


@register("category_index", "ML3", sql="""
WITH e AS (SELECT event_id, json_extract_string(props, '$.k') AS v FROM events),
f AS (SELECT v, count(*) AS c FROM e GROUP BY 1),
idx AS (SELECT v, (row_number() OVER (ORDER BY c DESC, v ASC) - 1)::DOUBLE AS k_indexed FROM f)
SELECT e.event_id, idx.k_indexed FROM e JOIN idx USING (v)
""")
def category_index(spark, sf_dir):
    """Frequency-ordered index of a bounded category (the 100 ``props.k`` codes).

    StringIndexer keeps its label list on the driver, so it is meant for
    categories of bounded cardinality (carriers, airports), as here.
    """
    ev = events(spark, sf_dir).select("event_id", F.from_json("props", "k int")["k"].cast("string").alias("k"))
    model = StringIndexer(inputCol="k", outputCol="k_indexed", handleInvalid="keep").fit(ev)
    return model.transform(ev).select("event_id", "k_indexed")


@register("user_frequency_index", "ML3", sql="""
SELECT v AS value, c AS count, (row_number() OVER (ORDER BY c DESC, v ASC) - 1)::DOUBLE AS "index"
FROM (SELECT user_id::VARCHAR AS v, count(*) AS c FROM events GROUP BY 1)
""")
def user_frequency_index(spark, sf_dir):
    """The same frequency order over user ids, whose number grows with the data:
    computed on the cluster, no label list on the driver."""
    return frequency_index(events(spark, sf_dir), "user_id", "index")


@register("saved_user_index", ("ML3", "ML8", "SNK6"), sql="""
WITH f AS (SELECT user_id::VARCHAR AS v, count(*) AS c FROM events WHERE event_id % 2 = 0 GROUP BY 1),
idx AS (SELECT v, (row_number() OVER (ORDER BY c DESC, v ASC) - 1)::DOUBLE AS i FROM f)
SELECT event_id, coalesce(i, (SELECT count(*) FROM idx)::DOUBLE) AS user_indexed, value
FROM events LEFT JOIN idx ON user_id::VARCHAR = v
""")
def saved_user_index(spark, sf_dir):
    """A pipeline that indexes user ids, fitted on every second event, saved, loaded and applied to all: the
    fitted index is a table, and users that it has not seen share the extra index."""
    ev = events(spark, sf_dir).select("event_id", "value", F.col("user_id").cast("string").alias("user"))
    path = scratch_path(spark, "user-index")
    stages = [TableIndexer("user", "user_indexed"), VectorAssembler(inputCols=["value", "user_indexed"], outputCol="features")]
    save_model(Pipeline(stages=stages).fit(ev.where("event_id % 2 = 0")), path)
    out = load_model(spark, path).transform(ev)
    return out.select("event_id", vector_to_array("features")[1].alias("user_indexed"), "value")


CLASSIFIERS = ["lr", "rf", "rf_shallow"]


@register("classifier_predictions", ("ML7", "ML6", "ML9"), sql=f"""
SELECT kind, event_id, (hour(ts) < 12)::INTEGER AS label, (hour(ts) < 12)::INTEGER::DOUBLE AS predicted_delay
FROM events, (VALUES ('lr'), ('rf'), ('rf_shallow')) c(kind) WHERE {sql_unit('event_id', SPLIT_SEED)} >= 0.8
""")
def classifier_predictions(spark, sf_dir):
    """The other classifiers on inputs that each say which half of the day it is, so that every one of them, whichever
    inputs its trees are given, must learn the label."""
    ev = event_features(events(spark, sf_dir)).withColumns({
        "early": F.col(LABEL), "late": 1 - F.col(LABEL), "half": F.when(F.col(LABEL) == 1, "am").otherwise("pm")})
    parts = []
    for kind in CLASSIFIERS:
        _, held = train_model(ev, ["early", "late"], ["half"], LABEL, "event_id", classifier=kind, hash_method="md5")
        parts.append(held.select(F.lit(kind).alias("kind"), "event_id", LABEL, F.col("prediction").alias("predicted_delay")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("standardized_price", "ML5", sql=f"""
SELECT l_orderkey, l_linenumber,
       {sql_round('(l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_samp(l_extendedprice) OVER ()', 6)}
           AS price_scaled
FROM lineitem
""")
def standardized_price(spark, sf_dir):
    li = lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_extendedprice")
    vec = VectorAssembler(inputCols=["l_extendedprice"], outputCol="v").transform(li)
    scaled = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True).fit(vec).transform(vec)
    return scaled.select("l_orderkey", "l_linenumber", F.round(vector_to_array("s")[0], 6).alias("price_scaled"))


@register("threshold_decisions", "ML9", sql="""
SELECT l_orderkey, l_linenumber, l_discount * 10 AS score, (l_discount * 10 > 0.25)::INTEGER::DOUBLE AS prediction
FROM lineitem
""")
def threshold_decisions(spark, sf_dir):
    li = lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", (F.col("l_discount") * 10).alias("score"))
    return li.withColumn("prediction", decide("score", 0.25))


@register("holdout_auc", "ML10", sql=f"""
WITH s AS (
  SELECT value AS score,
         sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)::DOUBLE AS pos,
         sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END)::DOUBLE AS neg
  FROM events GROUP BY value),
r AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             AS below FROM s)
SELECT {sql_round('sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg))', 12)} AS auc,
       sum(pos)::BIGINT AS n_positive, sum(neg)::BIGINT AS n_negative
FROM r
""")
def holdout_auc(spark, sf_dir):
    return auc(events(spark, sf_dir), is_error().cast("int"), "value")


@register("holdout_f1", "ML11", sql=f"""
WITH c AS (
  SELECT (event_type = 'error')::INTEGER::DOUBLE AS label, (value > 50)::INTEGER::DOUBLE AS prediction,
         count(*) AS n FROM events GROUP BY 1, 2),
l AS (SELECT label, sum(n) AS support, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp
      FROM c GROUP BY label),
p AS (SELECT prediction AS label, sum(n) AS predicted FROM c GROUP BY prediction),
k AS (SELECT l.label, support, tp, coalesce(predicted, 0) AS predicted FROM l LEFT JOIN p USING (label))
SELECT {sql_round('sum(support * CASE WHEN tp = 0 THEN 0.0 ELSE 2.0 * tp / (support + predicted) END)'
                  ' / sum(support)::DOUBLE', 12)} AS weighted_f1,
       {sql_round('sum(tp)::DOUBLE / sum(support)::DOUBLE', 12)} AS accuracy
FROM k
""")
def holdout_f1(spark, sf_dir):
    ev = events(spark, sf_dir)
    return weighted_f1(ev, is_error().cast("int"), (F.col("value") > 50).cast("int"))


# --- model fit and scoring -------------------------------------------------------
# The label is learnable: its boundary lies on the hour, which has fewer values than
# the trees have bins, so a fitted model must predict it exactly and SQL can say what.

NUMERIC = ["value", "k", "hour"]
CATEGORICAL = ["event_type"]  # a fixed set of types, unlike user ids
LABEL = "label"
SCORED_COLUMNS = ["event_timestamp", LABEL, "predicted_delay", "user", "event_type", "value", "k"]


def event_features(df):
    """``events`` in the model's input shape (place = user, label = morning)."""
    return df.select(
        "event_id",
        event_time_of(df, "ts").alias("event_timestamp"),
        F.col("user_id").cast("string").alias("user"),
        "event_type",
        (F.hour("ts") < 12).cast("int").alias(LABEL),
        "value",
        F.from_json("props", "k int")["k"].alias("k"),
        F.hour("ts").alias("hour"),
    )


def fit_event_model(spark, sf_dir, classifier="gbt"):
    ev = event_features(events(spark, sf_dir))
    result, _ = train_model(ev, NUMERIC, CATEGORICAL, LABEL, "event_id", classifier=classifier, hash_method="md5")
    path = scratch_path(spark, "model")
    save_model(result.model, path)
    return result, path


@register("model_scores", ("ML3", "ML4", "ML6", "ML8", "ML12", "SRC8", "SNK6"), sql=f"""
SELECT ts AS event_timestamp, (hour(ts) < 12)::INTEGER AS label, (hour(ts) < 12)::INTEGER::DOUBLE AS predicted_delay,
       user_id::VARCHAR AS user, event_type, value, json_extract_string(props, '$.k')::INTEGER::DOUBLE AS k
FROM events WHERE {sql_unit('event_id', SPLIT_SEED)} >= 0.8
""")
def model_scores(spark, sf_dir):
    """Fit on the balanced training split, save, load and score the hold-out."""
    _, path = fit_event_model(spark, sf_dir)
    ev = event_features(events(spark, sf_dir))
    _, test = hash_split(prepare_features(ev, NUMERIC, CATEGORICAL, label=LABEL, drop_null_label=True),
                         "event_id", (0.8, 0.2), method="md5")
    out = score(test, path, SCORED_COLUMNS, on_missing="error")
    return out.withColumn("event_timestamp", instant_to_ntz("event_timestamp"))


SCORED_SOURCE = """SELECT ts, user_id::VARCHAR AS airport_name, (hour(ts) < 12)::INTEGER AS label,
       (hour(ts) < 12)::INTEGER::DOUBLE AS pred, value AS lat,
       json_extract_string(props, '$.k')::INTEGER::DOUBLE AS lon FROM events"""


@register("stream_scored_quality", ("STR11", "ML12", "AGG11", "SRC8"),
          sql=quality_sql(QUALITY, "WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 3 MINUTE",
                          SCORED_SOURCE))
def stream_scored_quality(spark, sf_dir):
    """Score the event stream with a freshly fitted and saved model, then
    windowed prediction quality per user, read back from the per-batch files."""
    _, path = fit_event_model(spark, sf_dir)
    from tarmac.plans.streams import QUALITY_RESULT_SCHEMA, stage_events

    root, src, schema, per_batch = stage_events(spark, sf_dir, "scored-stream")
    stream = stream_table(spark, src, schema, max_files=per_batch)
    prepared = prepare_features(event_features(stream), NUMERIC, CATEGORICAL, categorical_fill="N/A")
    scored = score(prepared, path, SCORED_COLUMNS, on_missing="error")
    q = window_quality(scored, QUALITY, "user", LABEL, "predicted_delay", ts="event_timestamp",
                       lat="value", lon="k", watermark="3 minutes")
    run_to_completion(quality_rows(q), f"{root}/checkpoint", writer=batch_writer(f"{root}/output"), mode="append",
                      state_partitions=state_slots(spark))
    res = read_results(spark, f"{root}/output", QUALITY_RESULT_SCHEMA, key_as_string="airport_name")
    res = dedupe(res, ["window_start", "window_end", "airport_name"], tasks=result_tasks(spark, f"{root}/output"))
    return res.withColumns({c: instant_to_ntz(c) for c in ("window_start", "window_end")})
