"""Flight-shaped unit tests for the batch operators, JSON codec and cleaning."""

import pytest
from pyspark.sql import functions as F

from flights import FIELD_NAMES, edge_records, record, wire
from tarmac.operators import metrics as M
from tarmac.operators.clean import coerce_rows, prepare_features
from tarmac.operators.dedupe import dedupe, latest_by
from tarmac.operators.profile import missing_audit, profile, schema_table
from tarmac.roles import WindowSpec, require_columns
from tarmac.schema import FLIGHT_CATEGORICAL_FEATURES, FLIGHT_NUMERIC_FEATURES, FLIGHT_SCHEMA
from tarmac.sources.events import decode_events, encode_events, reduce_schema


@pytest.fixture()
def flights(spark):
    raw = spark.createDataFrame([(v,) for v in wire(edge_records())], "value string")
    return decode_events(raw, FLIGHT_SCHEMA, event_time="timestamp")


def test_decode_edge_rows(flights):
    rows = flights.collect()
    assert len(rows) == 9
    assert flights.columns == FIELD_NAMES + ["event_timestamp"]
    blank = [r for r in rows if r.CARRIER_NAME == "United" and r.DEPARTING_AIRPORT == "Boston"][0]
    assert blank.TMAX is None and blank.PLANE_AGE == 5  # blank field alone is NULL
    frac = [r for r in rows if r.DEPARTING_AIRPORT == "Chicago" and r.CARRIER_NAME == "United"][0]
    assert frac.TMAX is None  # undecoded fraction in an int field
    malformed = [r for r in rows if r.MONTH is None]
    assert len(malformed) == 1 and all(v is None for v in malformed[0])
    assert str(rows[0].timestamp) == "2024-01-01 00:00:00"


def test_encoder_casts_before_sending(spark):
    # A raw string row (CSV read without inference) with a fraction in an int field.
    raw = spark.createDataFrame([("65.7", "", "Delta", "0.25")], "TMAX string, PLANE_AGE string, CARRIER_NAME string,"
                                                             " PRCP string")
    enc = encode_events(raw, FLIGHT_SCHEMA)
    text = enc.first().value
    assert '"TMAX":65' in text and "PLANE_AGE" not in text
    back = decode_events(enc, FLIGHT_SCHEMA).first()
    assert back.TMAX == 65 and back.PLANE_AGE is None and abs(back.PRCP - 0.25) < 1e-6


def test_reduced_schema(spark):
    s = reduce_schema(FLIGHT_SCHEMA, ["TMAX", "CARRIER_NAME"])
    assert s.fieldNames() == ["CARRIER_NAME", "TMAX"]
    with pytest.raises(ValueError):
        reduce_schema(FLIGHT_SCHEMA, ["NOPE"])


def test_count_by_and_top_n_ties(flights):
    by_carrier = M.count_by(flights, "CARRIER_NAME", "DEP_DEL15").collect()
    assert [(r[0], r[1]) for r in by_carrier] == [(None, 1), ("Delta", 2), ("Solo", 1)]
    # two airports tie with one delayed flight each at the cut: the lower key wins
    top = M.top_n_by(flights, "DEPARTING_AIRPORT", "DEP_DEL15", n=2).collect()
    assert [(r[0], r[1]) for r in top] == [("Atlanta", 1), ("Boston", 1)]
    filtered = M.count_by(flights, "MONTH", "DEP_DEL15", where=["CARRIER_NAME == 'Delta'", "MONTH = 1"]).collect()
    assert [(r[0], r[1]) for r in filtered] == [(1, 2)]
    assert M.count_by(flights, None, "DEP_DEL15").count() == 4


def test_group_stats_single_row_group_and_missing_column(flights):
    stats = {r.CARRIER_NAME: r for r in M.group_stats(flights, "CARRIER_NAME", "PLANE_AGE").collect()}
    assert stats["Solo"].stddev_PLANE_AGE is None and stats["Solo"].total_records == 1
    assert stats["Delta"].total_records == 3 and stats["Delta"].average_PLANE_AGE == 10.33
    with pytest.raises(ValueError):
        M.group_stats(flights, "NOPE", "PLANE_AGE")


def test_contrast_one_pass_equals_two_scans(flights):
    one = M.contrast(flights, "DEP_DEL15", ["PRCP", "PLANE_AGE"]).first().asDict()
    d = flights.filter("DEP_DEL15 = 1").agg(F.round(F.avg("PRCP"), 2), F.round(F.avg("PLANE_AGE"), 2)).first()
    o = flights.filter("DEP_DEL15 = 0").agg(F.round(F.avg("PRCP"), 2), F.round(F.avg("PLANE_AGE"), 2)).first()
    assert (one["avg_PRCP_delayed"], one["avg_PLANE_AGE_delayed"]) == (d[0], d[1])
    assert (one["avg_PRCP_on_time"], one["avg_PLANE_AGE_on_time"]) == (o[0], o[1])


def test_class_balance_fraction_capped(spark):
    df = spark.createDataFrame([(1,)] * 9 + [(0,)], "y int")
    r = M.class_balance(df, "y").first()
    assert (r.n_positive, r.n_negative, r.sample_fraction) == (9, 1, 1.0)
    none_neg = M.class_balance(spark.createDataFrame([(1,)], "y int"), "y").first()
    assert none_neg.sample_fraction is None


def test_prepare_features_shared_for_train_and_score(flights):
    train = prepare_features(flights, FLIGHT_NUMERIC_FEATURES, FLIGHT_CATEGORICAL_FEATURES, label="DEP_DEL15",
                             drop_null_label=True)
    serve = prepare_features(flights, FLIGHT_NUMERIC_FEATURES, FLIGHT_CATEGORICAL_FEATURES)
    assert train.count() == 7 and serve.count() == 9  # null label and malformed row dropped only for training
    types = dict(train.dtypes)
    assert all(types[c] == "double" for c in FLIGHT_NUMERIC_FEATURES) and types["DEP_DEL15"] == "int"
    assert dict(serve.dtypes)["LATITUDE"] == dict(train.dtypes)["LATITUDE"]
    assert serve.filter(F.col("CARRIER_NAME") == "N/A").count() == 2
    assert serve.filter(F.col("TMAX").isNull()).count() == 0


def test_coerce_rows_truncates(spark):
    df = spark.createDataFrame([("65.7", "1.5", ""), ("-3.9", "x", "7")], "a string, b string, c string")
    from pyspark.sql import types as T

    s = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType()),
                      T.StructField("c", T.IntegerType())])
    assert [tuple(r) for r in coerce_rows(df, s).collect()] == [(65, 1.5, None), (-3, None, 7)]


def test_profile_and_audit(flights, spark):
    assert profile(flights).first().asDict() == {"n_rows": 9, "n_columns": 28}
    audit = missing_audit(flights).first().asDict()
    assert audit["DEP_DEL15"] == 2 and audit["TMAX"] == 3 and audit["CARRIER_NAME"] == 2
    st = schema_table(spark, flights)
    assert st.count() == 28 and st.first().column_name == "MONTH"


def test_dedupe_and_latest(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 1, 5.0), ("a", 2, 1.0), ("b", 1, 3.0), ("b", 1, 2.0)],
                               "k string, t int, v double")
    d = sorted(tuple(r) for r in dedupe(df, ["k", "t"]).collect())
    assert d == [("a", 1, 5.0), ("a", 2, 1.0), ("b", 1, 2.0)]  # deterministic survivor
    latest = sorted(tuple(r) for r in latest_by(df, "k", "t").collect())
    assert latest == [("a", 2, 1.0), ("b", 1, 3.0)]


def test_window_spec_validation():
    assert WindowSpec("30 seconds").slide_seconds == 30
    assert WindowSpec(30, 5).copies_per_row == 6
    with pytest.raises(ValueError):
        WindowSpec("30 seconds", "60 seconds")
    with pytest.raises(ValueError):
        WindowSpec("30 parsecs")
    with pytest.raises(ValueError):
        WindowSpec("30 seconds", "5 seconds", kind="tumbling")


def test_require_columns(flights):
    with pytest.raises(ValueError, match="NOPE"):
        require_columns(flights, "MONTH", "NOPE")


def test_preview_is_deterministic(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = [r.k for r in M.preview(df, 5, "k").collect()]
    b = [r.k for r in M.preview(df.repartition(7), 5, "k").collect()]
    assert a == b and len(set(a)) == 5


def test_apply_filters_on_sql_equality(flights):
    out = M.apply_filters(flights, ["PRCP > 0", "CARRIER_NAME=='Delta'"])
    assert out.count() == 2


def test_record_helper_shape():
    assert set(record()) == set(FIELD_NAMES)


@pytest.mark.parametrize("duration,slide", [("1 hour", "10 minutes"), ("50 minutes", "20 minutes")])
def test_pane_windows_equal_expanded_windows(spark, duration, slide):
    from tarmac.operators.windows import window_quality, window_stats

    df = spark.range(20000).select(
        (F.timestamp_seconds(F.lit(1704067200) + (F.col("id") * 37) % 86400)).alias("ts"),
        (F.col("id") % 3).cast("string").alias("k"),
        F.round((F.col("id") * 7919 % 1000) / 10.0, 2).alias("v"),
        F.when(F.col("id") % 11 == 0, None).otherwise((F.col("id") % 2).cast("int")).alias("y"),
    )
    spec = WindowSpec(duration, slide)
    for decimals in (None, 2):
        a = window_stats(df, spec, "k", "v", ts="ts", mean_decimals=decimals, method="panes")
        b = window_stats(df, spec, "k", "v", ts="ts", mean_decimals=decimals, method="expand")
        assert a.count() == b.count()
        diff = a.alias("a").join(b.alias("b"), ["window", "k"]).filter(
            (F.col("a.min_value") != F.col("b.min_value")) | (F.col("a.max_value") != F.col("b.max_value"))
            | (F.col("a.count") != F.col("b.count")) | (F.abs(F.col("a.avg_value") - F.col("b.avg_value")) > 0.011)
            | (F.abs(F.col("a.std_value") - F.col("b.std_value")) > 0.011))
        assert diff.count() == 0
    qa = window_quality(df, spec, "k", "y", (F.col("v") > 50).cast("double"), ts="ts", lat="v", watermark=None,
                        method="panes")
    qb = window_quality(df, spec, "k", "y", (F.col("v") > 50).cast("double"), ts="ts", lat="v", watermark=None,
                        method="expand")
    assert qa.exceptAll(qb.select(*qa.columns)).count() == 0 and qa.count() == qb.count()


def test_panes_on_streams_are_chained(spark, tmp_dir):
    from tarmac.operators.windows import window_stats

    spark.range(3).selectExpr("timestamp_seconds(id) AS ts", "'a' AS k", "1.0 AS v").write.parquet(tmp_dir + "/p")
    stream = spark.readStream.schema("ts timestamp, k string, v double").parquet(tmp_dir + "/p")
    spec = WindowSpec("10 seconds", "5 seconds")

    def aggregates(method):
        df = window_stats(stream, spec, "k", "v", ts="ts", watermark="1 minute", method=method)
        assert df.isStreaming
        return df._jdf.queryExecution().analyzed().toString().count("Aggregate [")

    assert aggregates("panes") == 2 and aggregates("auto") == aggregates("expand") == 1


@pytest.mark.parametrize("method", ["panes", "expand"])
def test_window_count_properties(spark, method):
    from tables import SF_SMALL
    from tarmac.operators.windows import window_stats

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    n = ev.count()
    tumbling = window_stats(ev, WindowSpec("1 hour"), "event_type", "value", ts="ts", method=method)
    assert tumbling.agg(F.sum("count")).first()[0] == n
    sliding = window_stats(ev, WindowSpec("1 hour", "10 minutes"), "event_type", "value", ts="ts", method=method)
    assert sliding.agg(F.sum("count")).first()[0] == n * 6


@pytest.mark.parametrize("method", ["panes", "expand"])
def test_zero_total_window_has_null_accuracy(spark, method):
    from tarmac.operators.windows import quality_rows, window_quality

    df = spark.createDataFrame(
        [("2024-01-01 00:00:01", "ATL", None, 1.0), ("2024-01-01 00:00:02", "ATL", None, 0.0),
         ("2024-01-01 00:01:01", "BOS", 1, 1.0), ("2024-01-01 00:01:02", "BOS", 0, 1.0),
         ("2024-01-01 00:02:01", "CHI", 1, 1.0), ("2024-01-01 00:02:02", "CHI", None, 1.0)],
        "ts string, place string, y int, p double").withColumn("ts", F.to_timestamp("ts"))
    q = quality_rows(window_quality(df, WindowSpec("30 seconds", "10 seconds"), "place", "y", "p", ts="ts",
                                    watermark=None, method=method))
    atl = q.filter("airport_name = 'ATL'").collect()
    assert atl and all(r.total_flights == 0 and r.accuracy_percent is None for r in atl)
    bos = q.filter("airport_name = 'BOS'").collect()
    assert {r.accuracy_percent for r in bos} == {50.0} and {r.predicted_delays_count for r in bos} == {2.0}
    # a NULL label is left out of the total and never counts as correct
    chi = q.filter("airport_name = 'CHI'").collect()
    assert {(r.total_flights, r.actual_delays, r.accuracy_percent) for r in chi} == {(1, 1, 100.0)}


def test_count_by_dimensions_with_null_keys(flights):
    got = [(r.dimension, r.value, r.DelayedFlightsNum) for r in
           M.count_by_dimensions(flights, ["CARRIER_NAME", "MONTH"], "DEP_DEL15").collect()]
    # null carrier is its own group; malformed rows never reach the label filter
    assert ("CARRIER_NAME", None, 1) in got and ("CARRIER_NAME", "Delta", 2) in got
    assert ("MONTH", "1", 4) in got and len(got) == 4


def test_large_mean_small_spread_stays_accurate(spark):
    """Values ~1.7e9 apart by a few units: a double sum-of-squares variance would
    cancel; auto keeps the stable form for doubles, exact decimals for fixed point."""
    from tarmac.operators.windows import window_stats

    df = spark.range(6000).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("ts"), F.lit("k").alias("k"),
        (F.lit(1704067200.0) + (F.col("id") % 7) + (F.col("id") % 3) / 100.0).alias("v"))
    spec = WindowSpec("10 minutes", "2 minutes")
    truth = {r.window.start: r.s for r in df.groupBy(F.window("ts", "10 minutes", "2 minutes").alias("window"))
             .agg(F.round(F.stddev_samp("v"), 2).alias("s")).collect()}
    for decimals in (None, 2):
        got = window_stats(df, spec, "k", "v", ts="ts", mean_decimals=decimals)
        for r in got.collect():
            assert r.std_value == truth[r.window.start], (decimals, r)


@pytest.mark.parametrize("decimals, values", [
    (4, [1e-4, 3e-4, 7e-4]), (2, [0.0, 0.0, 0.01]), (0, [1.0, 5.0, 9.0]), (6, [1e-6, 2e-6, 4e-6]), (2, [1e15, 3e15, 6e15]),
    (1, [5e17, 5e17, 1.0]), (3, [1.5]), (2, [None, None])])
def test_pane_stddev_equals_expanded(spark, decimals, values):
    """Small values, large sums and lone rows: merged panes give what expanded rows give."""
    from tarmac.operators.windows import window_stats

    rows = [(i * 250, v) for i, v in enumerate(values * 4)]
    df = spark.createDataFrame(rows, "s long, v double").select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("s")).alias("ts"), F.lit("k").alias("k"), "v")
    spec = WindowSpec("10 minutes", "2 minutes")
    got = {m: {r.window.start: r for r in window_stats(df, spec, "k", "v", ts="ts", scale=9, mean_decimals=decimals,
                                                       method=m).collect()} for m in ("panes", "expand")}
    assert got["panes"].keys() == got["expand"].keys()
    for w, r in got["panes"].items():
        e = got["expand"][w]
        assert (r.min_value, r.max_value, r["count"]) == (e.min_value, e.max_value, e["count"])
        for a, b in ((r.std_value, e.std_value), (r.avg_value, e.avg_value)):
            assert a == b or abs(a - b) <= max(1e-9, 1e-9 * abs(b)), (w, r, e)


def test_exact_fixed_point_mean_on_half_ties(spark):
    # 53.62 and 30.61 average to 42.115 exactly, but to 42.114999999999995 in doubles
    df = spark.createDataFrame([("a", 53.62, 1), ("a", 30.61, 1)], "k string, v double, y int").coalesce(1)
    assert M.group_stats(df, "k", "v").first().average_v == 42.11
    assert M.group_stats(df, "k", "v", mean_decimals=2).first().average_v == 42.12
    assert M.contrast(df, "y", ["v"], mean_decimals=2).first().avg_v_delayed == 42.12
    assert M.avg_by_keys(df, ["k"], "v", mean_decimals=2).first().avg_v == 42.12
    assert M.avg_by_period(df, "k", ["v"], "y", mean_decimals=2).first().avg_v == 42.12
