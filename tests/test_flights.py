"""End-to-end flight applications on generated flight-shaped data."""

import os

import pytest
from pyspark.sql import functions as F

from tarmac import flights as app
from tarmac.operators.metrics import count_by
from tarmac.roles import WindowSpec
from tarmac.schema import FLIGHT_SCHEMA, KEYED_STATISTICS_SCHEMA, SCORED_OUTPUT_COLUMNS
from tarmac.sinks.writers import batch_writer, read_upserted
from tarmac.sources.events import decode_events, encode_events
from tarmac.sources.streams import stream_table
from tarmac.streaming.runner import run_to_completion

CARRIERS = ["Delta", "United", "American", "Southwest"]
AIRPORTS = ["Atlanta", "Boston", "Chicago", "Denver", "Seattle"]


def make_flights(spark, n=3000):
    i = F.col("id")
    h = F.pmod(F.xxhash64(i), F.lit(1000)) / 1000.0
    carriers = F.array(*[F.lit(c) for c in CARRIERS])
    airports = F.array(*[F.lit(a) for a in AIRPORTS])
    df = spark.range(n).select(
        (F.pmod(F.xxhash64(i, F.lit(9)), F.lit(100)) < 8).alias("_noise"),
        (i % 12 + 1).cast("int").alias("MONTH"),
        (i % 7 + 1).cast("int").alias("DAY_OF_WEEK"),
        F.lit(None).cast("int").alias("DEP_DEL15"),
        (i % 5 + 1).cast("int").alias("DISTANCE_GROUP"),
        F.lit("0800-0859").alias("DEP_BLOCK"),
        (i % 3 + 1).cast("int").alias("SEGMENT_NUMBER"),
        (i % 40).cast("int").alias("CONCURRENT_FLIGHTS"),
        (100 + i % 100).cast("int").alias("NUMBER_OF_SEATS"),
        F.element_at(carriers, (i % 4 + 1).cast("int")).alias("CARRIER_NAME"),
        (1000 + i % 500).cast("int").alias("AIRPORT_FLIGHTS_MONTH"),
        (5000 + i % 900).cast("int").alias("AIRLINE_FLIGHTS_MONTH"),
        (300 + i % 50).cast("int").alias("AIRLINE_AIRPORT_FLIGHTS_MONTH"),
        (90000 + i % 1000).cast("int").alias("AVG_MONTHLY_PASS_AIRPORT"),
        (800000 + i % 1000).cast("int").alias("AVG_MONTHLY_PASS_AIRLINE"),
        F.lit(0.0001).cast("float").alias("FLT_ATTENDANTS_PER_PASS"),
        F.lit(0.0002).cast("float").alias("GROUND_SERV_PER_PASS"),
        (i % 25).cast("int").alias("PLANE_AGE"),
        F.element_at(airports, (i % 5 + 1).cast("int")).alias("DEPARTING_AIRPORT"),
        (30 + i % 5).cast("float").alias("LATITUDE"),
        (-80 - i % 5).cast("float").alias("LONGITUDE"),
        F.lit("NONE").alias("PREVIOUS_AIRPORT"),
        F.round(h * 2, 2).cast("float").alias("PRCP"),
        F.lit(0.0).cast("float").alias("SNOW"),
        F.lit(0.0).cast("float").alias("SNWD"),
        (40 + i % 50).cast("int").alias("TMAX"),
        (i % 15).cast("int").alias("AWND"),
        F.timestamp_seconds(F.lit(1704067200) + i * 7).alias("timestamp"),
    )
    label = ((F.col("TMAX") > 80) | (F.col("PLANE_AGE") > 19)) != F.col("_noise")
    return df.withColumn("DEP_DEL15", label.cast("int")).drop("_noise")


@pytest.fixture(scope="module")
def flights(spark):
    return make_flights(spark).cache()


def test_delay_report(spark, flights):
    out = app.delay_report(flights, month=3, carrier="Delta", spark=spark)
    assert {"delays_per_month", "top_delay_airports", "group_statistics", "weather_impact",
            "carrier_delays_per_month", "schema", "preview"} <= set(out)
    assert out["profile"].first().n_rows == 3000
    per_month = {r.MONTH: r.DelayedFlightsNum for r in out["delays_per_month"].collect()}
    assert sum(per_month.values()) == flights.filter("DEP_DEL15 = 1").count()
    assert out["weather_impact"].columns == ["avg_prcp_delayed", "avg_prcp_on_time", "avg_snow_delayed",
                                             "avg_snow_on_time", "avg_temp_delayed", "avg_temp_on_time",
                                             "avg_wind_delayed", "avg_wind_on_time"]
    assert out["delay_weather_by_month"].columns == ["MONTH", "AvgTMAX", "AvgPRCP"]
    assert out["top_delay_airports"].count() == 5
    assert out["delays_in_month"].first().MONTH == 3


def write_wire_batches(flights, folder, batches=3):
    """Flights as JSON events, split into time-ordered text files."""
    wire = encode_events(flights, FLIGHT_SCHEMA, ts_col="timestamp")
    rows = [r.value for r in wire.collect()]  # small test fixture only
    os.makedirs(folder, exist_ok=True)
    size = -(-len(rows) // batches)
    for b in range(batches):
        p = os.path.join(folder, f"part-{b:03d}.json")
        with open(p, "w") as fh:
            fh.write("\n".join(rows[b * size:(b + 1) * size]) + "\n")
        os.utime(p, (1_000_000 + b, 1_000_000 + b))
    return folder


def test_stream_statistics_into_keyed_table(spark, flights, tmp_dir):
    src = write_wire_batches(flights, os.path.join(tmp_dir, "in"))
    raw = stream_table(spark, src, "value string", fmt="text", max_files=1)
    events = decode_events(raw, FLIGHT_SCHEMA)
    payload = app.window_statistics_stream(events, WindowSpec("30 minutes"), "DEPARTING_AIRPORT", "PLANE_AGE",
                                           filters=["PRCP >= 0"])
    table = os.path.join(tmp_dir, "table")
    run_to_completion(payload, os.path.join(tmp_dir, "ckpt"),
                      writer=app.statistics_table_writer(table, spark, reset=True), mode="update")
    got = read_upserted(spark, table, ["window_start", "group_value"], KEYED_STATISTICS_SCHEMA)
    batch = flights.groupBy(F.window("timestamp", "30 minutes"), "DEPARTING_AIRPORT").agg(
        F.count("PLANE_AGE").alias("count"), F.round(F.avg("PLANE_AGE"), 2).alias("avg_value"))
    assert got.count() == batch.count()
    assert got.agg(F.sum("count")).first()[0] == 3000
    joined = got.join(batch, (got.window_start == batch.window.start) & (got.group_value == batch.DEPARTING_AIRPORT))
    assert joined.filter(got.avg_value != batch.avg_value).count() == 0


def test_train_predict_report(spark, flights, tmp_dir):
    model_path = os.path.join(tmp_dir, "model")
    result, scored = app.train_delay_model(flights, model_path)
    assert result.auc > 0.8 and 0 < result.sample_fraction <= 1.0
    assert result.model.stages[-1].getThresholds() == [0.75, 0.25]

    src = write_wire_batches(flights, os.path.join(tmp_dir, "in"))
    events = decode_events(stream_table(spark, src, "value string", fmt="text", max_files=1), FLIGHT_SCHEMA)
    rows = app.predict_stream(events, model_path, WindowSpec("30 seconds", "5 seconds"))
    out = os.path.join(tmp_dir, "predictions")
    run_to_completion(rows, os.path.join(tmp_dir, "ckpt"), writer=batch_writer(out, files=1), mode="append")
    report = app.prediction_report(spark, out)
    res = report["results"]
    assert res.count() > 0
    assert report["airport_count"].first()[0] == len(AIRPORTS)
    latest = report["latest_by_airport"]
    assert latest.count() == len(AIRPORTS) and "geometry" in latest.columns and "marker_size" in latest.columns
    # the fallback scorer keeps the schema
    missing = app.predict_stream(events, os.path.join(tmp_dir, "nope"), WindowSpec("30 seconds", "5 seconds"))
    assert missing.schema == rows.schema


def test_scored_output_shape(spark, flights, tmp_dir):
    result, _ = app.train_delay_model(flights, classifier="lr")
    from tarmac.ml.model import score
    from tarmac.operators.clean import prepare_features
    from tarmac.schema import FLIGHT_CATEGORICAL_FEATURES, FLIGHT_NUMERIC_FEATURES

    prepared = prepare_features(flights.withColumn("event_timestamp", F.col("timestamp")),
                                FLIGHT_NUMERIC_FEATURES, FLIGHT_CATEGORICAL_FEATURES)
    out = score(prepared, result.model, SCORED_OUTPUT_COLUMNS)
    assert out.columns == SCORED_OUTPUT_COLUMNS
    assert count_by(out, "DEPARTING_AIRPORT", F.col("predicted_delay") == 1.0).count() > 0
