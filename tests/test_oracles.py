"""Every registered query with a SQL twin must equal it (DuckDB), row for row."""

import pytest

from tables import SF_MID, SF_SMALL
from oracle_compare import compare, duck
from tarmac.plans.registry import all_queries

QUERIES = all_queries()
WITH_SQL = sorted(n for n, q in QUERIES.items() if q.sql)
# The cheap ones are also checked at the mid scale, where more groups and ties occur.
MID = [n for n in WITH_SQL if not n.startswith("stream_")]


@pytest.fixture(scope="module")
def con_small():
    return duck(SF_SMALL)


@pytest.fixture(scope="module")
def con_mid():
    return duck(SF_MID)


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_sql_small(spark, con_small, name):
    q = QUERIES[name]
    r = compare(spark, name, q.fn, q.sql, SF_SMALL, con_small)
    assert r["ok"], r


@pytest.mark.parametrize("name", MID)
def test_matches_sql_mid(spark, con_mid, name):
    q = QUERIES[name]
    r = compare(spark, name, q.fn, q.sql, SF_MID, con_mid)
    assert r["ok"], r


def test_every_inventory_id_is_covered():
    covered = {i for q in QUERIES.values() for i in q.ids}
    expected = {"AGG1", "AGG2", "AGG3", "AGG4", "AGG5", "AGG6", "AGG7", "AGG8", "AGG9", "AGG10", "AGG11",
                "AGG12", "AGG13", "AGG14", "FLT1", "FLT2", "FLT3", "FLT4", "FLT5", "SRT1", "SRT2", "SRT3",
                "SET1", "SET2", "SET3", "SET4", "PRJ2", "PRJ3", "PRJ4", "PRJ5", "PRJ6", "PRJ7", "PRJ8", "PRJ9",
                "PRJ10", "PRJ13", "PRJ14", "PRJ15", "PRJ16", "PRJ17", "PRJ18", "SRC1", "SRC4", "SRC5", "SRC6",
                "SRC8", "SNK1", "SNK2", "SNK3", "SNK4", "SNK6", "STR1", "STR2", "STR4", "STR5", "STR6", "STR9",
                "STR10", "STR11", "ML1", "ML2", "ML3", "ML4", "ML5", "ML6", "ML8", "ML9", "ML10", "ML11", "ML12"}
    assert expected <= covered, sorted(expected - covered)


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["l_partkey", "DelayedFlightsNum"]
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", ["stream_window_quality", "stream_stats_upsert", "json_round_trip",
                                  "window_stats_sliding"])
def test_time_zone_independent(spark, con_small, name):
    """Wall-clock inputs give the same windows under a half-hour-offset session zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        q = QUERIES[name]
        r = compare(spark, name, q.fn, q.sql, SF_SMALL, con_small)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["ok"], r
