"""Every registered query against its SQL counterpart."""

import os

import pytest
from compare import oracle_rows, spark_rows

import __spark_entry__ as entry
from sensorloom import entry_oracles, entry_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLES = entry_queries.QUERIES, entry_oracles.oracle_sql()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == oracle_rows(ORACLES[name], SF_DIR)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


ZONED = ["air_quality_hourly", "sensor_health", "table_refreshed_days", "table_time_range", "expected_air",
         "stream_air_quality_hourly", "message_roundtrip", "panel_recent_energy"]


@pytest.mark.parametrize("name", ZONED)
def test_session_time_zone_does_not_matter(spark, name):
    """Half-hour zones would shift hours and days if any helper used the session's zone."""
    small = "/root/testdata/sf0.001"
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        got = spark_rows(QUERIES[name](spark, small))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == oracle_rows(ORACLES[name], small)
