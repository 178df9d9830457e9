"""Time helpers where the session's clocks change."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorloom.functions import times
from sensorloom.operators.silence import reading_gaps, silent_sensors
from sensorloom.plans import models, panels

# New York skips 02:00-03:00 on 10 March 2024 and repeats 01:00-02:00 on 3 November.
WALLS = ["2024-03-10 01:59:59.999999", "2024-03-10 02:30:00", "2024-03-10 03:00:00", "2024-03-10 06:59:59.5",
         "2024-03-10 07:00:00", "2024-11-03 01:30:00", "2024-11-03 05:30:00", "2024-11-03 06:30:00",
         "1969-12-31 23:59:59.25", "2024-01-01 00:00:00.00012"]


@pytest.fixture(params=["America/New_York", "Asia/Kolkata"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def instants(spark):
    df = spark.createDataFrame([(w,) for w in WALLS], "text string")
    return df.withColumn("wall", F.col("text").cast("timestamp_ntz")).withColumn(
        "instant", times.as_utc_instant(F.col("wall"))
    )


def seconds(text):
    wall = dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)
    return (wall - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)


def test_instants_and_walls(spark, zone):
    rows = instants(spark).select(
        "text", "wall", F.unix_micros("instant").alias("micros"), times.as_utc_ntz(F.col("instant")).alias("back"),
        times.utc_day(F.col("instant")).alias("day"), times.utc_hour(F.col("instant")).alias("hour"),
        times.iso_timestamp(F.col("instant")).alias("iso"), times.iso_timestamp(F.col("wall"), True).alias("iso_wall"),
    ).collect()
    for row in rows:
        wall = dt.datetime.fromisoformat(row.text)
        assert row.micros == seconds(row.text)
        assert row.back == row.wall == wall
        assert (row.day, row.hour) == (wall.date(), wall.hour)
        assert row.iso == row.iso_wall == wall.replace(tzinfo=dt.timezone.utc).isoformat()


def test_differences(spark, zone):
    raw = instants(spark).select(F.lit("s").alias("sensor_id"), F.col("instant").alias("timestamp"), "wall")
    now = dt.datetime(2024, 11, 4)
    row = silent_sensors(raw, now, dt.timedelta(hours=1)).head()
    assert row.silent_seconds == 17.5 * 3600
    gaps = {r.gap_seconds for r in reading_gaps(raw, dt.timedelta(minutes=55)).collect()}
    walls = {r.gap_seconds for r in reading_gaps(raw.drop("timestamp").withColumnRenamed("wall", "timestamp"),
                                                 dt.timedelta(minutes=55)).collect()}
    micros = sorted(seconds(w) for w in WALLS)
    assert gaps == walls == {(b - a) / 1e6 for a, b in zip(micros, micros[1:]) if b - a > 55 * 60 * 1000000}


def test_hours_and_days_of_models(spark, zone):
    raw = instants(spark).select(
        F.col("instant").alias("timestamp"), F.lit("z").alias("zone_id"), F.lit(1.0).alias("kwh_consumed"),
        F.lit(1.0).alias("peak_demand_kw"),
    )
    hours = models.energy_hourly(raw).select(times.as_utc_ntz(F.col("hour")).alias("hour")).collect()
    assert {r.hour for r in hours} == {
        dt.datetime.fromisoformat(w).replace(minute=0, second=0, microsecond=0) for w in WALLS
    }
    # Two days are 48 hours across the change.
    panel = panels.recent_energy(raw, now=dt.datetime(2024, 3, 12, 2, 30), horizon=dt.timedelta(days=2))
    assert panel.count() == sum("2024-03-10 02:30:00" < w for w in WALLS)
