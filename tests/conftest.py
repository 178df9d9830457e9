from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from sensorloom.session import spark_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = spark_session(
        "tests",
        spark__master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def air(spark):
    """Build a raw air table from (timestamp text, sensor, zone, pm25) rows."""
    from pyspark.sql import functions as F

    def make(rows):
        df = spark.createDataFrame(rows, "ts string, sensor_id string, zone_id string, pm25_level double")
        level = F.col("pm25_level")
        return df.select(
            F.col("ts").cast("timestamp").alias("timestamp"), "sensor_id", "zone_id",
            (level * 0.01).alias("co_level"), (level + 10).alias("no2_level"), "pm25_level",
            (level + 20).alias("o3_level"),
        )

    return make
