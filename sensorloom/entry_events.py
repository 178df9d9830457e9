"""Raw tables derived from an ``events`` table, for the registered queries.

Users stand in for sensors: four zones, three sensors each. One air sensor reads
zero, one reads three times too high and one falls silent near the end, as
FIXTURES.md specifies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.times import as_utc_instant, is_ntz
from .session import scratch_dir

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)

DEAD_UNIT, SILENT_UNIT, DRIFT_UNIT = 1, 2, 3
SILENT_FROM = "2024-01-25 00:00:00"


def _unit() -> Column:
    return F.col("user_id") % 12


def _identity(kind: str) -> list[Column]:
    zone = F.concat(F.lit("zone_"), F.substring(F.lit("abcd"), (F.col("user_id") % 4).cast("int") + 1, F.lit(1)))
    number = (F.floor(_unit() / 4) + 1).cast("string")
    return [
        F.col("ts").alias("timestamp"),
        F.concat(F.lit(f"sensor_{kind}_"), zone, F.lit("_0"), number).alias("sensor_id"),
        zone.alias("zone_id"),
    ]


def _silent_from(events: DataFrame) -> Column:
    if is_ntz(events, "ts"):
        return F.expr(f"TIMESTAMP_NTZ '{SILENT_FROM}'")
    return F.expr(f"TIMESTAMP '{SILENT_FROM}+00:00'")


def air_from_events(events: DataFrame) -> DataFrame:
    value = F.col("value")
    silent = (_unit() == SILENT_UNIT) & (F.col("ts") >= _silent_from(events))
    pm25 = F.when(_unit() == DEAD_UNIT, 0.0).when(_unit() == DRIFT_UNIT, value * 3.0).otherwise(value)
    return events.filter(F.col("event_type").isin("view", "click", "error") & ~silent).select(
        *_identity("air"),
        (value * 0.01).alias("co_level"),
        (value + 10.0).alias("no2_level"),
        pm25.alias("pm25_level"),
        (value + 20.0).alias("o3_level"),
    )


def traffic_from_events(events: DataFrame) -> DataFrame:
    value = F.col("value")
    return events.filter(F.col("event_type").isin("click", "purchase", "signup", "error")).select(
        *_identity("traffic"),
        F.floor(value * 4.0).cast("int").alias("vehicle_count"),
        F.greatest(F.lit(5.0), 60.0 - value / 10.0).alias("avg_speed_kmh"),
    )


def energy_from_events(events: DataFrame) -> DataFrame:
    value = F.col("value")
    return events.select(
        *_identity("energy"), value.alias("kwh_consumed"), (value * 1.2).alias("peak_demand_kw")
    )


def raw_from_events(events: DataFrame) -> dict[str, DataFrame]:
    """The three raw tables, batch or streaming as ``events`` is."""
    return {
        "raw_air_quality": air_from_events(events),
        "raw_traffic": traffic_from_events(events),
        "raw_energy": energy_from_events(events),
    }


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


#: Micro-batches that a stream of the events takes, about.
BATCHES = 12


def stream_events(spark: SparkSession, sf_dir: str, copies: int = 1) -> DataFrame:
    """The same table as a stream of about a dozen micro-batches, with ``ts`` as an instant.

    The batches hold days that lie far apart and come in no order. With two copies,
    each event comes again in another batch. A batch has a file per core: small files
    aren't split, and fewer would leave its decoding to fewer tasks.
    """
    events, folder = read_events(spark, sf_dir), scratch_dir(spark, "events")
    cores = spark.sparkContext.defaultParallelism
    days = [F.pmod(F.dayofmonth("ts") + 5 * copy, F.lit(BATCHES)) for copy in range(copies)]
    parts = events.withColumn("part", F.explode(F.array(*days)))
    parts.repartition(cores).write.partitionBy("part").parquet(folder)
    files = len(spark.read.parquet(folder).inputFiles())
    reader = spark.readStream.schema(f"{EVENTS_SCHEMA}, part int").option("maxFilesPerTrigger", max(1, files // BATCHES))
    return reader.parquet(folder).drop("part").withColumn("ts", as_utc_instant(F.col("ts")))
