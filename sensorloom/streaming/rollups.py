"""Hourly models, their join and activity runs on streams.

``keep_runs`` keeps a table that at any time equals the batch result over all readings
taken in so far, open runs and late readings included; ``hours.keep_hours`` does so for
the hourly models. The append streams emit each hour or run once, when the watermark has
passed it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numeric import round_numeric
from ..operators.rollup import hourly_rollup
from .ingest import query_id, start
from .kept import keep, kept_rows, last_done


def hourly_stream(
    raw: DataFrame, model: Callable[[DataFrame], DataFrame], delay: str = "1 hour"
) -> DataFrame:
    """An hourly model over a stream of readings.

    An hour is final, and emitted in append mode, once the newest reading is
    ``delay`` past its end. Readings later than that are dropped here; a batch run
    of the same model over the raw table still counts them.
    """
    return model(raw.withWatermark("timestamp", delay))


def joined_hours_stream(raw_traffic: DataFrame, raw_air: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Traffic totals and mean PM2.5 of the hours both streams have, once final in both.

    Two aggregates joined on their own key are one aggregate over both inputs that
    keeps the hours seen on both sides: one shuffle and one state store instead of
    the two of the aggregates and the four of a stream join. The slower stream's
    watermark decides. Correlate what it has written with ``correlate_hours``.
    """
    key = ["zone_id", "timestamp"]
    traffic = raw_traffic.withWatermark("timestamp", delay).select(
        *key, F.lit(True).alias("of_traffic"), "vehicle_count", F.lit(None).cast("double").alias("pm25_level")
    )
    air = raw_air.withWatermark("timestamp", delay).select(
        *key, F.lit(False).alias("of_traffic"), F.lit(None).cast("int").alias("vehicle_count"), "pm25_level"
    )
    hours = hourly_rollup(
        traffic.unionByName(air),
        [
            F.sum("vehicle_count").alias("total_vehicles"),
            round_numeric(F.avg("pm25_level"), 2).alias("avg_pm25"),
            F.count_if("of_traffic").alias("_traffic"),
            F.count("*").alias("_all"),
        ],
    )
    both = (F.col("_traffic") > 0) & (F.col("_traffic") < F.col("_all"))
    return hours.filter(both).select("zone_id", "hour", "total_vehicles", "avg_pm25")


def append_files(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append a stream's final rows to files, exactly once."""
    return start(stream.writeStream.outputMode("append").format("parquet").option("path", path), checkpoint, every)


def activity_sessions(raw: DataFrame, max_gap: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Unbroken runs of readings per sensor: a run is emitted when the sensor has gone silent.

    Readings more than ``max_gap`` apart are in two runs. The state holds one row per
    open run. With ``spark_session()``'s settings readings are merged into runs in each
    task first, so a hot sensor does not send all its readings to one.
    """
    runs = raw.withWatermark("timestamp", delay).groupBy(
        "sensor_id", F.session_window("timestamp", max_gap).alias("run")
    )
    return runs.agg(
        F.count("*").alias("readings"), F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen")
    ).select("sensor_id", "readings", "first_seen", "last_seen")


RUNS = "sensor_id string, readings bigint, first_seen timestamp, last_seen timestamp"


def keep_runs(
    raw: DataFrame, base: str, checkpoint: str, max_gap: str = "1 hour", every: str | None = None
) -> StreamingQuery:
    """Keep all unbroken runs of readings per sensor, those still open included.

    A micro-batch is cut into runs, which join what is kept of its sensors: a late reading
    extends runs or closes the gap between two.
    """
    gap = F.expr(f"INTERVAL {max_gap}")

    def joined(runs: DataFrame) -> DataFrame:
        order = W.partitionBy("sensor_id").orderBy("first_seen", "last_seen")
        past = F.max("last_seen").over(order.rowsBetween(W.unboundedPreceding, -1))
        opens = F.when(F.col("first_seen") <= past + gap, 0).otherwise(1)
        numbered = runs.withColumn("_opens", opens).withColumn("_run", F.sum("_opens").over(order))
        return numbered.groupBy("sensor_id", "_run").agg(
            F.sum("readings").alias("readings"), F.min("first_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"),
        ).drop("_run")

    def each(batch: DataFrame, number: int) -> None:
        runs = batch.groupBy("sensor_id", F.session_window("timestamp", max_gap).alias("run")).agg(
            F.count("*").alias("readings"), F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen")
        )
        keep(runs.drop("run"), "sensor_id", f"{base.rstrip('/')}/{query_id(batch)}", number, joined)

    return start(raw.writeStream.foreachBatch(each), checkpoint, every)


def current_runs(spark: SparkSession, base: str, query: str) -> DataFrame:
    """The runs of a ``keep_runs`` stream as of its last finished micro-batch, by its query id."""
    path = f"{base.rstrip('/')}/{query}"
    return kept_rows(spark, path, RUNS, last_done(spark, path))
