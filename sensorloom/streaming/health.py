"""Sensor health over a stream: the newest readings per sensor, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.recent import last_n
from ..plans.models import classify_sensors, newest_first
from ..schemas import AIR
from .ingest import query_id, start
from .kept import keep, kept_rows, last_done

COLUMNS = ["sensor_id", "zone_id", "timestamp", "pm25_level"]


def _folder(base: str, query: str) -> str:
    return f"{base.rstrip('/')}/{query}"


def keep_newest(batch: DataFrame, base: str, number: int, last: int = 200) -> None:
    """Merge a micro-batch into the kept readings of its stream, at most ``last`` per sensor.

    The batch is cut to its newest readings first, and only the buckets of its sensors
    are read and rewritten.
    """
    def newest(rows: DataFrame) -> DataFrame:
        return last_n(rows, "sensor_id", newest_first("timestamp"), last)

    keep(newest(batch.select(*COLUMNS)), "sensor_id", _folder(base, query_id(batch)), number, newest)


def track_health(
    raw_air: DataFrame, base: str, checkpoint: str, every: str | None = None, last: int = 200
) -> StreamingQuery:
    """Keep the newest ``last`` readings of each sensor of a stream under ``base``."""

    def each(batch: DataFrame, number: int) -> None:
        keep_newest(batch, base, number, last)

    return start(raw_air.writeStream.foreachBatch(each), checkpoint, every)


def current_health(spark: SparkSession, base: str, query: str, n_stddev: float = 1.0) -> DataFrame:
    """Sensor health as of the last finished micro-batch of a stream, by its query id.

    A bucket's version goes when a newer one has been readable for a whole micro-batch;
    a read that lasts longer than that fails, and never returns part of the sensors.
    """
    path = _folder(base, query)
    schema = T.StructType([AIR.schema[c] for c in COLUMNS])
    return classify_sensors(kept_rows(spark, path, schema, last_done(spark, path)), n_stddev)
