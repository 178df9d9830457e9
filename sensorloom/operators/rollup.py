"""Hourly rollup shared by the batch models and the streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import EPOCH, is_ntz


def hourly_rollup(
    df: DataFrame, aggs: Sequence[Column], keys: Sequence[str] = ("zone_id",), ts: str = "timestamp"
) -> DataFrame:
    """Aggregate readings per key and UTC hour: ``keys, hour, aggs``.

    The hour is the start of a tumbling window on epoch time: plain long
    arithmetic, the same in every session time zone. Every aggregate has a partial
    form, so a task ships one row per (key, hour) it saw, however many readings a
    hot zone has. A batch result is partitioned by (keys, hour), as joins of hourly
    models on these columns want it, and rows without a time are a group of their own,
    with a NULL hour. A stream is grouped by the window itself, which carries its
    watermark; there such a row is in no hour.
    """
    if not df.isStreaming:
        # A window drops rows without a time, so they get one here and lose its hour again.
        some = F.expr(EPOCH) if is_ntz(df, ts) else F.timestamp_seconds(F.lit(0))
        timed = df.withColumn("_hour", F.window(F.coalesce(F.col(ts), some), "1 hour").getField("start"))
        hours = timed.withColumn("hour", F.when(F.col(ts).isNotNull(), F.col("_hour"))).drop("_hour")
        return hours.groupBy(*keys, "hour").agg(*aggs)
    window = F.window(ts, "1 hour")
    buckets = df.groupBy(*keys, window.alias("bucket")).agg(*aggs)
    values = [c for c in buckets.columns if c not in (*keys, "bucket")]
    return buckets.select(*keys, F.col("bucket.start").alias("hour"), *values)
