"""Sensors that stopped reporting, and gaps in what they reported."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.times import is_ntz, moment, seconds_between

# Cells of a sensor that are sorted in one window; a task's sort is bounded by it, however long the span.
CELLS = 4096


def silent_sensors(
    raw: DataFrame,
    now: Column | datetime | None = None,
    max_gap: timedelta = timedelta(hours=1),
    ts: str = "timestamp",
) -> DataFrame:
    """Sensors whose newest reading is more than ``max_gap`` before ``now``."""
    ntz = is_ntz(raw, ts)
    now = moment(F.current_timestamp() if now is None else now, ntz)
    return (
        raw.groupBy("sensor_id")
        .agg(F.max(ts).alias("last_seen"))
        .withColumn("silent_seconds", seconds_between(F.col("last_seen"), now, ntz))
        .filter(F.col("silent_seconds") > max_gap.total_seconds())
    )


def reading_gaps(
    raw: DataFrame, max_gap: timedelta = timedelta(hours=1), ts: str = "timestamp", cells: int = CELLS
) -> DataFrame:
    """Past stretches longer than ``max_gap`` without a reading, per sensor.

    Readings are first reduced to the oldest and newest per cell of width
    ``max_gap``. Two readings of one cell are closer than that, so every gap runs
    from one cell's newest reading to the next cell's oldest. Cells are sorted per
    sensor and block of ``cells`` cells, so one sensor's span is spread over tasks;
    a second sort per sensor joins the blocks and sees two rows of each.
    """
    micros = max_gap // timedelta(microseconds=1)
    ntz = is_ntz(raw, ts)
    spans = raw.groupBy("sensor_id", F.window(ts, f"{micros} microseconds").alias("cell")).agg(
        F.min(ts).alias("oldest"), F.max(ts).alias("newest")
    )
    spans = spans.withColumn("block", F.window("cell.start", f"{micros * cells} microseconds")["start"])
    inside = W.partitionBy("sensor_id", "block").orderBy("oldest")
    spans = spans.select(
        "sensor_id", "block", "oldest", "newest",
        F.lag("newest").over(inside).alias("before"), F.lead("oldest").over(inside).alias("after"),
    )
    # A block's first and last cells meet those of the other blocks; of the rest, only gaps go on, in their own block.
    edge = F.col("before").isNull() | F.col("after").isNull()
    long = seconds_between(F.col("before"), F.col("oldest"), ntz) > max_gap.total_seconds()
    spans = spans.filter(edge | long).withColumn("block", F.when(~edge, F.col("block")))
    across = W.partitionBy("sensor_id", "block").orderBy("oldest")
    start = F.coalesce("before", F.lag("newest").over(across))
    gaps = spans.select("sensor_id", start.alias("gap_start"), F.col("oldest").alias("gap_end"))
    seconds = seconds_between(F.col("gap_start"), F.col("gap_end"), ntz)
    return gaps.withColumn("gap_seconds", seconds).filter(F.col("gap_seconds") > max_gap.total_seconds())
