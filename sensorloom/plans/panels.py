"""Dashboard reads."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import is_ntz, moment, shifted, utc_day


def recent(
    raw: DataFrame,
    value: str,
    now: Column | datetime | None = None,
    horizon: timedelta = timedelta(hours=1),
    ts: str = "timestamp",
) -> DataFrame:
    """Readings newer than ``now - horizon``, oldest first: ``time, value, zone_id``.

    On a table partitioned by day the bound is put on ``day`` as well, which is
    what prunes partitions.
    """
    ntz = is_ntz(raw, ts)
    start = shifted(moment(F.current_timestamp() if now is None else now, ntz), -horizon, ntz)
    fresh = raw.filter(F.col(ts) > start)
    if "day" in raw.columns:
        fresh = fresh.filter(F.col("day") >= utc_day(start, ntz))
    return fresh.select(F.col(ts).alias("time"), value, "zone_id").orderBy(F.asc_nulls_last("time"))


def recent_air(raw_air: DataFrame, **how) -> DataFrame:
    return recent(raw_air, "pm25_level", **how)


def recent_traffic(raw_traffic: DataFrame, **how) -> DataFrame:
    return recent(raw_traffic, "vehicle_count", **how)


def recent_energy(raw_energy: DataFrame, **how) -> DataFrame:
    return recent(raw_energy, "kwh_consumed", **how)


def sensor_health_panel(health: DataFrame) -> DataFrame:
    return health.select("sensor_id", "recent_readings", "recent_avg_pm25", "health_status").orderBy(
        F.asc_nulls_last("health_status")
    )


def correlation_panel(correlation: DataFrame) -> DataFrame:
    return correlation.select(
        "zone_id", "hours_compared", "avg_vehicles", "avg_pm25", "traffic_pm25_correlation"
    ).orderBy(F.desc_nulls_last("traffic_pm25_correlation"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` of each table."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out
