"""Readings against the zone's expected level at that time of day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import diurnal_factor, is_ntz, utc_hour

# Baseline level of every metric per zone.
ZONE_BASELINES = """
    SELECT * FROM VALUES
        ('zone_a', 0.5D, 50D, 30D, 55D, 400D, 45D, 120D, 80D),
        ('zone_b', 0.4D, 40D, 25D, 60D, 300D, 35D, 200D, 140D),
        ('zone_c', 0.6D, 45D, 40D, 50D, 250D, 50D, 350D, 260D),
        ('zone_d', 0.3D, 25D, 15D, 65D, 120D, 30D, 90D, 55D)
    AS zones(zone_id, co_level, no2_level, pm25_level, o3_level,
             vehicle_count, avg_speed_kmh, kwh_consumed, peak_demand_kw)
"""

# How a metric's expected level follows the time of day; others multiply by it.
FLAT = {"o3_level"}
SLOWED = {"avg_speed_kmh"}
MIN_SLOWDOWN = 0.5


def zone_baselines(spark: SparkSession) -> DataFrame:
    """The built-in zones, as a literal table whose size the planner knows."""
    return spark.sql(ZONE_BASELINES)


def _expected(metric: str, base: Column, factor: Column) -> Column:
    if metric in FLAT:
        return base
    if metric in SLOWED:
        return base / F.greatest(F.lit(MIN_SLOWDOWN), factor)
    return base * factor


def expected_levels(raw: DataFrame, zones: DataFrame | None = None, ts: str = "timestamp") -> DataFrame:
    """Add ``expected_<metric>`` and ``residual_<metric>`` for each metric in ``raw``.

    ``zones`` has one row per zone with a baseline per metric. The join carries no
    hint: the planner broadcasts it while it is small. Readings of unknown zones
    stay, with NULL levels.
    """
    zones = zone_baselines(raw.sparkSession) if zones is None else zones
    metrics = [c for c in raw.columns if c in zones.columns and c != "zone_id"]
    baselines = zones.select("zone_id", *[F.col(m).alias(f"base_{m}") for m in metrics])
    factor = diurnal_factor(utc_hour(F.col(ts), is_ntz(raw, ts)))
    joined = raw.withColumn("_factor", factor).join(baselines, "zone_id", "left")
    expected = {m: _expected(m, F.col(f"base_{m}"), F.col("_factor")) for m in metrics}
    return joined.select(
        *raw.columns,
        *[expected[m].alias(f"expected_{m}") for m in metrics],
        *[(F.col(m) - expected[m]).alias(f"residual_{m}") for m in metrics],
    )
