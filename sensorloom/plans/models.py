"""The six analytics models, as functions of the raw tables."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_mean, pearson, round_numeric, to_numeric
from ..functions.times import is_ntz, utc_day
from ..operators.recent import in_last_days, last_n
from ..operators.rollup import hourly_rollup

# Limit, pollutant name and status texts of the models.
PM25_LIMIT = Decimal("35.0")
PM25_NAME = "PM2.5"
DEAD = "CRITICAL - dead (reads zero)"
DRIFT = "WARNING - drift (abnormally high)"
HEALTHY = "HEALTHY"


def air_quality_hourly(raw_air: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Mean pollutant levels and PM2.5 peak per zone and hour."""
    return hourly_rollup(
        raw_air,
        [
            F.count("*").alias("reading_count"),
            round_numeric(F.avg("pm25_level"), 2).alias("avg_pm25"),
            round_numeric(F.max("pm25_level"), 2).alias("max_pm25"),
            round_numeric(F.avg("no2_level"), 2).alias("avg_no2"),
            round_numeric(F.avg("co_level"), 2).alias("avg_co"),
            round_numeric(F.avg("o3_level"), 2).alias("avg_o3"),
        ],
        ts=ts,
    )


def traffic_hourly(raw_traffic: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Vehicle totals and mean speed per zone and hour."""
    return hourly_rollup(
        raw_traffic,
        [
            F.count("*").alias("reading_count"),
            F.sum("vehicle_count").alias("total_vehicles"),
            F.round(exact_mean("vehicle_count"), 0).alias("avg_vehicles"),
            round_numeric(F.avg("avg_speed_kmh"), 1).alias("avg_speed_kmh"),
        ],
        ts=ts,
    )


def energy_hourly(raw_energy: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Consumption and peak demand per zone and hour."""
    return hourly_rollup(
        raw_energy,
        [
            F.count("*").alias("reading_count"),
            round_numeric(F.sum("kwh_consumed"), 1).alias("total_kwh"),
            round_numeric(F.avg("kwh_consumed"), 1).alias("avg_kwh"),
            round_numeric(F.max("peak_demand_kw"), 1).alias("peak_demand_kw"),
        ],
        ts=ts,
    )


def threshold_breaches(
    air_hourly: DataFrame, limit: Decimal = PM25_LIMIT, pollutant: str = PM25_NAME
) -> DataFrame:
    """Hours whose (rounded) mean PM2.5 is above the limit."""
    threshold = F.lit(limit)
    return air_hourly.filter(F.col("avg_pm25") > threshold).select(
        "zone_id",
        "hour",
        "avg_pm25",
        threshold.alias("threshold"),
        (F.col("avg_pm25") - threshold).alias("amount_over"),
        F.lit(pollutant).alias("pollutant"),
    )


def newest_first(ts: str) -> list[Column]:
    """Newest reading first; equal times are ordered by value so the cut is stable."""
    return [F.desc_nulls_first(ts), F.desc_nulls_first("pm25_level"), F.asc_nulls_last("zone_id")]


def recent_readings(
    raw_air: DataFrame, last: int = 200, ts: str = "timestamp", by_day: bool | None = None
) -> DataFrame:
    """The newest ``last`` readings of each sensor.

    ``by_day`` first cuts the table to the days that can hold them, at the price of
    counting rows per sensor and day. By default that is done where a ``day``
    partition column saves reading the other days. Elsewhere it spares sorting them:
    it pays if sensors have many more than ``last`` readings a day, and costs more
    than it spares if they have fewer.
    """
    columns = ["sensor_id", "zone_id", ts, "pm25_level"]
    by_day = "day" in raw_air.columns if by_day is None else by_day
    if by_day:
        if "day" not in raw_air.columns:
            raw_air = raw_air.withColumn("day", utc_day(F.col(ts), is_ntz(raw_air, ts)))
        raw_air = in_last_days(raw_air.select(*columns, "day"), "sensor_id", last)
    return last_n(raw_air.select(*columns), "sensor_id", newest_first(ts), last)


def classify_sensors(recent: DataFrame, n_stddev: float = 1.0) -> DataFrame:
    """Health per sensor from its recent readings against the fleet.

    The fleet's bound is one value, read through a scalar subquery; both sides
    share the shuffle of ``recent``. It is cut to the digits a double is good for,
    so float noise cannot push a sensor exactly on the bound over it.
    """
    per_sensor = recent.groupBy("sensor_id", "zone_id").agg(
        F.count("*").alias("recent_readings"),
        round_numeric(F.avg("pm25_level"), 2).alias("recent_avg_pm25"),
    )
    mean = exact_mean("recent_avg_pm25", 2).cast("double")
    spread = F.stddev_samp("recent_avg_pm25") * F.lit(float(n_stddev))
    bound = F.struct(to_numeric(mean + spread).alias("exact"), (mean + spread).alias("rough"))
    fleet = per_sensor.agg(bound.alias("drift_bound")).scalar()
    level = F.col("recent_avg_pm25")
    # Beyond the decimal's range the double decides.
    above = F.coalesce(level > fleet["exact"], level.cast("double") > fleet["rough"])
    status = (
        F.when(level == 0, DEAD)
        .when(above, DRIFT)
        .otherwise(HEALTHY)
    )
    return per_sensor.withColumn("health_status", status)


def sensor_health(
    raw_air: DataFrame,
    last: int = 200,
    n_stddev: float = 1.0,
    ts: str = "timestamp",
    by_day: bool | None = None,
) -> DataFrame:
    """Dead, drifting or healthy, per sensor, by its newest ``last`` readings.

    For ``by_day`` see ``recent_readings``.
    """
    return classify_sensors(recent_readings(raw_air, last, ts, by_day), n_stddev)


def traffic_pollution_hours(traffic: DataFrame, air: DataFrame) -> DataFrame:
    """Traffic totals and mean PM2.5 of the hours both hourly models have."""
    return traffic.select("zone_id", "hour", "total_vehicles").join(
        air.select("zone_id", "hour", "avg_pm25"), ["zone_id", "hour"], "inner"
    )


def correlate_hours(hours: DataFrame) -> DataFrame:
    """Correlation per zone over joined hours."""
    return hours.groupBy("zone_id").agg(
        F.count("*").alias("hours_compared"),
        F.round(exact_mean("total_vehicles"), 0).alias("avg_vehicles"),
        F.round(exact_mean("avg_pm25", 2), 2).alias("avg_pm25"),
        round_numeric(pearson("total_vehicles", "avg_pm25"), 3).alias("traffic_pm25_correlation"),
    )


def traffic_pollution_correlation(traffic: DataFrame, air: DataFrame) -> DataFrame:
    """Does traffic move with pollution? One row per zone."""
    return correlate_hours(traffic_pollution_hours(traffic, air))


_NEWEST_HOUR = (("hour", "desc"), ("zone_id", "asc"))

# Row order of each model when read: (column, direction). NULLs count as largest.
MODEL_ORDER: dict[str, tuple[tuple[str, str], ...]] = {
    "air_quality_hourly": (("hour", "asc"), ("zone_id", "asc")),
    "traffic_hourly": _NEWEST_HOUR,
    "energy_hourly": _NEWEST_HOUR,
    "threshold_breaches": _NEWEST_HOUR,
    "sensor_health": (("health_status", "asc"), ("sensor_id", "asc")),
    "traffic_pollution_correlation": (("traffic_pm25_correlation", "desc_nulls_last"),),
}


def in_order(model: str, df: DataFrame) -> DataFrame:
    """Sort a model's rows for reading. Saved tables are not sorted."""
    how = {"asc": F.asc_nulls_last, "desc": F.desc_nulls_first, "desc_nulls_last": F.desc_nulls_last}
    return df.orderBy(*[how[direction](column) for column, direction in MODEL_ORDER[model]])


def build_model(name: str, raw: dict[str, DataFrame], ts: str = "timestamp") -> DataFrame:
    """One model from the raw tables, by table name, with the models it is built on."""
    if name == "air_quality_hourly":
        return air_quality_hourly(raw["raw_air_quality"], ts)
    if name == "traffic_hourly":
        return traffic_hourly(raw["raw_traffic"], ts)
    if name == "energy_hourly":
        return energy_hourly(raw["raw_energy"], ts)
    if name == "threshold_breaches":
        return threshold_breaches(build_model("air_quality_hourly", raw, ts))
    if name == "sensor_health":
        return sensor_health(raw["raw_air_quality"], ts=ts)
    if name == "traffic_pollution_correlation":
        return traffic_pollution_correlation(
            build_model("traffic_hourly", raw, ts), build_model("air_quality_hourly", raw, ts)
        )
    raise KeyError(name)


def build_models(raw: dict[str, DataFrame], ts: str = "timestamp") -> dict[str, DataFrame]:
    """All six models, unsaved."""
    return {name: build_model(name, raw, ts) for name in MODEL_ORDER}
