"""The quality suites over raw tables and over models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from ..operators.quality import Rule, at_least, at_most, check, has_rows, no_missing, no_nan, not_null, unique

RAW_CHECKS: dict[str, list[Rule]] = {
    "raw_air_quality": [
        has_rows(),
        no_missing("zone_id"),
        no_missing("pm25_level"),
        no_nan("pm25_level"),
        at_least("pm25_level", 0),
        at_most("pm25_level", 500),
    ],
    "raw_traffic": [has_rows(), no_missing("zone_id"), at_least("vehicle_count", 0)],
    "raw_energy": [has_rows(), no_missing("zone_id"), no_nan("kwh_consumed"), at_least("kwh_consumed", 0)],
}

MODEL_CHECKS: dict[str, list[Rule]] = {
    "air_quality_hourly": [not_null("zone_id"), not_null("hour"), not_null("avg_pm25")],
    "threshold_breaches": [not_null("zone_id"), not_null("avg_pm25")],
    "traffic_hourly": [not_null("zone_id"), not_null("hour")],
    "energy_hourly": [not_null("zone_id"), not_null("hour")],
    "sensor_health": [not_null("sensor_id"), unique("sensor_id"), not_null("health_status")],
    "traffic_pollution_correlation": [not_null("zone_id"), unique("zone_id")],
}


def run_suite(tables: dict[str, DataFrame], suite: dict[str, list[Rule]]) -> DataFrame:
    """Check every table of a suite; one result row per rule."""
    results = [check(tables[name], name, rules) for name, rules in suite.items()]
    return reduce(DataFrame.unionByName, results)


def quality_raw(tables: dict[str, DataFrame]) -> DataFrame:
    return run_suite(tables, RAW_CHECKS)


def quality_models(models: dict[str, DataFrame]) -> DataFrame:
    """Meant for saved models: each check then reads a small table."""
    return run_suite(models, MODEL_CHECKS)
