"""A full refresh of all models, parents before children."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..schemas import KINDS
from ..sources.tables import save_table
from .models import (
    air_quality_hourly,
    energy_hourly,
    sensor_health,
    threshold_breaches,
    traffic_hourly,
    traffic_pollution_correlation,
)


def refresh_models(
    raw: dict[str, DataFrame],
    save: Callable[[DataFrame, str], DataFrame],
    ts: str = "timestamp",
    threads: int = 4,
) -> dict[str, DataFrame]:
    """Save each model once with ``save(df, name)`` and return the saved ones.

    The raw tables are read by the models on them only, up to ``threads`` at a time so
    that one job's last tasks do not leave the cluster idle. Breaches and the
    correlation read the saved hourly models.
    """
    air, traffic, energy = raw["raw_air_quality"], raw["raw_traffic"], raw["raw_energy"]
    with ThreadPoolExecutor(threads) as pool:
        saved = {
            name: pool.submit(save, df, name)
            for name, df in (
                ("air_quality_hourly", air_quality_hourly(air, ts)),
                ("traffic_hourly", traffic_hourly(traffic, ts)),
                ("energy_hourly", energy_hourly(energy, ts)),
                ("sensor_health", sensor_health(air, ts=ts)),
            )
        }
        air_hours, traffic_hours = saved["air_quality_hourly"].result(), saved["traffic_hourly"].result()
        for name, df in (
            ("threshold_breaches", threshold_breaches(air_hours)),
            ("traffic_pollution_correlation", traffic_pollution_correlation(traffic_hours, air_hours)),
        ):
            saved[name] = pool.submit(save, df, name)
        return {name: model.result() for name, model in saved.items()}


def refresh_tables(spark: SparkSession, database: str = "analytics") -> dict[str, DataFrame]:
    """Save the models of the declared raw tables as tables of ``database``, for SQL readers."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    raw = {kind.table: spark.table(kind.table) for kind in KINDS.values()}
    return refresh_models(raw, lambda df, name: save_table(df, f"{database}.{name}"))
