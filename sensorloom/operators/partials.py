"""Hourly models in two steps: aggregates that merge, and the model's columns from them.

The parts of an hour from several sets of readings add up to the hour's parts over all of
them, in any order and with the same result: totals are decimals, not doubles.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_numeric
from ..schemas import AIR, ENERGY, TRAFFIC, Kind
from .rollup import hourly_rollup

EXACT = "decimal(38,18)"


def _mean(metric: str) -> Column:
    """Mean of a double metric from its parts, NULL without values."""
    return F.try_divide(_total(metric), F.col(f"{metric}_n"))


def _total(metric: str) -> Column:
    exact, rough = F.col(f"{metric}_exact").cast("double"), F.col(f"{metric}_rough")
    return F.coalesce(exact + rough, exact, rough)


def _whole_mean(metric: str) -> Column:
    return F.try_divide(F.col(f"{metric}_sum").cast("decimal(22,0)"), F.col(f"{metric}_n").cast("decimal(14,0)"))


@dataclass(frozen=True)
class Parts:
    """What an hourly model needs of an hour: totals of double and integer metrics, and peaks."""

    kind: Kind
    doubles: tuple[str, ...]
    integers: tuple[str, ...]
    peaks: tuple[str, ...]
    columns: Callable[[], list[Column]]

    def aggregates(self) -> list[Column]:
        """The parts of readings.

        A double is added as the decimal it is written as. One that no such decimal
        holds, and NaN and infinities, are added as doubles beside.
        """
        found = []
        for metric in self.doubles:
            number, exact = F.col(metric), F.col(metric).try_cast(EXACT)
            found += [
                F.count(number).alias(f"{metric}_n"), F.sum(exact).cast(EXACT).alias(f"{metric}_exact"),
                F.sum(F.when(exact.isNull(), number)).alias(f"{metric}_rough"),
            ]
        for metric in self.integers:
            found += [F.count(metric).alias(f"{metric}_n"), F.sum(metric).alias(f"{metric}_sum")]
        return found + [F.max(metric).alias(f"{metric}_max") for metric in self.peaks]

    @property
    def names(self) -> list[str]:
        doubles = [f"{m}_{part}" for m in self.doubles for part in ("n", "exact", "rough")]
        integers = [f"{m}_{part}" for m in self.integers for part in ("n", "sum")]
        return doubles + integers + [f"{m}_max" for m in self.peaks]

    def model(self, merged: DataFrame) -> DataFrame:
        """The hourly model's rows from merged parts."""
        return merged.select("zone_id", "hour", F.col("readings").alias("reading_count"), *self.columns())


def merge(names: Sequence[str], among: Column | None = None) -> list[Column]:
    """Parts merged into one, or those of the rows that a condition holds for."""

    def own(name: str) -> Column:
        return F.col(name) if among is None else F.when(among, F.col(name))

    def merged(name: str) -> Column:
        if name.endswith("_max"):
            return F.max(own(name))
        return F.sum(own(name)).cast(EXACT) if name.endswith("_exact") else F.sum(own(name))

    return [merged(name).alias(name) for name in names]


AIR_PARTS = Parts(
    AIR, ("pm25_level", "no2_level", "co_level", "o3_level"), (), ("pm25_level",),
    lambda: [
        round_numeric(_mean("pm25_level"), 2).alias("avg_pm25"),
        round_numeric(F.col("pm25_level_max"), 2).alias("max_pm25"),
        round_numeric(_mean("no2_level"), 2).alias("avg_no2"),
        round_numeric(_mean("co_level"), 2).alias("avg_co"),
        round_numeric(_mean("o3_level"), 2).alias("avg_o3"),
    ],
)
TRAFFIC_PARTS = Parts(
    TRAFFIC, ("avg_speed_kmh",), ("vehicle_count",), (),
    lambda: [
        F.col("vehicle_count_sum").alias("total_vehicles"),
        F.round(_whole_mean("vehicle_count"), 0).alias("avg_vehicles"),
        round_numeric(_mean("avg_speed_kmh"), 1).alias("avg_speed_kmh"),
    ],
)
ENERGY_PARTS = Parts(
    ENERGY, ("kwh_consumed",), (), ("peak_demand_kw",),
    lambda: [
        round_numeric(_total("kwh_consumed"), 1).alias("total_kwh"),
        round_numeric(_mean("kwh_consumed"), 1).alias("avg_kwh"),
        round_numeric(F.col("peak_demand_kw_max"), 1).alias("peak_demand_kw"),
    ],
)
PARTS: dict[str, Parts] = {"air_quality_hourly": AIR_PARTS, "traffic_hourly": TRAFFIC_PARTS, "energy_hourly": ENERGY_PARTS}


def part_columns(parts: Sequence[Parts]) -> list[Column]:
    """Aggregates that make ``readings`` and the parts of several kinds; metrics that a reading hasn't are NULL."""
    return [F.count("*").alias("readings"), *[a for p in parts for a in p.aggregates()]]


def hour_parts(readings: DataFrame, columns: Sequence[Column], keys: Sequence[str] = ("zone_id",)) -> DataFrame:
    """``keys, hour`` and what ``part_columns`` makes of the hour's readings, in one aggregate."""
    return hourly_rollup(readings, columns, keys)


def merged_hours(parts: DataFrame, names: Sequence[str], keys: Sequence[str] = ("zone_id", "hour")) -> DataFrame:
    """One row per zone and hour from any number of partial ones."""
    return parts.groupBy(*keys).agg(*merge(["readings", *names]))


# Moments of pairs (x, y) that add up and can be taken out again: all are exact.
MOMENTS = ["hours_compared", "x_n", "x_sum", "y_n", "y_sum", "n", "sx", "sy", "sxx", "syy", "sxy"]


def pair_moments(x: Column, y: Column, there: Column, sign: Column) -> list[Column]:
    """Moments of one pair each, where ``there``, to be summed up; ``sign`` -1 takes a pair out."""
    x, y = x.cast("decimal(18,0)"), y.cast("decimal(16,2)")
    both = there & x.isNotNull() & y.isNotNull()

    def of(condition: Column, value: Column) -> Column:
        return F.when(condition, sign * value)

    one = F.lit(1)
    values = [
        of(there, one), of(there & x.isNotNull(), one), of(there, x), of(there & y.isNotNull(), one), of(there, y),
        of(both, one), of(both, x), of(both, y), of(both, x * x), of(both, y * y), of(both, x * y),
    ]
    return [value.alias(name) for name, value in zip(MOMENTS, values, strict=True)]


def moment_sums() -> list[Column]:
    kinds = ["bigint", "bigint", "decimal(38,0)", "bigint", "decimal(38,2)", "bigint", "decimal(38,0)", "decimal(38,2)",
             "decimal(38,0)", "decimal(38,4)", "decimal(38,2)"]
    return [F.coalesce(F.sum(m), F.lit(0)).cast(kind).alias(m) for m, kind in zip(MOMENTS, kinds, strict=True)]


def summed_moments(moments: DataFrame) -> DataFrame:
    return moments.groupBy("zone_id").agg(*moment_sums())


def correlation_of(moments: DataFrame) -> DataFrame:
    """The correlation model's rows from summed moments; zones without a pair have none."""
    n = F.col("n").cast("decimal(14,0)")
    dx, dy = n * F.col("sxx") - F.col("sx") * F.col("sx"), n * F.col("syy") - F.col("sy") * F.col("sy")
    dxy = n * F.col("sxy") - F.col("sx") * F.col("sy")
    spread = F.sqrt(dx.cast("double")) * F.sqrt(dy.cast("double"))
    pearson = F.when((dx > 0) & (dy > 0), F.try_divide(dxy.cast("double"), spread))

    def mean(column: str, scale: int) -> Column:
        return F.try_divide(F.col(f"{column}_sum").cast(f"decimal({22 + scale},{scale})"), F.col(f"{column}_n").cast("decimal(14,0)"))

    return moments.where("hours_compared > 0").select(
        "zone_id", "hours_compared", F.round(mean("x", 0), 0).alias("avg_vehicles"), F.round(mean("y", 2), 2).alias("avg_pm25"),
        round_numeric(pearson, 3).alias("traffic_pm25_correlation"),
    )
