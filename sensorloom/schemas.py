"""The three kinds of readings: raw table schemas, topics and table names."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _schema(*metrics: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType(
        [
            T.StructField("timestamp", T.TimestampType(), False),
            T.StructField("sensor_id", T.StringType(), False),
            T.StructField("zone_id", T.StringType(), False),
            *[T.StructField(name, data_type, True) for name, data_type in metrics],
        ]
    )


@dataclass(frozen=True)
class Kind:
    """One kind of sensor: the topic it publishes to and the raw table it fills."""

    topic: str
    table: str
    schema: T.StructType

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]

    @property
    def metrics(self) -> list[str]:
        return [f.name for f in self.schema if f.nullable]


AIR = Kind(
    "sensor_air",
    "raw_air_quality",
    _schema(
        ("co_level", T.DoubleType()),
        ("no2_level", T.DoubleType()),
        ("pm25_level", T.DoubleType()),
        ("o3_level", T.DoubleType()),
    ),
)
TRAFFIC = Kind(
    "sensor_traffic",
    "raw_traffic",
    _schema(("vehicle_count", T.IntegerType()), ("avg_speed_kmh", T.DoubleType())),
)
ENERGY = Kind(
    "sensor_energy",
    "raw_energy",
    _schema(("kwh_consumed", T.DoubleType()), ("peak_demand_kw", T.DoubleType())),
)

KINDS: dict[str, Kind] = {"air": AIR, "traffic": TRAFFIC, "energy": ENERGY}

# Columns that tables on disk carry besides the reading itself.
DAY = T.StructField("day", T.DateType(), True)
BATCH = T.StructField("batch", T.StringType(), True)
FOLD = T.StructField("fold", T.IntegerType(), True)


def stored_schema(kind: Kind) -> T.StructType:
    """Raw schema plus the two partition columns."""
    return T.StructType([*kind.schema.fields, DAY, BATCH])
