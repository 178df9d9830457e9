"""Hourly models and their correlation on streams, kept as partial aggregates.

A micro-batch writes the parts of the hours its readings fall on, and reads no other
readings, models or parts: what an hour has is the sum of its parts, taken when a model is
read. So late readings count without bound, and a batch run again replaces its own parts.
The correlation keeps moments per zone: a changed hour's old pair is taken out and its new
one put in, for which the batch reads the parts of the days it touches, a few rows per
zone and hour.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.numeric import round_numeric
from ..functions.times import utc_day
from ..operators import partials
from ..operators.partials import AIR_PARTS, MOMENTS, PARTS, TRAFFIC_PARTS, Parts
from ..plans.models import traffic_pollution_hours
from ..sources.folds import fold_batches, folders, named, read_batches, read_days
from ..sources.tables import table_path
from .ingest import query_id, start

HOURS, PAIRS = "hour_parts", "pair_moments"
FOLD_EVERY = 32  # micro-batches after which parts are folded into fewer files


def _schema(kinds: Sequence[Parts], *more: str) -> T.StructType:
    """Columns of the parts of some kinds, and partition columns."""
    fields = ["zone_id string", "hour timestamp", "readings bigint"]
    own = {"n": "bigint", "sum": "bigint", "exact": partials.EXACT, "rough": "double"}
    for parts in kinds:
        for name in parts.names:
            metric, _, part = name.rpartition("_")
            fields.append(f"{name} {own.get(part) or parts.kind.schema[metric].dataType.simpleString()}")
    return T._parse_datatype_string(", ".join([*fields, *more]))


def _path(base: str, parts: Parts) -> str:
    return f"{table_path(base, HOURS)}/table={parts.kind.table}"


def _stored(parts: Parts) -> T.StructType:
    return _schema([parts], "day date", "batch string")


_MOMENT_KINDS = {"x_sum": "decimal(38,0)", "y_sum": "decimal(38,2)", "sx": "decimal(38,0)", "sy": "decimal(38,2)",
                 "sxx": "decimal(38,0)", "syy": "decimal(38,4)", "sxy": "decimal(38,2)"}


def _moments() -> T.StructType:
    fields = [f"{m} {_MOMENT_KINDS.get(m, 'bigint')}" for m in MOMENTS]
    return T._parse_datatype_string(", ".join(["zone_id string", *fields, "batch string"]))


def _write(rows: DataFrame, path: str, *partitions: str) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of batches, empty before its first one."""
    if not folders(spark, f"{path}/*=*"):
        return spark.createDataFrame([], schema)
    return read_batches(spark, path, schema)


def write_parts(readings: DataFrame, columns: Sequence[Column], base: str, batch: str) -> None:
    """Write the parts (``part_columns``) of a batch of readings of several kinds (column ``table``)."""
    hours = partials.hour_parts(readings, columns, ("table", "zone_id"))
    rows = hours.withColumns({"day": utc_day(F.col("hour")), "batch": F.lit(batch)})
    _write(rows, table_path(base, HOURS), "table", "day", "batch")


def read_parts(spark: SparkSession, base: str, parts: Parts) -> DataFrame:
    return _read(spark, _path(base, parts), _stored(parts))


def fold_parts(spark: SparkSession, base: str, kinds: Sequence[Parts]) -> None:
    """Fold the parts of all finished micro-batches, and the moments: a row per zone and hour, or per zone."""
    for parts in kinds:
        names, path = parts.names, _path(base, parts)

        def merged(rows: DataFrame) -> DataFrame:
            return partials.merged_hours(rows, names, ("zone_id", "hour", "day"))

        if folders(spark, f"{path}/day=*"):
            fold_batches(spark, path, _stored(parts), merge=merged)
    if folders(spark, f"{table_path(base, PAIRS)}/batch=*"):
        fold_batches(spark, table_path(base, PAIRS), _moments(), merge=partials.summed_moments)


def kept_model(spark: SparkSession, base: str, name: str) -> DataFrame:
    """An hourly model over all readings that ``keep_hours`` has taken in."""
    parts = PARTS[name]
    return parts.model(partials.merged_hours(read_parts(spark, base, parts), parts.names))


def kept_joined_hours(spark: SparkSession, base: str) -> DataFrame:
    """Hours that both traffic and air have, of a stream of both."""
    return traffic_pollution_hours(kept_model(spark, base, "traffic_hourly"), kept_model(spark, base, "air_quality_hourly"))


def _pair(among: Column) -> tuple[Column, Column, Column]:
    """Aggregates of an hour's parts: vehicles, rounded mean PM2.5, and whether both kinds are there."""
    of_traffic = among & (F.col("table") == TRAFFIC_PARTS.kind.table)
    of_air = among & (F.col("table") == AIR_PARTS.kind.table)
    vehicles = partials.merge(["vehicle_count_sum"], of_traffic)[0]
    n, exact, rough = partials.merge([f"pm25_level_{p}" for p in ("n", "exact", "rough")], of_air)
    total = F.coalesce(exact.cast("double") + rough, exact.cast("double"), rough)
    there = (F.count_if(of_traffic) > 0) & (F.count_if(of_air) > 0)
    return vehicles, round_numeric(F.try_divide(total, n), 2), there


class Pairs:
    """What a batch changes in the moments: of the hours in its parts, the new pairs less the old ones."""

    def __init__(self):
        # Columns are made once: a micro-batch is small, and making them takes as long as running it.
        names = ("x", "y", "there")
        old = [c.alias(f"old_{n}") for n, c in zip(names, _pair(~F.col("own")))]
        new = [c.alias(f"new_{n}") for n, c in zip(names, _pair(F.lit(True)))]
        self.hours = [*old, *new, F.max("own").alias("touched")]
        self.change = F.explode(F.array(*[
            F.struct(*partials.pair_moments(*[F.col(f"{side}_{n}") for n in names], F.lit(sign)))
            for side, sign in (("old", -1), ("new", 1))
        ])).alias("change")
        self.sums = partials.moment_sums()
        self.kinds = [
            (parts, [c if c in parts.names else F.lit(None).cast(kind).alias(c) for c, kind in self.needed.items()])
            for parts in (TRAFFIC_PARTS, AIR_PARTS)
        ]

    needed = {"vehicle_count_sum": "bigint", "pm25_level_n": "bigint", "pm25_level_exact": partials.EXACT, "pm25_level_rough": "double"}

    def write(self, spark: SparkSession, base: str, batch: str) -> None:
        patterns = [f"{_path(base, parts)}/day=*/batch={batch}" for parts, _ in self.kinds]
        days = sorted({named(f, "day") for pattern in patterns for f in folders(spark, pattern)})
        if not days:
            return
        own = F.expr(f"coalesce(batch = '{batch}', false)").alias("own")
        found = [(parts, columns, read_days(spark, _path(base, parts), _stored(parts), days)) for parts, columns in self.kinds]
        near = reduce(DataFrame.unionByName, [
            rows.where("hour IS NOT NULL").select(F.lit(parts.kind.table).alias("table"), "zone_id", "hour", own, *columns)
            for parts, columns, rows in found if rows is not None
        ])
        changed = near.groupBy("zone_id", "hour").agg(*self.hours).where("touched")
        moments = changed.select("zone_id", self.change).select("zone_id", "change.*").groupBy("zone_id").agg(*self.sums)
        _write(moments.withColumn("batch", F.lit(batch)), table_path(base, PAIRS), "batch")


def kept_correlation(spark: SparkSession, base: str) -> DataFrame:
    """The correlation model over all readings that ``keep_hours(..., correlate=True)`` has taken in."""
    return partials.correlation_of(partials.summed_moments(_read(spark, table_path(base, PAIRS), _moments())))


def keep_hours(
    raw: dict[str, DataFrame], base: str, checkpoint: str, every: str | None = None, correlate: bool = False,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Keep the hourly models of raw streams (by table name) under ``base``, complete after each micro-batch.

    ``correlate`` also keeps the correlation of traffic and air. ``base`` belongs to one stream:
    another one over the same readings would add them again. Readings without a time are a
    group with a NULL hour, as in the batch models; the join and the correlation have none.
    """
    kept = [parts for parts in PARTS.values() if parts.kind.table in raw]
    if correlate and not {TRAFFIC_PARTS.kind.table, AIR_PARTS.kind.table} <= set(raw):
        raise ValueError("the correlation needs traffic and air")
    metrics = {m: parts.kind.schema[m].dataType for parts in kept for m in parts.kind.metrics}

    def tagged(parts: Parts) -> DataFrame:
        own = [(F.col(m) if m in parts.kind.metrics else F.lit(None).cast(t)).alias(m) for m, t in metrics.items()]
        return raw[parts.kind.table].select(F.lit(parts.kind.table).alias("table"), "timestamp", "zone_id", *own)

    columns, pairs = partials.part_columns(kept), Pairs() if correlate else None

    def each(batch: DataFrame, number: int) -> None:
        name = f"{query_id(batch)}-{number}"
        write_parts(batch, columns, base, name)
        if pairs:
            pairs.write(batch.sparkSession, base, name)
        if (number + 1) % fold_every == 0:
            fold_parts(batch.sparkSession, base, kept)

    every_kind = reduce(DataFrame.unionByName, [tagged(parts) for parts in kept])
    return start(every_kind.writeStream.foreachBatch(each), checkpoint, every)
