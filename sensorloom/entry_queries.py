"""The registered queries: every model and operator over the given ``events``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .entry_events import raw_from_events, read_events, stream_events
from .functions.times import as_utc_instant, as_utc_ntz
from .operators.expected import expected_levels
from .operators.quality import check
from .operators.silence import reading_gaps, silent_sensors
from .plans import models, panels
from .plans.refresh import refresh_models, refresh_tables
from .plans.suites import MODEL_CHECKS, quality_models, quality_raw
from .schemas import AIR, ENERGY, KINDS, TRAFFIC, Kind
from .session import scratch_dir
from .sources.tables import append_declared, append_raw, compact, create_raw_tables, read_raw, refresh_days, save_files, save_view
from .sources.topics import decode, publish
from .streaming.health import current_health, track_health
from .streaming.hours import keep_hours, kept_correlation, kept_joined_hours, kept_model
from .streaming.ingest import QUARANTINE, ingest, read_quarantine, rows_read
from .streaming.rollups import current_runs, keep_runs

Query = Callable[[SparkSession, str], DataFrame]


def now():
    """The panels' clock: the end of the month the events cover."""
    return F.expr("TIMESTAMP_NTZ '2024-01-31 00:00:00'")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE and instants as UTC TIMESTAMP_NTZ, for comparison."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            column = as_utc_ntz(column)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def raws(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return raw_from_events(read_events(spark, sf_dir))


def stream_raws(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return raw_from_events(stream_events(spark, sf_dir))


def built(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return models.build_model(name, raws(spark, sf_dir))


def instants(readings: DataFrame) -> DataFrame:
    return readings.withColumn("timestamp", as_utc_instant(F.col("timestamp")))


def stored(spark: SparkSession, sf_dir: str, *kinds: Kind) -> str:
    """Write raw tables, partitioned by day, and return their base folder."""
    base, tables = scratch_dir(spark, "tables"), raws(spark, sf_dir)
    for kind in kinds:
        append_raw(instants(tables[kind.table]), base, kind, "load", rebalance=True)
    return base


def model(name: str) -> Query:
    return lambda spark, sf_dir: plain(models.in_order(name, built(spark, sf_dir, name)))


def panel(table: str, value: str) -> Query:
    return lambda spark, sf_dir: panels.recent(raws(spark, sf_dir)[table], value, now=now())


def panel_sensor_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(panels.sensor_health_panel(built(spark, sf_dir, "sensor_health")))


def panel_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(panels.correlation_panel(built(spark, sf_dir, "traffic_pollution_correlation")))


def raw_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.row_counts(raws(spark, sf_dir))


def raw_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_raw(raws(spark, sf_dir))


def model_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "models")
    return quality_models(refresh_models(raws(spark, sf_dir), lambda df, name: save_files(df, base, name)))


def silence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silent_sensors(raws(spark, sf_dir)[AIR.table], now(), timedelta(days=1))


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading_gaps(raws(spark, sf_dir)[AIR.table], timedelta(hours=3))


def expected(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        levels = expected_levels(raws(spark, sf_dir)[table])
        derived = [c for c in levels.columns if c.startswith(("expected_", "residual_"))]
        return levels.withColumns({c: F.round(c, 6) for c in derived})

    return query


def message_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = raws(spark, sf_dir)
    messages = [publish(tables[kind.table], kind) for kind in KINDS.values()]
    return plain(decode(reduce(DataFrame.unionByName, messages)).drop("value"))


def table_sensor_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(models.sensor_health(read_raw(spark, stored(spark, sf_dir, AIR), AIR)))


def table_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = stored(spark, sf_dir, ENERGY)
    start, end = (F.expr(f"TIMESTAMP '{t}+00:00'") for t in ("2024-01-10 06:00:00", "2024-01-12 18:00:00"))
    return plain(read_raw(spark, base, ENERGY, start, end).drop("day"))


def table_refreshed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load of all days; then one day loses its readings, late ones come for another, the last days are refreshed."""
    base, readings = scratch_dir(spark, "tables"), instants(raws(spark, sf_dir)[AIR.table])
    day = F.to_date(as_utc_ntz(F.col("timestamp")))
    late = (day == F.lit("2024-01-27").cast("date")) & (F.col("pm25_level") > 20)
    first = readings.where(~late)
    append_raw(first, base, AIR, "load", rebalance=True)
    model = models.air_quality_hourly
    refresh_days(read_raw(spark, base, AIR), model, base, "hourly", F.expr("TIMESTAMP '2000-01-01 00:00:00+00:00'"))
    append_raw(first.where(day != F.lit("2024-01-22").cast("date")), base, AIR, "load", rebalance=True, corrected=True)
    append_raw(readings.where(late), base, AIR, "late")
    refresh_days(read_raw(spark, base, AIR), model, base, "hourly", F.expr("TIMESTAMP '2024-01-20 00:00:00+00:00'"))
    return plain(spark.read.parquet(f"{base}/hourly").drop("day"))


def in_batches(spark: SparkSession, sf_dir: str, kind: Kind, batches: int = 4) -> str:
    """A raw table written in several batches of a stream; the base folder."""
    base, readings = scratch_dir(spark, "tables"), instants(raws(spark, sf_dir)[kind.table])
    for number in range(batches):
        part = F.pmod(F.xxhash64("timestamp", "sensor_id"), F.lit(batches)) == number
        append_raw(readings.where(part), base, kind, f"stream-{number}", rebalance=True)
    return base


def table_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The energy table in several batches, those of closed days folded into one."""
    base = in_batches(spark, sf_dir, ENERGY)
    compact(spark, base, ENERGY, "2024-01-30")
    return plain(read_raw(spark, base, ENERGY).drop("day"))


def sql_compacted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per sensor through SQL on a declared table that was compacted twice, late readings between."""
    base, name = in_batches(spark, sf_dir, ENERGY), f"sensorloom_{uuid.uuid4().hex}"
    before = spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark, 'database')}'")
    spark.sql(f"USE {name}")
    try:
        create_raw_tables(spark, base)
        compact(spark, base, ENERGY, "2024-01-20", declared=True)
        late = spark.table(ENERGY.table).where("day = DATE '2024-01-05'").drop("day", "batch")
        append_declared(late, ENERGY, "stream-4")
        append_declared(late.limit(0), ENERGY, "stream-5")
        compact(spark, base, ENERGY, "2024-01-30", declared=True)
        counts = spark.sql(f"SELECT sensor_id, count(*) AS readings FROM {ENERGY.table} GROUP BY sensor_id")
        return save_files(counts, base, "answer")
    finally:
        spark.sql(f"USE {before}")
        spark.sql(f"DROP DATABASE {name} CASCADE")


def timeless_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly air model of readings of which some, from error events, have no time."""
    events = read_events(spark, sf_dir)
    events = events.withColumn("ts", F.when(F.col("event_type") != "error", F.col("ts")))
    return models.air_quality_hourly(raw_from_events(events)[AIR.table])


def null_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(timeless_hours(spark, sf_dir))


def quality_null_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "air_quality_hourly"
    return check(timeless_hours(spark, sf_dir), name, MODEL_CHECKS[name])


def sql_sensor_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tables declared over files, models saved as tables, and a SQL read of one."""
    base, name = stored(spark, sf_dir, *KINDS.values()), f"sensorloom_{uuid.uuid4().hex}"
    before = spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark, 'database')}'")
    spark.sql(f"USE {name}")
    try:
        create_raw_tables(spark, base)
        refresh_tables(spark, name)
        health = spark.sql("SELECT * FROM sensor_health WHERE sensor_id IN (SELECT sensor_id FROM raw_air_quality)")
        return plain(save_files(health, base, "answer"))
    finally:
        spark.sql(f"USE {before}")
        spark.sql(f"DROP DATABASE {name} CASCADE")


def view_threshold_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model as a view, recomputed when it is read."""
    name = f"breaches_{uuid.uuid4().hex}"
    save_view(built(spark, sf_dir, "threshold_breaches"), name)
    return plain(spark.sql(f"SELECT * FROM {name}"))


def bad_messages(events: DataFrame) -> list[DataFrame]:
    """What other events can give as messages that are no readings."""
    found = []
    for event_type, topic, value in (
        ("signup", AIR.topic, "props"),
        ("purchase", ENERGY.topic, "event_type"),
        ("error", "sensor_other", "props"),
    ):
        bad = events.filter(F.col("event_type") == event_type)
        found.append(bad.select(F.lit(topic).alias("topic"), F.col(value).alias("value")))
    return found


def stored_counts(spark: SparkSession, base: str) -> list[DataFrame]:
    counts = [
        read_raw(spark, base, kind).groupBy(
            F.lit(kind.table).alias("table_name"), F.lit("").alias("problem")
        ).agg(F.count("*").alias("row_count"))
        for kind in KINDS.values()
    ]
    rejected = read_quarantine(spark, base)
    counts.append(
        rejected.groupBy(F.lit(QUARANTINE).alias("table_name"), "problem").agg(F.count("*").alias("row_count"))
    )
    return counts


def stream_ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings as messages, and bad messages among them."""
    folder, events = scratch_dir(spark, "ingest"), stream_events(spark, sf_dir)
    tables = raw_from_events(events)
    messages = [publish(tables[kind.table], kind) for kind in KINDS.values()] + bad_messages(events)
    ingest(reduce(DataFrame.unionByName, messages), f"{folder}/tables", f"{folder}/position").awaitTermination()
    return reduce(DataFrame.unionByName, stored_counts(spark, f"{folder}/tables"))


def stream_ingest_deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message twice, in different micro-batches, some with a deeply nested field; stored once, all counted."""
    folder, events = scratch_dir(spark, "ingest"), stream_events(spark, sf_dir, copies=2)
    tables = raw_from_events(events)
    deep = ',"extra":' + '{"a":[' * 12 + "1" + "]}" * 12 + "}"
    nested = F.when(F.col("value").contains("_02"), F.concat(F.rtrim(F.regexp_replace("value", r"\}$", "")), F.lit(deep)))
    good = [publish(tables[kind.table], kind) for kind in KINDS.values()]
    good = [m.withColumn("value", F.coalesce(nested, F.col("value"))) for m in good]
    base = f"{folder}/tables"
    every = reduce(DataFrame.unionByName, good + bad_messages(events))
    cores = spark.sparkContext.defaultParallelism
    ingest(every, base, f"{folder}/position", dedupe=True, state_partitions=cores).awaitTermination()
    read = spark.range(1).select(F.lit("messages").alias("table_name"), F.lit("").alias("problem"),
                                 F.lit(rows_read(spark, base)).cast("long").alias("row_count"))
    return reduce(DataFrame.unionByName, [*stored_counts(spark, base), read])


def hourly(kind: Kind, name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder, source = scratch_dir(spark, "hourly"), {kind.table: stream_raws(spark, sf_dir)[kind.table]}
        keep_hours(source, folder, f"{folder}/position").awaitTermination()
        return plain(kept_model(spark, folder, name))

    return query


def kept_traffic_and_air(spark: SparkSession, sf_dir: str, correlate: bool = False) -> str:
    folder, tables = scratch_dir(spark, "joined"), stream_raws(spark, sf_dir)
    source = {kind.table: tables[kind.table] for kind in (TRAFFIC, AIR)}
    keep_hours(source, folder, f"{folder}/position", correlate=correlate).awaitTermination()
    return folder


def stream_joined_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(kept_joined_hours(spark, kept_traffic_and_air(spark, sf_dir)))


def stream_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(kept_correlation(spark, kept_traffic_and_air(spark, sf_dir, correlate=True)))


def stream_sensor_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "health")
    query = track_health(stream_raws(spark, sf_dir)[AIR.table], f"{folder}/newest", f"{folder}/position")
    query.awaitTermination()
    return plain(current_health(spark, f"{folder}/newest", query.id))


def stream_activity_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "runs")
    query = keep_runs(stream_raws(spark, sf_dir)[AIR.table], f"{folder}/runs", f"{folder}/position", "6 hours")
    query.awaitTermination()
    return plain(current_runs(spark, f"{folder}/runs", query.id))


QUERIES: dict[str, Query] = {
    **{name: model(name) for name in models.MODEL_ORDER},
    "panel_recent_air": panel("raw_air_quality", "pm25_level"),
    "panel_recent_traffic": panel("raw_traffic", "vehicle_count"),
    "panel_recent_energy": panel("raw_energy", "kwh_consumed"),
    "panel_sensor_health": panel_sensor_health,
    "panel_correlation": panel_correlation,
    "raw_row_counts": raw_row_counts,
    "quality_raw": raw_quality,
    "quality_models": model_quality,
    "silent_sensors": silence,
    "reading_gaps": gaps,
    "expected_air": expected("raw_air_quality"),
    "expected_traffic": expected("raw_traffic"),
    "expected_energy": expected("raw_energy"),
    "message_roundtrip": message_roundtrip,
    "table_sensor_health": table_sensor_health,
    "table_time_range": table_time_range,
    "table_refreshed_days": table_refreshed_days,
    "table_compacted": table_compacted,
    "sql_compacted_counts": sql_compacted_counts,
    "null_hours": null_hours,
    "quality_null_hours": quality_null_hours,
    "sql_sensor_health": sql_sensor_health,
    "view_threshold_breaches": view_threshold_breaches,
    "stream_ingest_counts": stream_ingest_counts,
    "stream_ingest_deduped": stream_ingest_deduped,
    "stream_air_quality_hourly": hourly(AIR, "air_quality_hourly"),
    "stream_traffic_hourly": hourly(TRAFFIC, "traffic_hourly"),
    "stream_energy_hourly": hourly(ENERGY, "energy_hourly"),
    "stream_joined_hours": stream_joined_hours,
    "stream_correlation": stream_correlation,
    "stream_sensor_health": stream_sensor_health,
    "stream_activity_sessions": stream_activity_sessions,
}
