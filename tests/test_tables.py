"""Raw and model tables: partitions, pruning, refresh."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from sensorloom.functions.times import as_utc_instant
from sensorloom.plans import models, panels
from sensorloom.plans.refresh import refresh_models, refresh_tables
from sensorloom.plans.suites import quality_models
from sensorloom.schemas import AIR, KINDS
from sensorloom.sources import folds, tables
from sensorloom.entry_events import raw_from_events, read_events


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def days(air, first, last, level=1.0):
    return air([(f"2024-01-{d:02d} {h:02d}:00:00", "s1", "a", level) for d in range(first, last + 1) for h in (0, 23)])


def test_a_batch_written_twice_is_there_once(spark, air, tmp_path):
    base = str(tmp_path)
    tables.append_raw(days(air, 1, 3), base, AIR, "b1")
    tables.append_raw(days(air, 2, 4), base, AIR, "b2", rebalance=True)
    tables.append_raw(days(air, 2, 4), base, AIR, "b2")
    raw = tables.read_raw(spark, base, AIR)
    assert raw.count() == 12
    assert raw.columns == [*AIR.columns, "day"]


def test_range_reads_prune_days(spark, air, tmp_path):
    base = str(tmp_path)
    tables.append_raw(days(air, 1, 9), base, AIR, "b")
    raw = tables.read_raw(spark, base, AIR, dt.datetime(2024, 1, 3, 1), dt.datetime(2024, 1, 5))
    assert sorted(r.timestamp.day for r in raw.collect()) == [3, 4, 4]
    text = plan(raw)
    # The end is midnight: the fifth is not read.
    assert ">= 2024-01-03" in text and "<= 2024-01-04" in text
    assert "PartitionFilters: [isnotnull(day" in text and "PushedFilters: [IsNotNull(timestamp), GreaterThan" in text
    panel = panels.recent_air(tables.read_raw(spark, base, AIR), now=dt.datetime(2024, 1, 5))
    assert panel.head().time == dt.datetime(2024, 1, 5)
    assert "PartitionFilters: [isnotnull(day" in plan(panel)


def test_health_on_a_table_prunes_days_and_scans_columns_it_needs(spark, air, tmp_path):
    base = str(tmp_path)
    tables.append_raw(days(air, 1, 20), base, AIR, "b")
    raw = tables.read_raw(spark, base, AIR)
    health = models.sensor_health(raw, last=3)
    text = plan(health)
    assert "dynamicpruning" in text
    assert "ReadSchema: struct<sensor_id:string>" in text and "co_level" not in text
    # The fleet's bound reads the shuffled readings of the sensors again, not the table.
    assert "ReusedExchange [sensor_id" in text
    assert health.head().recent_readings == 3


def test_declared_tables(spark, air, tmp_path):
    base = str(tmp_path)
    tables.append_raw(days(air, 1, 2), base, AIR, "b")
    try:
        tables.create_raw_tables(spark, base)
        tables.create_raw_tables(spark, base)
        assert spark.table("raw_air_quality").count() == 4
        types = {f.name: f.dataType.simpleString() for f in spark.table("raw_traffic").schema}
        assert types["vehicle_count"] == "int" and types["timestamp"] == "timestamp"
    finally:
        tables.drop_raw_tables(spark)


def test_sql_over_declared_tables_and_saved_models(spark, tmp_path):
    base = str(tmp_path / "raw")
    raw = raw_from_events(read_events(spark, "/root/testdata/sf0.001"))
    for kind in KINDS.values():
        instants = raw[kind.table].withColumn("timestamp", as_utc_instant(F.col("timestamp")))
        tables.append_raw(instants, base, kind, "load")
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
    try:
        tables.create_raw_tables(spark, base)
        for _ in range(2):
            saved = refresh_tables(spark, "analytics_test")
        assert all(r.passed for r in quality_models(saved).collect())
        health = spark.sql("""
            SELECT sensor_id, recent_readings, recent_avg_pm25, health_status
            FROM analytics_test.sensor_health ORDER BY health_status""").collect()
        assert sorted(health) == sorted(panels.sensor_health_panel(models.build_model("sensor_health", raw)).collect())
        recent = """SELECT "timestamp" AS time, kwh_consumed, zone_id FROM raw_energy
            WHERE "timestamp" > TIMESTAMP '2024-01-31 00:00:00+00:00' - INTERVAL '1 day' ORDER BY "timestamp" """
        panel = panels.recent_energy(spark.table("raw_energy"), now=dt.datetime(2024, 1, 31), horizon=dt.timedelta(1))
        assert spark.sql(recent).collect() == panel.collect() != []
        assert spark.sql("SELECT COUNT(*) FROM raw_air_quality").head()[0] == raw["raw_air_quality"].count()
    finally:
        spark.conf.unset("spark.sql.ansi.doubleQuotedIdentifiers")
        spark.sql("DROP DATABASE IF EXISTS analytics_test CASCADE")
        tables.drop_raw_tables(spark)


def test_saved_table_is_refreshed_in_full(spark):
    try:
        tables.save_table(spark.range(5).toDF("id"), "saved_model")
        assert tables.save_table(spark.range(2).toDF("id"), "saved_model").count() == 2
    finally:
        spark.sql("DROP TABLE IF EXISTS saved_model")
    assert tables.save_view(spark.range(3).toDF("id"), "viewed_model").count() == 3


def test_refresh_of_days_equals_full_refresh(spark, air, tmp_path):
    base = str(tmp_path)
    tables.append_raw(days(air, 1, 6), base, AIR, "b1")
    raw = tables.read_raw(spark, base, AIR)
    everything = F.lit(dt.datetime(2000, 1, 1))
    tables.refresh_days(raw, models.air_quality_hourly, base, "hourly", everything)
    tables.append_raw(days(air, 5, 7, 9.0), base, AIR, "late")
    raw = tables.read_raw(spark, base, AIR)
    tables.refresh_days(raw, models.air_quality_hourly, base, "hourly", dt.datetime(2024, 1, 5, 17))
    got = spark.read.parquet(f"{base}/hourly").drop("day").collect()
    assert sorted(got) == sorted(models.air_quality_hourly(raw).collect())


def test_refreshed_models_equal_unsaved_ones_and_pass_their_checks(spark, tmp_path):
    raw = raw_from_events(read_events(spark, "/root/testdata/sf0.001"))
    def save(df, name):
        return tables.save_files(df, str(tmp_path), name)

    saved = refresh_models(raw, save)
    for name, df in models.build_models(raw).items():
        assert sorted(saved[name].collect(), key=str) == sorted(df.collect(), key=str), name
    results = quality_models(saved).collect()
    assert len(results) == 14 and all(r.passed for r in results)
    # A second refresh replaces the first.
    refresh_models(raw, save)
    assert spark.read.parquet(f"{tmp_path}/sensor_health").count() == 12


def test_hourly_models_shuffle_once_per_input_and_join_without_more(spark):
    raw = raw_from_events(read_events(spark, "/root/testdata/sf0.001"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = models.traffic_pollution_hours(
            models.traffic_hourly(raw["raw_traffic"]), models.air_quality_hourly(raw["raw_air_quality"])
        )
        text = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2 and text.count("SortMergeJoin") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in text


def test_refreshed_days_lose_what_raw_no_longer_has(spark, air, tmp_path):
    base = str(tmp_path)
    tables.append_raw(days(air, 1, 3), base, AIR, "b")
    start = dt.datetime(2024, 1, 1)
    tables.refresh_days(tables.read_raw(spark, base, AIR), models.air_quality_hourly, base, "hourly", start)
    fewer = days(air, 1, 3).where("day(timestamp) <> 2")
    tables.append_raw(fewer, base, AIR, "b", corrected=True)
    raw = tables.read_raw(spark, base, AIR)
    assert raw.count() == 4
    tables.refresh_days(raw, models.air_quality_hourly, base, "hourly", start)
    got = spark.read.parquet(f"{base}/hourly").drop("day").collect()
    assert sorted(got) == sorted(models.air_quality_hourly(raw).collect())


def test_compaction_leaves_few_files_and_may_break_off(spark, air, tmp_path, monkeypatch):
    import glob

    base = str(tmp_path)
    for number in range(6):
        tables.append_raw(days(air, 1, 4, float(number)), base, AIR, f"q-{number}")
    want = sorted(tables.read_raw(spark, base, AIR).collect())
    real = folds._point

    def breaks(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(folds, "_point", breaks)
    with pytest.raises(RuntimeError):
        tables.compact(spark, base, AIR, "2024-01-04")
    # Nothing is lost or doubled by what was left behind.
    assert sorted(tables.read_raw(spark, base, AIR).collect()) == want
    monkeypatch.setattr(folds, "_point", real)
    for _ in range(2):
        tables.compact(spark, base, AIR, "2024-01-04")
        assert sorted(tables.read_raw(spark, base, AIR).collect()) == want
    # Of closed days the newest batch is left, which may be run again; the others are in one folder.
    assert [len(glob.glob(f"{base}/raw_air_quality/day=2024-01-0{d}/batch=*")) for d in (1, 2, 3, 4)] == [1, 1, 1, 6]
    assert [len(glob.glob(f"{base}/raw_air_quality_folds/day=2024-01-0{d}/fold=*")) for d in (1, 2, 3, 4)] == [1, 1, 1, 0]
    tables.append_raw(days(air, 1, 4, 5.0), base, AIR, "q-5")
    assert sorted(tables.read_raw(spark, base, AIR).collect()) == want


def test_readings_that_come_after_a_compaction_count(spark, air, tmp_path):
    """Late ones, ones of another stream, and batches that no stream wrote."""
    base, level = str(tmp_path), 0.0

    def add(batch, first, last):
        nonlocal level
        level += 1
        tables.append_raw(days(air, first, last, level), base, AIR, batch)
        return days(air, first, last, level)

    sent = [add("q-0", 1, 3), add("q-1", 1, 5), add("p-0", 2, 2), add("load", 1, 2), add("q-9-0", 1, 1), add("q-9-1", 1, 1)]
    for before, more in (("2024-01-03", ("q-2", 1, 4)), ("2024-01-03", ("p-1", 1, 1)), ("2024-01-05", ("q-3", 2, 6)), ("2024-01-09", None)):
        old = tables.read_raw(spark, base, AIR)
        tables.compact(spark, base, AIR, before)
        want = sorted(r for df in sent for r in df.collect())
        # A reader that listed the files before the compaction reads them still.
        assert sorted(old.drop("day").collect()) == sorted(tables.read_raw(spark, base, AIR).drop("day").collect()) == want
        if more:
            sent.append(add(*more))
    near = tables.read_raw(spark, base, AIR, dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3))
    assert near.count() == sum(df.where("day(timestamp) = 2").count() for df in sent)
    assert "2024-01-0" in plan(near) and "PartitionFilters: [isnotnull(day" in plan(near)


def test_compaction_under_declared_tables(spark, air, tmp_path):
    """Readers through the catalog see the same rows before, while and after."""
    base = str(tmp_path)
    try:
        tables.create_raw_tables(spark, base)
        for number in range(4):
            tables.append_declared(days(air, 1, 5, float(number)), AIR, f"q-{number}")
        want = sorted(spark.table("raw_air_quality").drop("batch").collect())
        assert len(want) == 40
        for number in (4, 5):
            started = spark.table("raw_air_quality").drop("batch")
            tables.compact(spark, base, AIR, "2024-01-05", declared=True)
            assert sorted(started.collect()) == sorted(spark.table("raw_air_quality").drop("batch").collect()) == want
            assert sorted(tables.read_raw(spark, base, AIR).collect()) == want
            tables.append_declared(days(air, 2, 2, float(number)), AIR, f"q-{number}")
            want = sorted(spark.table("raw_air_quality").drop("batch").collect())
            assert len(want) == 40 + 2 * (number - 3)
        # Declared again, as by another session.
        tables.drop_raw_tables(spark)
        tables.create_raw_tables(spark, base)
        assert sorted(spark.table("raw_air_quality").drop("batch").collect()) == want
        pruned = spark.table("raw_air_quality").where("day = DATE '2024-01-02'")
        assert pruned.count() == 12 and "day#" in plan(pruned)
    finally:
        tables.drop_raw_tables(spark)


def test_compacted_readings_of_one_sensor_and_hour_are_a_small_share(spark, tmp_path):
    """Readings are sorted by sensor and time, so row groups and pages of other sensors are skipped."""
    base, sensors, rows = str(tmp_path), 50, 60_000
    start = F.lit(1704067200)
    readings = spark.range(rows, numPartitions=4).select(
        F.timestamp_seconds(start + F.col("id") * 86400 / rows).alias("timestamp"),
        F.concat(F.lit("s"), F.lpad((F.col("id") % sensors).cast("string"), 2, "0")).alias("sensor_id"), F.lit("z").alias("zone_id"),
        *[F.rand(c).alias(name) for c, name in enumerate(AIR.metrics)],
    )
    for number in range(2):
        tables.append_raw(readings.where(F.col("timestamp").isNotNull() & (F.pmod(F.xxhash64("timestamp"), F.lit(2)) == number)), base, AIR, f"q-{number}")
    tables.append_raw(readings.limit(0), base, AIR, "q-2")
    tables.append_raw(readings.limit(1), base, AIR, "q-2")

    def read():
        found = tables.read_raw(spark, base, AIR, dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 1, 6)).where("sensor_id = 's07'")
        got = sorted(found.collect())
        scanned, stack = 0, [found._jdf.queryExecution().executedPlan()]
        while stack:
            node = stack.pop()
            if "FileSourceScan" in node.getClass().getSimpleName():
                scanned += node.metrics().get("numOutputRows").get().value()
            if "AdaptiveSparkPlan" in node.getClass().getSimpleName():
                stack.append(node.executedPlan())
            children = node.children()
            stack += [children.apply(i) for i in range(children.size())]
        return got, scanned

    want, before = read()
    small = {"parquet.block.size": str(64 << 10), "parquet.page.row.count.limit": "200", "parquet.block.row.count.limit": "2000"}
    tables.compact(spark, base, AIR, "2024-01-02", **small)
    got, after = read()
    assert got == want and len(got) == rows / sensors / 24
    assert before > rows / 2 and after < rows / 20, (before, after)


def test_a_refreshed_table_is_swapped_at_once(spark, monkeypatch):
    try:
        tables.save_table(spark.range(5).toDF("id"), "swapped_model")
        for size in (3, 4, 6):
            reader = spark.table("swapped_model")
            count, real = reader.count(), spark.sql

            def watched(text):
                # Until the location is set readers see the old rows, written out in full.
                assert spark.table("swapped_model").count() in (count, size)
                return real(text)

            monkeypatch.setattr(spark, "sql", watched)
            assert tables.save_table(spark.range(size).toDF("id"), "swapped_model").count() == size
            monkeypatch.undo()
            assert reader.count() == count
        assert tables.save_table(spark.range(2).toDF("other"), "swapped_model").columns == ["other"]
    finally:
        spark.sql("DROP TABLE IF EXISTS swapped_model")
