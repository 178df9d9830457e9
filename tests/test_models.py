"""Model semantics on small frames."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from sensorloom.functions.numeric import exact_mean, pearson, round_numeric
from sensorloom.functions.times import diurnal_factor, utc_day
from sensorloom.operators.expected import expected_levels
from sensorloom.operators.recent import in_last_days, last_n
from sensorloom.operators.silence import reading_gaps, silent_sensors
from sensorloom.plans import models, panels
from sensorloom.plans.suites import quality_raw
from sensorloom.schemas import KINDS, TRAFFIC


def at(seconds):
    return str(dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds))


def statuses(df):
    return {r.sensor_id: r.health_status for r in df.collect()}


@pytest.mark.parametrize(
    "value, places, want",
    [
        (35.004, 2, "35.00"),
        (35.005, 2, "35.01"),  # below the tie as a double
        (6.96499999999999, 2, "6.96"),
        (6.964999999999999, 2, "6.97"),  # noise in the 16th digit
        (6.965000000000001, 2, "6.97"),
        (2.5, 0, "3"),
        (-2.5, 0, "-3"),
        (1234567.2499999998, 1, "1234567.3"),  # 15 digits: ...7.25000000
        (0.0, 2, "0.00"),
        (None, 2, None),
        (float("nan"), 2, None),
        (float("inf"), 2, None),
        (1e19, 2, "10000000000000000000.00"),
        (1e20, 2, "100000000000000000000.00"),
        (-1.25e25, 1, "-12500000000000000000000000.0"),
    ],
)
def test_round_numeric(spark, value, places, want):
    df = spark.createDataFrame([(value,)], "x double").select(round_numeric(F.col("x"), places).alias("y"))
    assert df.head().y == (None if want is None else Decimal(want))


@pytest.mark.parametrize("places", [0, 1, 2, 3])
def test_round_numeric_equals_decimal_arithmetic(spark, places):
    draw = random.Random(places)
    values = [draw.uniform(0, 10 ** draw.randint(-3, 9)) for _ in range(4000)]
    # Means of a few two-decimal levels: many exact ties, with and without float noise.
    values += [sum(round(draw.uniform(0, 500), 2) for _ in range(n)) / n for n in (2, 4, 8) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    unit = Decimal(1).scaleb(-places)
    for row in df.select("x", round_numeric(F.col("x"), places).alias("y")).collect():
        assert row.y == Decimal(f"{row.x:.14e}").quantize(unit, ROUND_HALF_UP), row.x


def test_exact_mean_is_not_a_double_mean(spark):
    df = spark.createDataFrame([(Decimal("30.00"),), (Decimal("30.01"),), (None,)], "x decimal(31,2)")
    assert df.agg(exact_mean("x", 2).alias("m")).head().m == Decimal("30.005")
    assert df.filter("x is null").agg(exact_mean("x", 2).alias("m")).head().m is None


def test_hour_edges_and_null_levels(spark, air):
    raw = air(
        [
            ("2024-01-01 00:59:59.999999", "s", "z", 10.0),
            ("2024-01-01 01:00:00", "s", "z", 20.0),
            ("2024-01-01 01:30:00", "s", "z", None),
            ("1969-12-31 23:30:00", "s", "z", 5.0),
        ]
    )
    rows = {r.hour: r for r in models.air_quality_hourly(raw).collect()}
    assert {h: r.reading_count for h, r in rows.items()} == {
        dt.datetime(1969, 12, 31, 23): 1, dt.datetime(2024, 1, 1, 0): 1, dt.datetime(2024, 1, 1, 1): 2
    }
    assert rows[dt.datetime(2024, 1, 1, 1)].avg_pm25 == Decimal("20.00")


def test_traffic_rounds_a_half_up_and_skips_nulls(spark):
    raw = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), "s", "z", n, 50.05) for n in (2, 3, None)],
        "timestamp timestamp, sensor_id string, zone_id string, vehicle_count int, avg_speed_kmh double",
    )
    row = models.traffic_hourly(raw).head()
    assert (row.reading_count, row.total_vehicles, row.avg_vehicles) == (3, 5, Decimal(3))
    assert row.avg_speed_kmh == Decimal("50.1")


def test_breach_is_decided_on_the_rounded_mean(spark, air):
    raw = air([(at(0), "s", "a", 35.004), (at(0), "s", "b", 35.0), (at(0), "s", "c", 35.006), (at(0), "s", "d", None)])
    rows = models.threshold_breaches(models.air_quality_hourly(raw)).collect()
    assert [(r.zone_id, r.avg_pm25, r.threshold, r.amount_over, r.pollutant) for r in rows] == [
        ("c", Decimal("35.01"), Decimal("35.0"), Decimal("0.01"), "PM2.5")
    ]


def test_health_of_one_and_of_two_sensors(spark, air):
    assert statuses(models.sensor_health(air([(at(0), "s1", "a", 400.0)]))) == {"s1": models.HEALTHY}
    # A sample z-score cannot exceed (n - 1) / sqrt(n), 0.707 for two.
    two = air([(at(0), "s1", "a", 1.0), (at(0), "s2", "a", 400.0)])
    assert set(statuses(models.sensor_health(two)).values()) == {models.HEALTHY}


def test_health_branches(spark, air):
    levels = {"dead": 0.004, "low": 10.0, "mid": 11.0, "high": 90.0, "none": None}
    got = statuses(models.sensor_health(air([(at(0), s, "a", v) for s, v in levels.items()])))
    assert got == {
        "dead": models.DEAD, "low": models.HEALTHY, "mid": models.HEALTHY, "high": models.DRIFT,
        "none": models.HEALTHY,
    }


@pytest.mark.parametrize("base", [10.01, 0.07, 1234.56])
def test_a_sensor_exactly_on_the_bound_is_healthy(spark, air, base):
    # mean + stddev of x, x+0.01, x+0.02 is x+0.02 itself.
    raw = air([(at(0), f"s{i}", "a", round(base + i * 0.01, 2)) for i in range(3)])
    assert set(statuses(models.sensor_health(raw)).values()) == {models.HEALTHY}


def test_a_dead_fleet_is_dead_not_drifting(spark, air):
    raw = air([(at(0), f"s{i}", "a", 0.0) for i in range(3)])
    assert set(statuses(models.sensor_health(raw)).values()) == {models.DEAD}


@pytest.mark.parametrize("readings", [199, 200, 201, 350])
def test_health_sees_the_newest_200_readings(spark, air, readings):
    # Older readings are 500, the newest 200 are 10.
    rows = [(at(i), "s1", "a", 10.0 if i >= readings - 200 else 500.0) for i in range(readings)]
    row = models.sensor_health(air(rows).repartition(7)).head()
    assert (row.recent_readings, row.recent_avg_pm25) == (min(readings, 200), Decimal("10.00"))


def test_a_sensor_that_moved_has_a_row_per_zone(spark, air):
    rows = models.sensor_health(air([(at(0), "s1", "a", 1.0), (at(1), "s1", "b", 2.0)])).collect()
    assert sorted((r.zone_id, r.recent_readings) for r in rows) == [("a", 1), ("b", 1)]


@pytest.mark.parametrize("slices", [1, 3, 64])
def test_last_n_equals_brute_force_with_a_hot_key(spark, slices):
    rows = [("hot", i * 7919 % 5000) for i in range(5000)] + [(f"k{i % 50}", i) for i in range(1500)]
    df = spark.createDataFrame(rows, "k string, t int").repartition(16)
    got = last_n(df, "k", [F.desc("t")], 20, slices).collect()
    want = {k: sorted((t for kk, t in rows if kk == k), reverse=True)[:20] for k, _ in rows}
    assert {k: sorted((r.t for r in got if r.k == k), reverse=True) for k in want} == want


def test_in_last_days_keeps_what_last_n_needs(spark, air):
    rows = [(f"2024-01-{d:02d} {h:02d}:00:00", "busy", "a", float(d)) for d in range(1, 21) for h in range(24)]
    rows += [(f"2024-01-{d:02d} 12:00:00", "gone", "a", float(d)) for d in range(1, 6)]
    raw = air(rows).withColumn("day", utc_day(F.col("timestamp")))
    kept = in_last_days(raw, "sensor_id", 30)
    assert {r.day.day for r in kept.select("day").distinct().collect()} == {1, 2, 3, 4, 5, 19, 20}
    plain = models.sensor_health(raw.drop("day"), last=30)
    want = sorted(plain.collect())
    assert sorted(models.sensor_health(raw, last=30).collect()) == want
    for by_day in (True, False):
        assert sorted(models.sensor_health(raw, last=30, by_day=by_day).collect()) == want
        assert sorted(models.sensor_health(raw.drop("day"), last=30, by_day=by_day).collect()) == want


def hours(spark, pairs):
    rows = [("z", i, x, None if y is None else Decimal(str(y))) for i, (x, y) in enumerate(pairs)]
    return spark.createDataFrame(rows, "zone_id string, hour int, total_vehicles bigint, avg_pm25 decimal(31,2)")


@pytest.mark.parametrize(
    "pairs, want",
    [
        ([(1, 1.0)], None),
        ([(1, 1.0), (1, 2.0)], None),
        ([(1, 5.1), (2, 5.1), (9, 5.1)], None),
        ([(1, 1.0), (2, 2.0), (3, 3.0)], "1.000"),
        ([(1, 3.0), (2, 2.0), (3, 1.0)], "-1.000"),
        ([(1, 1.0), (2, 2.0), (3, None), (None, 50.0)], "1.000"),
        ([(1, 1.0), (2, 3.0), (3, 2.0)], "0.500"),
        ([], "no row"),
    ],
)
def test_correlation(spark, pairs, want):
    rows = models.correlate_hours(hours(spark, pairs)).collect()
    got = rows[0].traffic_pm25_correlation if rows else "no row"
    assert got == (Decimal(want) if want and want != "no row" else want)


def test_a_constant_side_has_no_correlation_over_many_partitions(spark):
    df = spark.range(4900).select(F.col("id").alias("x"), F.lit(0.1).alias("y")).repartition(49)
    assert df.agg(pearson("x", "y").alias("r")).head().r is None


def test_correlation_drops_hours_missing_on_a_side(spark):
    t = spark.createDataFrame([("z", 1, 10), ("z", 2, 20)], "zone_id string, hour int, total_vehicles bigint")
    a = spark.createDataFrame([("z", 2, Decimal("1.00")), ("z", 3, Decimal("2.00"))],
                              "zone_id string, hour int, avg_pm25 decimal(31,2)")
    row = models.traffic_pollution_correlation(t, a).head()
    assert (row.hours_compared, row.avg_vehicles, row.avg_pm25) == (1, Decimal(20), Decimal("1.00"))


def test_models_of_empty_tables(spark):
    raw = {kind.table: spark.createDataFrame([], kind.schema) for kind in KINDS.values()}
    for name, df in models.build_models(raw).items():
        assert models.in_order(name, df).collect() == [], name
    with_day = raw["raw_air_quality"].withColumn("day", utc_day(F.col("timestamp")))
    assert models.sensor_health(with_day).collect() == []
    passed = [r.passed for r in quality_raw(raw).collect()]
    assert passed.count(False) == 3 and passed.count(None) == 4


def test_null_order_when_reading(spark):
    rows = [("a", None), ("b", 0.1), ("c", 0.9)]
    corr = spark.createDataFrame(rows, "zone_id string, traffic_pm25_correlation double")
    order = [r.zone_id for r in models.in_order("traffic_pollution_correlation", corr).collect()]
    assert order == ["c", "b", "a"]
    hourly = spark.createDataFrame([("a", 1), (None, 1), ("a", None), ("b", 2)], "zone_id string, hour int")
    assert [tuple(r) for r in models.in_order("traffic_hourly", hourly).collect()] == [
        ("a", None), ("b", 2), ("a", 1), (None, 1)
    ]
    assert [tuple(r) for r in models.in_order("air_quality_hourly", hourly).collect()] == [
        ("a", 1), (None, 1), ("b", 2), ("a", None)
    ]


def test_recent_panel_has_a_strict_lower_bound(spark, air):
    raw = air([("2024-01-01 11:00:00", "s", "z", 1.0), ("2024-01-01 11:00:00.000001", "s", "z", 2.0),
               ("2024-01-01 13:00:00", "s", "z", 3.0)])
    panel = panels.recent_air(raw, now=F.lit(dt.datetime(2024, 1, 1, 12)))
    assert panel.columns == ["time", "pm25_level", "zone_id"]
    assert [r.pm25_level for r in panel.collect()] == [2.0, 3.0]


def test_recent_panel_defaults_to_the_clock(spark):
    raw = spark.sql("""
        SELECT timestamp, sensor_id, zone_id, vehicle_count FROM VALUES
            (current_timestamp() - INTERVAL 30 MINUTES, 's', 'z', 1),
            (current_timestamp() - INTERVAL 90 MINUTES, 's', 'z', 2)
        AS t(timestamp, sensor_id, zone_id, vehicle_count)""")
    assert [r.vehicle_count for r in panels.recent_traffic(raw).collect()] == [1]


def test_gaps_across_blocks(spark):
    """Blocks of any number of cells give the gaps of one window; a hot sensor's cells are spread over tasks."""
    rng = random.Random(7)
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = []
    for sensor in ("hot", "rare", None):
        at = 0.0
        for _ in range(900 if sensor == "hot" else 40):
            at += rng.choice([1, 5, 9, 10, 11, 30, 200, 4000])
            rows.append((sensor, start + dt.timedelta(seconds=at)))
    rows += [("hot", None), ("once", start), *rows[:20]]
    raw = spark.createDataFrame(rows, "sensor_id string, timestamp timestamp")
    want = set()
    for sensor in ("hot", "rare", None):
        own = sorted({t for s, t in rows if s == sensor and t})
        want |= {(sensor, a, b) for a, b in zip(own, own[1:]) if (b - a).total_seconds() > 10}
    for cells in (1, 3, 64, 1 << 20):
        found = reading_gaps(raw, dt.timedelta(seconds=10), cells=cells)
        got = [(r.sensor_id, r.gap_start.astimezone(dt.timezone.utc), r.gap_end.astimezone(dt.timezone.utc)) for r in found.collect()]
        assert set(got) == want and len(got) == len(want)
        ntz = raw.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
        assert reading_gaps(ntz, dt.timedelta(seconds=10), cells=cells).count() == len(want)


def test_gaps_equal_brute_force(spark, air):
    gap = dt.timedelta(minutes=10)
    seconds = sorted({(i * i * 37) % 40000 for i in range(120)} | {50000, 50600, 51200, 51801})
    raw = air([(at(s), "s1", "a", 1.0) for s in seconds] + [(at(0), "s2", "a", 1.0)]).repartition(5)
    want = [(a, b) for a, b in zip(seconds, seconds[1:]) if b - a > gap.total_seconds()]
    start = dt.datetime(2024, 1, 1)
    got = [((r.gap_start - start).total_seconds(), (r.gap_end - start).total_seconds(), r.gap_seconds)
           for r in reading_gaps(raw, gap).collect()]
    assert sorted(got) == [(a, b, float(b - a)) for a, b in want]
    assert (50000, 50600) not in want and (51200, 51801) in want


def test_silence_is_strict(spark, air):
    raw = air([(at(0), "s1", "a", 1.0), (at(1), "s2", "a", 1.0)])
    hour = dt.timedelta(hours=1)
    east = dt.timezone(dt.timedelta(hours=2))
    for now in (dt.datetime(2024, 1, 1, 1, 0, 1), dt.datetime(2024, 1, 1, 3, 0, 1, tzinfo=east)):
        assert [r.sensor_id for r in silent_sensors(raw, now, hour).collect()] == ["s1"]
        wall = raw.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
        assert [r.sensor_id for r in silent_sensors(wall, now, hour).collect()] == ["s1"]


def test_diurnal_factor(spark):
    rows = spark.range(24).select("id", diurnal_factor(F.col("id")).alias("f")).collect()
    factor = {r.id: r.f for r in rows}
    assert all(f > 0 for f in factor.values())
    assert factor[8] > factor[3]
    assert max(factor, key=factor.get) == 10 and min(factor, key=factor.get) == 2
    assert factor[18] == pytest.approx(1.0) and factor[10] == pytest.approx(1.693, abs=1e-3)


def test_expected_levels_by_metric(spark, air):
    raw = air([("2024-01-01 02:30:00", "s", "zone_a", 30.0), ("2024-01-01 02:30:00", "s", "elsewhere", 1.0)])
    rows = {r.zone_id: r for r in expected_levels(raw).collect()}
    factor = 0.30717967697244903
    assert rows["zone_a"].expected_pm25_level == pytest.approx(30 * factor)
    assert rows["zone_a"].residual_pm25_level == pytest.approx(30 - 30 * factor)
    assert rows["zone_a"].expected_o3_level == 55.0
    assert rows["elsewhere"].expected_pm25_level is None
    traffic = spark.createDataFrame([(dt.datetime(2024, 1, 1, 2), "s", "zone_a", 7, 20.0)], TRAFFIC.schema)
    row = expected_levels(traffic).head()
    assert row.expected_vehicle_count == pytest.approx(400 * factor)
    assert row.expected_avg_speed_kmh == pytest.approx(45 / 0.5)


def test_a_number_no_decimal_holds_is_an_error(spark):
    df = spark.createDataFrame([(1e60,)], "x double").select(round_numeric(F.col("x"), 2))
    with pytest.raises(Exception, match="no decimal holds"):
        df.collect()


def test_readings_without_a_time_are_an_hour_of_their_own(spark, air):
    rows = air([("2024-01-01 00:10:00", "s", "z", 1.0), (None, "s", "z", 3.0), (None, "s", "z", 5.0)])
    got = sorted((str(r.hour), r.reading_count, float(r.avg_pm25)) for r in models.air_quality_hourly(rows).collect())
    assert got == [("2024-01-01 00:00:00", 1, 1.0), ("None", 2, 4.0)]


def test_a_fleet_beyond_the_decimal_range_still_drifts(spark, air):
    rows = air([("2024-01-01 00:00:00", f"s{i}", "z", 1e19) for i in range(9)] + [("2024-01-01 00:00:00", "t", "z", 9e20)])
    assert statuses(models.sensor_health(rows))["t"].startswith("WARNING")


def test_group_limits_for_any_n(spark):
    df = spark.range(10_000).withColumn("k", F.col("id") % 3)
    assert last_n(df, "k", [F.desc("id")], 2000)._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2
