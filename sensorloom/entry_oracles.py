"""DuckDB SQL for the registered queries, written against ``events`` alone."""

from __future__ import annotations

NOW = "TIMESTAMP '2024-01-31 00:00:00'"


def num(x: str, places: int) -> str:
    """ROUND(x::numeric, places) of a double, returned as DOUBLE."""
    text = f"printf('%.14e', {x})"
    exact = f"CAST(ROUND(TRY_CAST({text} AS DECIMAL(38,18)), {places}) AS DOUBLE)"
    return f"COALESCE({exact}, CAST(TRY_CAST({text} AS DECIMAL(38,{places})) AS DOUBLE))"


RAW = """
unit AS (
    SELECT *, user_id % 12 AS u,
           'zone_' || substr('abcd', CAST(user_id % 4 AS INT) + 1, 1) AS zone_id,
           '_0' || CAST(CAST(FLOOR((user_id % 12) / 4.0) AS INT) + 1 AS VARCHAR) AS k
    FROM events
),
raw_air AS (
    SELECT ts, 'sensor_air_' || zone_id || k AS sensor_id, zone_id,
           value * 0.01 AS co_level, value + 10.0 AS no2_level,
           CASE WHEN u = 1 THEN 0.0 WHEN u = 3 THEN value * 3.0 ELSE value END AS pm25_level,
           value + 20.0 AS o3_level
    FROM unit
    WHERE event_type IN ('view', 'click', 'error')
      AND NOT (u = 2 AND ts >= TIMESTAMP '2024-01-25 00:00:00')
),
raw_traffic AS (
    SELECT ts, 'sensor_traffic_' || zone_id || k AS sensor_id, zone_id,
           CAST(FLOOR(value * 4.0) AS INT) AS vehicle_count,
           greatest(5.0, 60.0 - value / 10.0) AS avg_speed_kmh
    FROM unit WHERE event_type IN ('click', 'purchase', 'signup', 'error')
),
raw_energy AS (
    SELECT ts, 'sensor_energy_' || zone_id || k AS sensor_id, zone_id,
           value AS kwh_consumed, value * 1.2 AS peak_demand_kw
    FROM unit
)"""

MODELS = f"""{RAW},
air_quality_hourly AS (
    SELECT zone_id, date_trunc('hour', ts) AS hour, COUNT(*) AS reading_count,
           {num("AVG(pm25_level)", 2)} AS avg_pm25, {num("MAX(pm25_level)", 2)} AS max_pm25,
           {num("AVG(no2_level)", 2)} AS avg_no2, {num("AVG(co_level)", 2)} AS avg_co,
           {num("AVG(o3_level)", 2)} AS avg_o3
    FROM raw_air GROUP BY 1, 2
),
traffic_hourly AS (
    SELECT zone_id, date_trunc('hour', ts) AS hour, COUNT(*) AS reading_count,
           CAST(SUM(vehicle_count) AS BIGINT) AS total_vehicles,
           {num("AVG(vehicle_count)", 0)} AS avg_vehicles,
           {num("AVG(avg_speed_kmh)", 1)} AS avg_speed_kmh
    FROM raw_traffic GROUP BY 1, 2
),
energy_hourly AS (
    SELECT zone_id, date_trunc('hour', ts) AS hour, COUNT(*) AS reading_count,
           {num("SUM(kwh_consumed)", 1)} AS total_kwh, {num("AVG(kwh_consumed)", 1)} AS avg_kwh,
           {num("MAX(peak_demand_kw)", 1)} AS peak_demand_kw
    FROM raw_energy GROUP BY 1, 2
),
threshold_breaches AS (
    SELECT zone_id, hour, avg_pm25, CAST(35.0 AS DOUBLE) AS threshold,
           {num("avg_pm25 - 35.0", 2)} AS amount_over, 'PM2.5' AS pollutant
    FROM air_quality_hourly WHERE avg_pm25 > 35.0
),
recent_means AS (
    SELECT sensor_id, zone_id, COUNT(*) AS recent_readings, {num("AVG(pm25_level)", 2)} AS recent_avg_pm25
    FROM (SELECT * FROM raw_air QUALIFY ROW_NUMBER() OVER (PARTITION BY sensor_id ORDER BY ts DESC) <= 200)
    GROUP BY sensor_id, zone_id
),
sensor_health AS (
    SELECT *, CASE
        WHEN recent_avg_pm25 = 0 THEN 'CRITICAL - dead (reads zero)'
        WHEN recent_avg_pm25 > AVG(recent_avg_pm25) OVER () + STDDEV_SAMP(recent_avg_pm25) OVER ()
            THEN 'WARNING - drift (abnormally high)'
        ELSE 'HEALTHY' END AS health_status
    FROM recent_means
),
joined_hours AS (
    SELECT t.zone_id, t.hour, t.total_vehicles, a.avg_pm25
    FROM traffic_hourly t JOIN air_quality_hourly a ON t.zone_id = a.zone_id AND t.hour = a.hour
)"""


def correlation(hours: str) -> str:
    varies = "MIN(total_vehicles) < MAX(total_vehicles) AND MIN(avg_pm25) < MAX(avg_pm25)"
    return f"""
        SELECT zone_id, COUNT(*) AS hours_compared,
               {num("AVG(total_vehicles)", 0)} AS avg_vehicles, {num("AVG(avg_pm25)", 2)} AS avg_pm25,
               CASE WHEN {varies} THEN {num("CORR(total_vehicles, avg_pm25)", 3)} END
                   AS traffic_pm25_correlation
        FROM {hours} GROUP BY zone_id"""


def raw(sql: str) -> str:
    return f"WITH {RAW} {sql}"


def models(sql: str) -> str:
    return f"WITH {MODELS} {sql}"


def panel(table: str, value: str) -> str:
    return raw(f"SELECT ts AS time, {value}, zone_id FROM {table} WHERE ts > {NOW} - INTERVAL 1 HOUR")


def _check(table: str, source: str, name: str, value: str, test: str) -> str:
    value = f"CAST({value} AS DOUBLE)"
    return (
        f"SELECT '{table}' AS table_name, '{name}' AS check_name, {value} AS value, "
        f"{value} {test} AS passed FROM {source}"
    )


def _missing(table: str, source: str, column: str, name: str) -> str:
    return _check(table, source, f"{name}", f"COUNT(*) FILTER (WHERE {column} IS NULL)", "= 0")


def quality_raw() -> str:
    metric = {"raw_air_quality": "pm25_level", "raw_traffic": "vehicle_count", "raw_energy": "kwh_consumed"}
    source = {"raw_air_quality": "raw_air", "raw_traffic": "raw_traffic", "raw_energy": "raw_energy"}
    parts = []
    for table, column in metric.items():
        parts.append(_check(table, source[table], "row_count > 0", "COUNT(*)", "> 0"))
        parts.append(_missing(table, source[table], "zone_id", "missing_count(zone_id) = 0"))
        parts.append(_check(table, source[table], f"min({column}) >= 0", f"MIN({column})", ">= 0"))
    parts.append(_missing("raw_air_quality", "raw_air", "pm25_level", "missing_count(pm25_level) = 0"))
    parts.append(_check("raw_air_quality", "raw_air", "max(pm25_level) <= 500", "MAX(pm25_level)", "<= 500"))
    for table, column in (("raw_air_quality", "pm25_level"), ("raw_energy", "kwh_consumed")):
        count = f"COUNT(*) FILTER (WHERE isnan({column}))"
        parts.append(_check(table, source[table], f"nan_count({column}) = 0", count, "= 0"))
    return raw(" UNION ALL ".join(parts))


def quality_models() -> str:
    columns = {
        "air_quality_hourly": ["zone_id", "hour", "avg_pm25"],
        "threshold_breaches": ["zone_id", "avg_pm25"],
        "traffic_hourly": ["zone_id", "hour"],
        "energy_hourly": ["zone_id", "hour"],
        "sensor_health": ["sensor_id", "health_status"],
        "correlation": ["zone_id"],
    }
    named = {"correlation": "traffic_pollution_correlation"}
    parts = [
        _missing(named.get(t, t), t, c, f"not_null({c})") for t, names in columns.items() for c in names
    ]
    for table, column in (("sensor_health", "sensor_id"), ("correlation", "zone_id")):
        repeated = (
            f"(SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)"
        )
        parts.append(_check(named.get(table, table), repeated, f"unique({column})", "COUNT(*)", "= 0"))
    return f"WITH {MODELS}, correlation AS ({correlation('joined_hours')}) " + " UNION ALL ".join(parts)


def expected(table: str, metrics: dict[str, str]) -> str:
    # The zones' mean levels.
    zones = """zones AS (SELECT * FROM (VALUES
        ('zone_a', 0.5, 50.0, 30.0, 55.0, 400.0, 45.0, 120.0, 80.0),
        ('zone_b', 0.4, 40.0, 25.0, 60.0, 300.0, 35.0, 200.0, 140.0),
        ('zone_c', 0.6, 45.0, 40.0, 50.0, 250.0, 50.0, 350.0, 260.0),
        ('zone_d', 0.3, 25.0, 15.0, 65.0, 120.0, 30.0, 90.0, 55.0))
        z(zone_id, co, no2, pm25, o3, vehicles, speed, kwh, peak))"""
    h = "extract('hour' FROM ts)"
    factor = f"(1 + 0.4 * sin(({h} - 6) / 24.0 * 2 * pi()) + 0.4 * sin(({h} - 18) / 12.0 * 2 * pi()))"
    columns = []
    for metric, formula in metrics.items():
        level = f"CAST({formula} AS DOUBLE)"
        columns.append(f"ROUND({level}, 6) + 0.0 AS expected_{metric}")
        columns.append(f"ROUND({metric} - {level}, 6) + 0.0 AS residual_{metric}")
    return (
        f"WITH {RAW}, {zones}, lined AS (SELECT *, {factor} AS f FROM {table} LEFT JOIN zones USING (zone_id)) "
        f"SELECT ts AS timestamp, sensor_id, zone_id, {', '.join(metrics)}, {', '.join(columns)} FROM lined"
    )


def messages() -> str:
    """Every reading as the message that carries it, NULL where a topic has no such field."""
    fields = ["co_level", "no2_level", "pm25_level", "o3_level", "vehicle_count", "avg_speed_kmh",
              "kwh_consumed", "peak_demand_kw"]
    own = {"air": fields[:4], "traffic": fields[4:6], "energy": fields[6:]}
    parts = []
    for kind, names in own.items():
        absent = {f: f"CAST(NULL AS {'INT' if f == 'vehicle_count' else 'DOUBLE'}) AS {f}" for f in fields}
        columns = ", ".join(f if f in names else absent[f] for f in fields)
        parts.append(
            f"SELECT 'sensor_{kind}' AS topic, CAST(NULL AS VARCHAR) AS problem, ts AS timestamp, "
            f"sensor_id, zone_id, {columns} FROM raw_{kind}"
        )
    return raw(" UNION ALL ".join(parts))


INGESTED = """
    SELECT 'raw_air_quality' AS table_name, '' AS problem, COUNT(*) AS row_count FROM raw_air
    UNION ALL SELECT 'raw_traffic', '', COUNT(*) FROM raw_traffic
    UNION ALL SELECT 'raw_energy', '', COUNT(*) FROM raw_energy
    UNION ALL SELECT 'quarantine', 'missing_key', COUNT(*) FROM events WHERE event_type = 'signup'
    UNION ALL SELECT 'quarantine', 'bad_json', COUNT(*) FROM events WHERE event_type = 'purchase'
    UNION ALL SELECT 'quarantine', 'unknown_topic', COUNT(*) FROM events WHERE event_type = 'error'"""

SESSIONS = """,
marked AS (
    SELECT *, CASE WHEN ts - LAG(ts) OVER w <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens
    FROM raw_air WINDOW w AS (PARTITION BY sensor_id ORDER BY ts)
),
numbered AS (
    SELECT *, SUM(opens) OVER (PARTITION BY sensor_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run
    FROM marked
)
SELECT sensor_id, COUNT(*) AS readings, MIN(ts) AS first_seen, MAX(ts) AS last_seen
FROM numbered GROUP BY sensor_id, run"""

# Readings sent twice are stored once; every message is counted.
INGESTED_ONCE = """
    SELECT 'raw_air_quality' AS table_name, '' AS problem, COUNT(DISTINCT (sensor_id, ts)) AS row_count FROM raw_air
    UNION ALL SELECT 'raw_traffic', '', COUNT(DISTINCT (sensor_id, ts)) FROM raw_traffic
    UNION ALL SELECT 'raw_energy', '', COUNT(DISTINCT (sensor_id, ts)) FROM raw_energy
    UNION ALL SELECT 'quarantine', 'missing_key', 2 * COUNT(*) FROM events WHERE event_type = 'signup'
    UNION ALL SELECT 'quarantine', 'bad_json', 2 * COUNT(*) FROM events WHERE event_type = 'purchase'
    UNION ALL SELECT 'quarantine', 'unknown_topic', 2 * COUNT(*) FROM events WHERE event_type = 'error'
    UNION ALL SELECT 'messages', '', 2 * ((SELECT COUNT(*) FROM raw_air) + (SELECT COUNT(*) FROM raw_traffic)
        + (SELECT COUNT(*) FROM raw_energy)
        + (SELECT COUNT(*) FROM events WHERE event_type IN ('signup', 'purchase', 'error')))"""

# A whole day's readings are gone; everything else is as in a full refresh.
REFRESHED = "SELECT * FROM air_quality_hourly WHERE CAST(hour AS DATE) <> DATE '2024-01-22'"

# The air readings with the times of error events taken away.
TIMELESS = f"""WITH {RAW.replace("SELECT *, user_id % 12 AS u", "SELECT * REPLACE (CASE WHEN event_type <> 'error' THEN ts END AS ts), user_id % 12 AS u", 1)},
timeless AS (
    SELECT zone_id, date_trunc('hour', ts) AS hour, COUNT(*) AS reading_count,
           {num("AVG(pm25_level)", 2)} AS avg_pm25, {num("MAX(pm25_level)", 2)} AS max_pm25,
           {num("AVG(no2_level)", 2)} AS avg_no2, {num("AVG(co_level)", 2)} AS avg_co,
           {num("AVG(o3_level)", 2)} AS avg_o3
    FROM raw_air GROUP BY 1, 2
)
"""

GAPS = """
SELECT sensor_id, gap_start, gap_end, (epoch_us(gap_end) - epoch_us(gap_start)) / 1000000 AS gap_seconds
FROM (
    SELECT sensor_id, ts AS gap_end, LAG(ts) OVER (PARTITION BY sensor_id ORDER BY ts) AS gap_start FROM raw_air
)
WHERE gap_end - gap_start > INTERVAL 3 HOUR"""


def oracle_sql() -> dict[str, str]:
    model = {
        name: models(f"SELECT * FROM {name}")
        for name in ("air_quality_hourly", "traffic_hourly", "energy_hourly", "threshold_breaches", "sensor_health")
    }
    corr = models(correlation("joined_hours"))
    return {
        **model,
        "traffic_pollution_correlation": corr,
        "panel_recent_air": panel("raw_air", "pm25_level"),
        "panel_recent_traffic": panel("raw_traffic", "vehicle_count"),
        "panel_recent_energy": panel("raw_energy", "kwh_consumed"),
        "panel_sensor_health": models(
            "SELECT sensor_id, recent_readings, recent_avg_pm25, health_status FROM sensor_health"
        ),
        "panel_correlation": corr,
        "raw_row_counts": raw(
            "SELECT 'raw_air_quality' AS table_name, COUNT(*) AS row_count FROM raw_air UNION ALL "
            "SELECT 'raw_traffic', COUNT(*) FROM raw_traffic UNION ALL "
            "SELECT 'raw_energy', COUNT(*) FROM raw_energy"
        ),
        "quality_raw": quality_raw(),
        "quality_models": quality_models(),
        "silent_sensors": raw(
            "SELECT sensor_id, MAX(ts) AS last_seen, "
            f"(epoch_us({NOW}) - epoch_us(MAX(ts))) / 1000000 AS silent_seconds "
            f"FROM raw_air GROUP BY 1 HAVING {NOW} - MAX(ts) > INTERVAL 1 DAY"
        ),
        "reading_gaps": raw(GAPS),
        "expected_air": expected(
            "raw_air",
            {"co_level": "co * f", "no2_level": "no2 * f", "pm25_level": "pm25 * f", "o3_level": "o3"},
        ),
        "expected_traffic": expected(
            "raw_traffic", {"vehicle_count": "vehicles * f", "avg_speed_kmh": "speed / greatest(0.5, f)"}
        ),
        "expected_energy": expected("raw_energy", {"kwh_consumed": "kwh * f", "peak_demand_kw": "peak * f"}),
        "message_roundtrip": messages(),
        "table_sensor_health": model["sensor_health"],
        "table_time_range": raw(
            "SELECT ts AS timestamp, sensor_id, zone_id, kwh_consumed, peak_demand_kw FROM raw_energy "
            "WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-12 18:00:00'"
        ),
        "table_refreshed_days": models(REFRESHED),
        "sql_compacted_counts": raw("""SELECT sensor_id, CAST(sum(CASE WHEN CAST(ts AS DATE) = DATE '2024-01-05' THEN 2 ELSE 1 END) AS BIGINT) AS readings
            FROM raw_energy GROUP BY sensor_id"""),
        "table_compacted": raw("SELECT ts AS timestamp, sensor_id, zone_id, kwh_consumed, peak_demand_kw FROM raw_energy"),
        "null_hours": TIMELESS + "SELECT * FROM timeless",
        "quality_null_hours": TIMELESS + " UNION ALL ".join(
            _missing("air_quality_hourly", "timeless", c, f"not_null({c})") for c in ("zone_id", "hour", "avg_pm25")
        ),
        "sql_sensor_health": model["sensor_health"],
        "view_threshold_breaches": model["threshold_breaches"],
        "stream_ingest_deduped": raw(INGESTED_ONCE),
        "stream_ingest_counts": raw(INGESTED),
        "stream_air_quality_hourly": model["air_quality_hourly"],
        "stream_traffic_hourly": model["traffic_hourly"],
        "stream_energy_hourly": model["energy_hourly"],
        "stream_joined_hours": models("SELECT * FROM joined_hours"),
        "stream_correlation": corr,
        "stream_sensor_health": model["sensor_health"],
        "stream_activity_sessions": raw(SESSIONS),
    }
