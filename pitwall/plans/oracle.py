"""DuckDB twins of the fixture views (the correctness oracle's inputs).

The text follows FIXTURES.md; only the JSON accessor and the epoch function are
DuckDB-specific.  ``with_fixture(body)`` prefixes any oracle query with the views.
"""

from __future__ import annotations

TRACK_POINTS_SQL = """track_points AS (
  SELECT 'ellipse' AS track_id, CAST(idx AS INT) AS idx,
    round(CAST(1000 AS DOUBLE) * cos(CAST(2 AS DOUBLE) * pi() * idx / CAST(2000 AS DOUBLE)), 6) AS x,
    round(CAST(400 AS DOUBLE) * sin(CAST(2 AS DOUBLE) * pi() * idx / CAST(2000 AS DOUBLE)), 6) AS y
  FROM (SELECT range AS idx FROM range(2000)) r
)"""

TELEMETRY_SQL = """telemetry AS (
SELECT user_id AS car_id, 'ellipse' AS track_id, event_id AS seq, ts AS event_time, epoch_us(ts) AS timestamp,
  lap_count * CAST(518400 AS DOUBLE) + lap_time AS time, lap_count, lap_time, value AS speed_kmh,
  k / CAST(100 AS DOUBLE) AS throttle,
  CASE WHEN k < 20 THEN (20 - k) / CAST(20 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS brake,
  (((event_id * 37) % 601) - 300) / CAST(100 AS DOUBLE) AS g_lat,
  (((event_id * 53) % 901) - 500) / CAST(100 AS DOUBLE) AS g_long,
  CAST(110 AS DOUBLE) - event_id / CAST(1000 AS DOUBLE) AS fuel_kg,
  event_id / CAST(2000 AS DOUBLE) AS tire_wear_pct,
  CAST(10000 + (event_id * 31) % 2500 AS DOUBLE) AS rpm,
  CASE WHEN value < 80 THEN 1 WHEN value < 120 THEN 2 WHEN value < 160 THEN 3 WHEN value < 200 THEN 4
       WHEN value < 240 THEN 5 WHEN value < 270 THEN 6 WHEN value < 310 THEN 7 WHEN value < 1000 THEN 8 ELSE 1 END AS gear,
  CASE WHEN true_idx < 660 THEN 'Sector 1' WHEN true_idx < 1320 THEN 'Sector 2' ELSE 'Sector 3' END AS sector_name,
  CASE WHEN lap_count = 0 THEN CAST(0 AS DOUBLE)
       ELSE CAST(80 AS DOUBLE) + ((user_id * 7 + lap_count * 13) % 50) / CAST(10 AS DOUBLE) END AS last_lap_time,
  p.x + (((event_id * 13) % 21) - 10) / CAST(100 AS DOUBLE) AS x,
  p.y + (((event_id * 17) % 21) - 10) / CAST(100 AS DOUBLE) AS y
FROM (
  SELECT *, CAST(floor(lap_time * 2000 / 518400) AS INT) AS true_idx FROM (
    SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k,
      CAST(floor((day(ts) - 1) / 6) AS INT) AS lap_count,
      CAST(((day(ts) - 1) % 6) * 86400 + hour(ts) * 3600 + minute(ts) * 60 + floor(second(ts)) AS DOUBLE) AS lap_time
    FROM events) a) e
JOIN track_points p ON p.idx = e.true_idx
)"""


def with_fixture(body: str, *ctes: str) -> str:
    """``WITH track_points, telemetry[, ctes...] <body>``."""
    parts = [TRACK_POINTS_SQL, TELEMETRY_SQL, *ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


LAP_SUMMARY_CTE = """lap_summary AS (
SELECT car_id, lap_count,
  round(avg(speed_kmh), 6) AS avg_speed_kmh,
  max(speed_kmh) AS max_speed_kmh,
  min(speed_kmh) AS min_speed_kmh,
  round(avg(throttle), 6) AS avg_throttle,
  round(avg(brake), 6) AS avg_brake,
  sum(CAST(throttle > CAST(0.5 AS DOUBLE) AS INTEGER)) / count(*) * 100 AS throttle_pct,
  max(g_lat) AS max_g_lat,
  max(g_long) AS max_g_long,
  min(g_long) AS min_g_long,
  arg_min_null(fuel_kg, seq) AS fuel_start_kg,
  arg_max_null(fuel_kg, seq) AS fuel_end_kg,
  arg_min_null(fuel_kg, seq) - arg_max_null(fuel_kg, seq) AS fuel_used_kg,
  arg_min_null(fuel_kg, seq) - arg_max_null(fuel_kg, seq) AS fuel_per_lap,
  max(tire_wear_pct) AS tire_wear_pct,
  max(tire_wear_pct) - arg_min_null(tire_wear_pct, seq) AS tire_deg_rate,
  round(avg(throttle) * 50 + avg(brake) * 50, 6) AS aggression_index,
  max(lap_time) AS lap_time_s,
  arg_max_null(last_lap_time, seq) AS last_lap_time_s,
  count(*) AS sample_count,
  arg_min_null(timestamp, seq) AS lap_start_timestamp,
  arg_max_null(timestamp, seq) AS lap_end_timestamp,
  (max(timestamp) - min(timestamp)) / CAST(1000 AS DOUBLE) AS lap_duration_ms
FROM telemetry WHERE lap_count IS NOT NULL
GROUP BY car_id, lap_count
)"""

LAP_BOUNDARY_CTE = """boundaries AS (
SELECT *, greatest(coalesce(lap_count, 0), previous_lap) AS effective_lap,
  (previous_lap IS NULL OR coalesce(lap_count, 0) > previous_lap) AS is_lap_start
FROM (SELECT *, max(coalesce(lap_count, 0)) OVER (PARTITION BY car_id ORDER BY seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_lap
      FROM telemetry) b
)"""

DT_CTE = (
    """lagged AS (
SELECT *, lag(timestamp) OVER (PARTITION BY car_id ORDER BY seq) AS prev_us FROM telemetry
)""",
    """dt AS (
SELECT *, CASE WHEN prev_us IS NULL THEN CAST(0 AS DOUBLE)
  ELSE least((timestamp - prev_us) / CAST(1000000 AS DOUBLE), CAST(0.1 AS DOUBLE)) END AS dt FROM lagged
)""",
)
