"""Registered queries: one Spark plan per operator plus its DuckDB oracle text.

Every query reads the driver's tables (``events`` through the telemetry view) so its
work grows with them.  ``SQL[name]`` is absent where no SQL twin exists.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from pitwall.operators import clean as C
from pitwall.operators import fusion as FU
from pitwall.operators import laps as L
from pitwall.operators import matching as M
from pitwall.operators import track as TR
from pitwall.plans import track_sql as TS
from pitwall.plans.oracle import DT_CTE, LAP_BOUNDARY_CTE, LAP_SUMMARY_CTE, with_fixture
from pitwall.schema import WIRE_KEYS
from pitwall.sources.fixtures import telemetry, track_points
from pitwall.sources.packets import encode_packets

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


# --------------------------------------------------------------------------- laps


@register("lap_summary", with_fixture("SELECT * FROM lap_summary", LAP_SUMMARY_CTE))
def q_lap_summary(spark, sf_dir):
    return L.lap_summary(telemetry(spark, sf_dir))


@register(
    "lap_quality",
    with_fixture(
        """SELECT car_id, lap_count, round(stddev_samp(speed_kmh), 6) AS consistency_score,
  CAST(sum(CASE WHEN brake > CAST(0.1 AS DOUBLE) AND NOT coalesce(prev_brake > CAST(0.1 AS DOUBLE), false)
       THEN 1 ELSE 0 END) AS BIGINT) AS braking_zones_count,
  count(*) AS sample_count
FROM (SELECT *, lag(brake) OVER (PARTITION BY car_id, lap_count ORDER BY seq) AS prev_brake
      FROM telemetry WHERE lap_count IS NOT NULL) t
GROUP BY car_id, lap_count"""
    ),
)
def q_lap_quality(spark, sf_dir):
    return L.lap_quality(telemetry(spark, sf_dir))


SESSION_SQL = with_fixture(
    """SELECT car_id, count(*) AS total_laps, max(lap_count) AS last_lap,
  min(CASE WHEN last_lap_time_s > 0 AND last_lap_time_s < 'inf'::DOUBLE
      THEN {'t': last_lap_time_s, 'lap': lap_count} END).lap AS best_lap,
  min(CASE WHEN last_lap_time_s > 0 AND last_lap_time_s < 'inf'::DOUBLE
      THEN {'t': last_lap_time_s, 'lap': lap_count} END).t AS best_lap_time_s,
  round(avg(CASE WHEN last_lap_time_s > 0 AND last_lap_time_s < 'inf'::DOUBLE THEN last_lap_time_s END), 6)
      AS avg_lap_time_s
FROM lap_summary WHERE lap_count > 0 GROUP BY car_id""",
    LAP_SUMMARY_CTE,
)


@register("session_summary", SESSION_SQL)
def q_session_summary(spark, sf_dir):
    return L.session_summary(L.lap_summary(telemetry(spark, sf_dir)))


@register(
    "lap_table",
    with_fixture(
        """SELECT l.car_id, l.lap_count,
  printf('%.1f', round(coalesce(avg_speed_kmh, 0), 1)) AS avg_speed_text,
  printf('%.1f', round(coalesce(max_speed_kmh, 0), 1)) AS max_speed_text,
  printf('%.2f', round(coalesce(fuel_used_kg, 0), 2)) AS fuel_used_text,
  printf('%.1f%%', round(coalesce(throttle_pct, 0), 1)) AS throttle_text,
  CASE WHEN coalesce(last_lap_time_s, 0) > 0 THEN printf('%.3f', round(last_lap_time_s, 3)) ELSE '--' END
      AS lap_time_text,
  CAST(coalesce(sample_count, 0) AS VARCHAR) AS samples_text,
  printf('%.2f', round(coalesce(fuel_per_lap, 0), 2)) AS fuel_per_lap_text,
  printf('%.2f', round(coalesce(tire_deg_rate, 0), 2)) AS tire_deg_text,
  printf('%.1f', round(coalesce(aggression_index, 0), 1)) AS aggression_text,
  coalesce(b.best_lap = l.lap_count, false) AS is_best_lap,
  printf('Lap %d: Avg Speed=%.1f km/h, Fuel Used=%.2f kg, Samples=%d', l.lap_count,
      round(coalesce(avg_speed_kmh, 0), 1), round(coalesce(fuel_used_kg, 0), 2), sample_count) AS summary_line
FROM lap_summary l LEFT JOIN (
  SELECT car_id, min({'t': last_lap_time_s, 'lap': lap_count}).lap AS best_lap FROM lap_summary
  WHERE lap_count > 0 AND last_lap_time_s > 0 AND last_lap_time_s < 'inf'::DOUBLE GROUP BY car_id) b
ON l.car_id = b.car_id
WHERE l.lap_count > 0""",
        LAP_SUMMARY_CTE,
    ),
)
def q_lap_table(spark, sf_dir):
    return L.lap_table(L.lap_summary(telemetry(spark, sf_dir)))


@register(
    "last_n_laps",
    with_fixture(
        """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY car_id ORDER BY lap_count DESC) AS recency
FROM lap_summary) t WHERE recency <= 5""",
        LAP_SUMMARY_CTE,
    ),
)
def q_last_n_laps(spark, sf_dir):
    return L.last_n_laps(L.lap_summary(telemetry(spark, sf_dir)), 5)


@register(
    "lap_boundaries",
    with_fixture(
        """SELECT car_id, seq, lap_count, CAST(effective_lap AS INT) AS effective_lap, is_lap_start,
  CAST(previous_lap AS INT) AS previous_lap FROM boundaries""",
        LAP_BOUNDARY_CTE,
    ),
)
def q_lap_boundaries(spark, sf_dir):
    b = L.lap_boundaries(telemetry(spark, sf_dir).select("car_id", "seq", "lap_count"))
    return b.select("car_id", "seq", "lap_count", "effective_lap", "is_lap_start", "previous_lap")


@register(
    "lap_history",
    with_fixture(
        """SELECT car_id, lap, lap_time,
  CASE WHEN best_before IS NULL OR lap_time < best_before THEN 'PB' ELSE 'OK' END AS status
FROM (SELECT *, min(lap_time) OVER (PARTITION BY car_id ORDER BY seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before
      FROM (SELECT car_id, seq, CAST(previous_lap AS INT) AS lap, coalesce(last_lap_time, 0) AS lap_time
            FROM boundaries WHERE is_lap_start AND previous_lap IS NOT NULL
              AND coalesce(last_lap_time, 0) > 0) h) p""",
        LAP_BOUNDARY_CTE,
    ),
)
def q_lap_history(spark, sf_dir):
    return L.lap_history(telemetry(spark, sf_dir))


@register(
    "live_state",
    with_fixture(
        """SELECT car_id, s.seq AS seq,
  CAST(CAST(trunc(coalesce(s.speed_kmh, 0)) AS BIGINT) AS VARCHAR) AS speed_text,
  coalesce(CAST(s.gear AS VARCHAR), 'N') AS gear_text,
  CAST(CAST(trunc(coalesce(s.rpm, 0)) AS BIGINT) AS VARCHAR) AS rpm_text,
  printf('%.3f', round(coalesce(s.lap_time, 0), 3)) AS lap_time_text,
  printf('%.1f KG', round(coalesce(s.fuel_kg, 0), 1)) AS fuel_text,
  coalesce(s.fuel_kg, 0) < 10 AS low_fuel,
  printf('%.1f%%', round(coalesce(s.tire_wear_pct, 0), 1)) AS wear_text,
  coalesce(s.x, 0) AS x, coalesce(s.y, 0) AS y
FROM (SELECT car_id, arg_max_null({'seq': seq, 'speed_kmh': speed_kmh, 'gear': gear, 'rpm': rpm,
        'lap_time': lap_time, 'fuel_kg': fuel_kg, 'tire_wear_pct': tire_wear_pct, 'x': x, 'y': y},
        seq) AS s
      FROM telemetry GROUP BY car_id) l"""
    ),
)
def q_live_state(spark, sf_dir):
    return L.live_state(telemetry(spark, sf_dir))


@register(
    "fuel_alerts",
    with_fixture("""SELECT car_id, seq, timestamp, fuel_kg - CAST(11 AS DOUBLE) * (car_id % 10) AS fuel_kg FROM telemetry
WHERE fuel_kg - CAST(11 AS DOUBLE) * (car_id % 10) < 10"""),
)
def q_fuel_alerts(spark, sf_dir):
    """Cars start with 110 kg less 11 for each unit of their number, so some run low."""
    start = F.col("fuel_kg") - F.lit(11.0) * (F.col("car_id") % 10)
    return L.fuel_alerts(telemetry(spark, sf_dir).withColumn("fuel_kg", start))


@register(
    "sector_times",
    with_fixture(
        """SELECT car_id, lap_count,
  (max(CASE WHEN sector_name = 'Sector 1' THEN timestamp END)
    - min(CASE WHEN sector_name = 'Sector 1' THEN timestamp END)) / CAST(1000000 AS DOUBLE) AS sector_1_s,
  count(CASE WHEN sector_name = 'Sector 1' THEN 1 END) AS sector_1_samples,
  (max(CASE WHEN sector_name = 'Sector 2' THEN timestamp END)
    - min(CASE WHEN sector_name = 'Sector 2' THEN timestamp END)) / CAST(1000000 AS DOUBLE) AS sector_2_s,
  count(CASE WHEN sector_name = 'Sector 2' THEN 1 END) AS sector_2_samples,
  (max(CASE WHEN sector_name = 'Sector 3' THEN timestamp END)
    - min(CASE WHEN sector_name = 'Sector 3' THEN timestamp END)) / CAST(1000000 AS DOUBLE) AS sector_3_s,
  count(CASE WHEN sector_name = 'Sector 3' THEN 1 END) AS sector_3_samples
FROM telemetry WHERE lap_count IS NOT NULL GROUP BY car_id, lap_count"""
    ),
)
def q_sector_times(spark, sf_dir):
    return L.sector_times(telemetry(spark, sf_dir))


# ----------------------------------------------------------------- decode / clean


def raw_packets(spark, sf_dir, ts_unit="ns"):
    """Wire packets derived from the telemetry view (timestamp in ``ts_unit``)."""
    return encode_packets(telemetry(spark, sf_dir), ts_unit)


_WIRE_SQL = ", ".join("timestamp * 1000 AS timestamp" if k == "timestamp" else k for k in WIRE_KEYS)


@register(
    "decode_json",
    with_fixture(f"SELECT car_id, track_id, seq, epoch_us(event_time) AS event_us, {_WIRE_SQL} FROM telemetry"),
)
def q_decode_json(spark, sf_dir):
    d = C.decode_packets(raw_packets(spark, sf_dir), ts_unit="ns")
    return d.select("car_id", "track_id", "seq", F.unix_micros("event_time").alias("event_us"), *WIRE_KEYS)


@register(
    "event_time",
    with_fixture(
        """SELECT car_id, seq, epoch_us(event_time) AS from_ns_us, epoch_us(event_time) AS from_us_us,
  (timestamp // 1000) * 1000 AS from_ms_us, (timestamp // 1000000) * 1000000 AS from_s_us FROM telemetry"""
    ),
)
def q_event_time(spark, sf_dir):
    tel = telemetry(spark, sf_dir).select("car_id", "seq", "timestamp")
    us = F.col("timestamp")
    return tel.select(
        "car_id",
        "seq",
        F.unix_micros(C.event_time(us * 1000, "ns")).alias("from_ns_us"),
        F.unix_micros(C.event_time(us, "us")).alias("from_us_us"),
        F.unix_micros(C.event_time(C.floor_div(us, 1000), "ms")).alias("from_ms_us"),
        F.unix_micros(C.event_time(C.floor_div(us, 1000000), "s")).alias("from_s_us"),
    )


@register(
    "archive_points",
    with_fixture(
        """SELECT car_id, track_id, timestamp * 1000 AS time, speed_kmh, CAST(trunc(rpm) AS INTEGER) AS rpm,
  gear, throttle, brake, g_lat, g_long FROM telemetry"""
    ),
)
def q_archive_points(spark, sf_dir):
    return C.archive_points(raw_packets(spark, sf_dir))


def faulty_packets(spark, sf_dir):
    """The wire packets with a fixed share damaged, by the last digits of their sequence."""
    json, kind = F.col("json"), F.col("seq") % 40
    damaged = (
        F.when(kind == 1, F.lit("not json"))
        .when(kind == 2, F.lit("{}"))
        .when(kind == 3, F.regexp_replace(json, r'"speed_kmh":[^,}]*', '"speed_kmh":"fast"'))
        .when(kind == 4, F.regexp_replace(json, r"^\{", '{"extra":1,'))
        .when(kind == 5, F.regexp_replace(json, r',"gear":[^,}]*', ""))
        .when(kind == 6, F.regexp_replace(json, r'"speed_kmh":([^,}]*)', '"speed_kmh":"$1"'))
        .when(kind == 7, F.regexp_replace(json, r'"gear":([0-9]+)', '"gear":$1.0'))
    )
    return raw_packets(spark, sf_dir).withColumn("json", F.coalesce(damaged, json))


@register(
    "quarantine",
    with_fixture("""SELECT car_id, track_id, seq, CASE seq % 40 WHEN 1 THEN 'malformed_json'
  WHEN 2 THEN 'missing_timestamp' ELSE 'bad_type:speed_kmh' END AS reasons
FROM telemetry WHERE seq % 40 IN (1, 2, 3)"""),
)
def q_quarantine(spark, sf_dir):
    bad = C.quarantine(faulty_packets(spark, sf_dir))
    return bad.select("car_id", "track_id", "seq", F.array_join("reasons", ",").alias("reasons"))


@register(
    "archive_coercion",
    with_fixture(
        """SELECT car_id, track_id, timestamp * 1000 AS time, speed_kmh, CAST(trunc(rpm) AS INTEGER) AS rpm,
  CASE WHEN seq % 40 = 5 THEN 0 ELSE gear END AS gear, throttle, brake, g_lat, g_long
FROM telemetry WHERE seq % 40 NOT IN (1, 2, 3)"""
    ),
)
def q_archive_coercion(spark, sf_dir):
    """D3-D5 on damaged packets: numeric text and whole floats are archived, a missing gear is 0."""
    return C.archive_points(faulty_packets(spark, sf_dir))


@register(
    "schema_violations",
    with_fixture(f"""SELECT car_id, track_id, seq, key, kind FROM (
  SELECT car_id, track_id, seq, 'extra' AS key, 'unknown' AS kind FROM telemetry WHERE seq % 40 = 4
  UNION ALL SELECT car_id, track_id, seq, 'gear', 'missing' FROM telemetry WHERE seq % 40 = 5
  UNION ALL SELECT car_id, track_id, seq, unnest([{", ".join(f"'{k}'" for k in WIRE_KEYS)}]), 'missing'
    FROM telemetry WHERE seq % 40 = 2) v"""),
)
def q_schema_violations(spark, sf_dir):
    return C.schema_violations(faulty_packets(spark, sf_dir))


@register(
    "lap_json",
    with_fixture("SELECT car_id || '|' || lap_count AS record_key, * FROM lap_summary", LAP_SUMMARY_CTE),
)
def q_lap_json(spark, sf_dir):
    """The JSON records, compared by key and by the values decoded from their text."""
    records = C.lap_json(L.lap_summary(telemetry(spark, sf_dir)))
    return C.decode_lap_json(records.select(F.col("key").alias("record_key"), "value"))


@register("latest_lap_state", with_fixture("SELECT * FROM lap_summary WHERE lap_count > 0", LAP_SUMMARY_CTE))
def q_latest_lap_state(spark, sf_dir):
    """Every lap has two earlier versions with other values; the highest version counts."""
    laps = L.lap_summary(telemetry(spark, sf_dir))
    versions = None
    for version, speed in ((2, F.col("max_speed_kmh")), (0, F.lit(-1.0)), (1, F.col("max_speed_kmh") / 2)):
        rows = C.lap_json(laps.withColumn("max_speed_kmh", speed)).withColumn("_v", F.lit(version))
        versions = rows if versions is None else versions.unionByName(rows)
    latest = L.latest_per_key(C.decode_lap_json(versions), ["car_id", "lap_count"], "_v")
    return latest.drop("_v").filter(F.col("lap_count") > 0)


# ------------------------------------------------------------ per-sample channels


@register(
    "sample_dt",
    with_fixture("SELECT car_id, seq, round(dt, 6) AS dt_s FROM dt", *DT_CTE),
)
def q_sample_dt(spark, sf_dir):
    return FU.sample_dt(telemetry(spark, sf_dir))


@register(
    "cumulative_distance",
    with_fixture(
        """SELECT car_id, seq, round(dt, 6) AS dt_s,
  round(sum(speed_kmh / CAST(3.6 AS DOUBLE) * dt) OVER (PARTITION BY car_id ORDER BY seq ROWS UNBOUNDED PRECEDING), 6)
      AS distance_m FROM dt""",
        *DT_CTE,
    ),
)
def q_cumulative_distance(spark, sf_dir):
    return FU.cumulative_distance(telemetry(spark, sf_dir))


@register(
    "tire_wear",
    with_fixture(
        """SELECT car_id, seq, round(dist, 6) AS distance_m, round(g, 6) AS grip,
  round((CAST(1 AS DOUBLE) - g / CAST(1.1 AS DOUBLE)) * CAST(100 AS DOUBLE), 6) AS wear_pct
FROM (SELECT *, greatest(CAST(0.5 AS DOUBLE), CAST(1.1 AS DOUBLE) - dist * CAST(0.000001 AS DOUBLE)) AS g
      FROM (SELECT *, sum(speed_kmh / CAST(3.6 AS DOUBLE) * dt)
                OVER (PARTITION BY car_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS dist FROM dt) a) b""",
        *DT_CTE,
    ),
)
def q_tire_wear(spark, sf_dir):
    return FU.tire_wear(telemetry(spark, sf_dir))


@register(
    "fuel_estimate",
    with_fixture(
        """SELECT car_id, seq, round(greatest(CAST(0 AS DOUBLE), CAST(110 AS DOUBLE) - coalesce(burn, 0)), 6)
  AS fuel_est_kg
FROM (SELECT *, sum(CAST(0.002 AS DOUBLE) * throttle * dt * (speed_kmh / CAST(3.6 AS DOUBLE) / CAST(100 AS DOUBLE)
        + CAST(1 AS DOUBLE))) OVER (PARTITION BY car_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS burn FROM dt) a""",
        *DT_CTE,
    ),
)
def q_fuel_estimate(spark, sf_dir):
    return FU.fuel_estimate(telemetry(spark, sf_dir))


@register(
    "derived_channels",
    with_fixture(
        """SELECT car_id, seq, round(vk, 6) AS speed_kmh_clamped, round(v, 6) AS speed_ms,
  round(CAST(798 AS DOUBLE) + fuel_kg, 6) AS total_mass_kg,
  round(CAST(0.6125 AS DOUBLE) * v * v * CAST(1.2 AS DOUBLE) * CAST(1.6 AS DOUBLE), 6) AS downforce_n,
  round(CAST(0.6125 AS DOUBLE) * v * v * CAST(0.9 AS DOUBLE) * CAST(1.6 AS DOUBLE), 6) AS drag_n,
  round(CASE WHEN gap > 0 THEN (v - pv) / gap / CAST(9.81 AS DOUBLE) END, 6) + CAST(0 AS DOUBLE) AS accel_long_g
FROM (SELECT *, vk / CAST(3.6 AS DOUBLE) AS v,
        CASE WHEN prev_v IS NULL THEN NULL ELSE greatest(CAST(0 AS DOUBLE), prev_v) END / CAST(3.6 AS DOUBLE) AS pv,
        (timestamp - prev_us) / CAST(1000000 AS DOUBLE) AS gap
      FROM (SELECT *, CASE WHEN speed_kmh IS NULL THEN NULL ELSE greatest(CAST(0 AS DOUBLE), speed_kmh) END AS vk,
              lag(speed_kmh) OVER (PARTITION BY car_id ORDER BY seq) AS prev_v,
              lag(timestamp) OVER (PARTITION BY car_id ORDER BY seq) AS prev_us
            FROM telemetry) a) b"""
    ),
)
def q_derived_channels(spark, sf_dir):
    return FU.derived_channels(telemetry(spark, sf_dir))


@register(
    "gear_band",
    with_fixture(
        """SELECT car_id, seq, speed_kmh, gear, band AS gear_band, coalesce(band = gear, false) AS gear_matches
FROM (SELECT *, CASE WHEN speed_kmh < 80 THEN 1 WHEN speed_kmh < 120 THEN 2 WHEN speed_kmh < 160 THEN 3
  WHEN speed_kmh < 200 THEN 4 WHEN speed_kmh < 240 THEN 5 WHEN speed_kmh < 270 THEN 6 WHEN speed_kmh < 310 THEN 7
  WHEN speed_kmh < 1000 THEN 8 ELSE 1 END AS band FROM telemetry) t"""
    ),
)
def q_gear_band(spark, sf_dir):
    return FU.gear_check(telemetry(spark, sf_dir))


DOWNSAMPLE_S = 43200  # half a day: the fixture's cars report every few hours


@register(
    "downsample",
    with_fixture(
        f"""SELECT car_id, CAST(floor(timestamp / CAST({DOWNSAMPLE_S * 1000000} AS DOUBLE)) AS BIGINT) AS bucket,
  arg_min_null(seq, seq) AS seq,
  arg_min_null(timestamp, seq) AS event_us,
  arg_min_null(speed_kmh, seq) AS speed_kmh
FROM telemetry GROUP BY car_id, CAST(floor(timestamp / CAST({DOWNSAMPLE_S * 1000000} AS DOUBLE)) AS BIGINT)"""
    ),
)
def q_downsample(spark, sf_dir):
    d = FU.downsample(telemetry(spark, sf_dir).select("car_id", "seq", "event_time", "speed_kmh"), DOWNSAMPLE_S)
    return d.select("car_id", "bucket", "seq", F.unix_micros("event_time").alias("event_us"), "speed_kmh")


GATE_S = 43200  # the gate period for the fixture's cars (samples are hours apart)


@register(
    "rate_gate",
    with_fixture(
        f"""SELECT g.car_id, g.seq, g.us AS event_us, t.speed_kmh FROM gate g JOIN telemetry t USING (car_id, seq)""",
        f"""gate(car_id, seq, us) AS (
  SELECT car_id, min({{'u': timestamp, 's': seq}}).s, min({{'u': timestamp, 's': seq}}).u FROM telemetry GROUP BY car_id
  UNION ALL
  SELECT g.car_id, x.m.s, x.m.u FROM gate g,
    LATERAL (SELECT min({{'u': p.timestamp, 's': p.seq}}) AS m FROM telemetry p
             WHERE p.car_id = g.car_id AND p.timestamp >= g.us + {GATE_S * 1000000}) x
  WHERE x.m IS NOT NULL
)""",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def q_rate_gate(spark, sf_dir):
    """H8 exact greedy gate (chunked, see ``fusion.rate_gate``)."""
    g = FU.rate_gate(telemetry(spark, sf_dir), GATE_S, ["speed_kmh"])
    return g.select("car_id", "seq", F.unix_micros("event_time").alias("event_us"), "speed_kmh")


FUSION_PERIODS = {"gps": 86400.0, "ecu": 43200.0}
_FUSED = ["speed_kmh", "x", "y", "sector_name", "lap_count", "g_lat", "g_long", "rpm", "gear", "throttle",
          "brake", "fuel_kg", "tire_wear_pct", "lap_time", "last_lap_time", "time"]


def _ds_sql(name, fields, period):
    s = ", ".join(f"'{f}': {f}" for f in ["seq", "timestamp", *fields])
    b = f"floor(timestamp / CAST({int(period * 1000000)} AS DOUBLE))"
    return f"""{name} AS (SELECT r.* FROM (SELECT arg_min_null({{{s}}}, seq) AS r
  FROM telemetry GROUP BY car_id, {b}) x)"""


_FUSION_SQL = with_fixture(
    "SELECT car_id, timestamp AS event_us, seq, "
    + ", ".join(
        f"last_value({f} IGNORE NULLS) OVER (PARTITION BY car_id ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS {f}"
        for f in _FUSED
    )
    + "\nFROM ticks",
    _ds_sql("gps", ["car_id", "x", "y", "sector_name", "lap_count"], 86400.0).replace(
        "'seq': seq", "'car_id': car_id, 'seq': seq").replace("'car_id': car_id, 'seq': seq, 'timestamp': timestamp, 'car_id': car_id",
        "'car_id': car_id, 'seq': seq, 'timestamp': timestamp"),
    _ds_sql("ecu", ["car_id", "rpm", "gear", "throttle", "brake", "fuel_kg", "tire_wear_pct"], 43200.0).replace(
        "'seq': seq", "'car_id': car_id, 'seq': seq").replace("'car_id': car_id, 'seq': seq, 'timestamp': timestamp, 'car_id': car_id",
        "'car_id': car_id, 'seq': seq, 'timestamp': timestamp"),
    """readings AS (
  SELECT car_id, seq, timestamp, 0 AS rk, speed_kmh, NULL::DOUBLE AS x, NULL::DOUBLE AS y, NULL::VARCHAR AS sector_name,
    NULL::INTEGER AS lap_count, NULL::DOUBLE AS g_lat, NULL::DOUBLE AS g_long, NULL::DOUBLE AS rpm, NULL::INTEGER AS gear,
    NULL::DOUBLE AS throttle, NULL::DOUBLE AS brake, NULL::DOUBLE AS fuel_kg, NULL::DOUBLE AS tire_wear_pct,
    NULL::DOUBLE AS lap_time, NULL::DOUBLE AS last_lap_time, NULL::DOUBLE AS time FROM telemetry
  UNION ALL SELECT car_id, seq, timestamp, 1, NULL, x, y, sector_name, lap_count, NULL, NULL, NULL, NULL, NULL, NULL,
    NULL, NULL, NULL, NULL, NULL FROM gps
  UNION ALL SELECT car_id, seq, timestamp, 2, NULL, NULL, NULL, NULL, NULL, g_lat, g_long, NULL, NULL, NULL, NULL,
    NULL, NULL, NULL, NULL, NULL FROM telemetry
  UNION ALL SELECT car_id, seq, timestamp, 3, NULL, NULL, NULL, NULL, NULL, NULL, NULL, rpm, gear, throttle, brake,
    fuel_kg, tire_wear_pct, NULL, NULL, NULL FROM ecu
  UNION ALL SELECT car_id, seq, timestamp, 4, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
    NULL, NULL, lap_time, last_lap_time, time FROM telemetry)""",
    "ticks AS (SELECT car_id, timestamp, max(seq) AS seq, "
    + ", ".join(f"arg_max({f}, rk) AS {f}" for f in _FUSED)
    + " FROM readings GROUP BY car_id, timestamp)",
)


@register("sensor_fusion", _FUSION_SQL)
def q_sensor_fusion(spark, sf_dir):
    sensors = FU.sensor_tables(telemetry(spark, sf_dir), FUSION_PERIODS)
    f = FU.sensor_fusion(sensors)
    return f.select("car_id", F.unix_micros("event_time").alias("event_us"), "seq", *_FUSED)


# ------------------------------------------------------------------ track / spatial

RESAMPLE_K = 10
# Fixed origin for expressing the rebuilt centreline in degrees (any point works).
LON0, LAT0 = 7.0, 45.0


def matched(spark, sf_dir):
    return M.map_match(telemetry(spark, sf_dir), track_points(spark))


def fixture_geometry(spark):
    return TR.track_geometry(track_points(spark))


def centre(spark, sf_dir):
    return M.centreline(matched(spark, sf_dir))


def rebuilt_geometry(spark, sf_dir):
    return TR.track_geometry(TR.resample_closed(centre(spark, sf_dir), RESAMPLE_K))


_GEO_FIX = TS.geometry_cte("geo_fix", "track_points")
_PROF_FIX = TS.profile_cte("prof_fix", "geo_fix")
_CENTRE = TS.centreline_cte("centre", "matched")
_RESAMPLED = TS.resample_cte("resampled", "centre", RESAMPLE_K)
_GEO_RE = TS.geometry_cte("geo_re", "resampled")
_PROF_RE = TS.profile_cte("prof_re", "geo_re")


@register(
    "map_match",
    with_fixture(
        """SELECT m.car_id, m.seq, m.idx, round(m.match_dist_m, 6) AS match_dist_m, round(g.s, 6) AS track_s
FROM matched m JOIN geo_fix g ON g.track_id = m.track_id AND g.idx = m.idx""",
        TS.MATCHED_CTE, _GEO_FIX,
    ),
)
def q_map_match(spark, sf_dir):
    m = M.with_track_distance(matched(spark, sf_dir), fixture_geometry(spark))
    return m.select("car_id", "seq", "idx", F.round("match_dist_m", 6).alias("match_dist_m"),
                    F.round("s", 6).alias("track_s"))


@register("track_centreline", with_fixture("SELECT track_id, pos, round(x, 6) AS x, round(y, 6) AS y, samples FROM centre",
                                          TS.MATCHED_CTE, _CENTRE))
def q_track_centreline(spark, sf_dir):
    c = centre(spark, sf_dir)
    return c.select("track_id", "pos", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "samples")


@register(
    "track_project",
    with_fixture(
        f"""SELECT track_id, pos, round(lon, 9) AS lon, round(lat, 9) AS lat,
  round((lon - clon) * {TS.dbl(3.141592653589793 / 180.0 * TR.EARTH_RADIUS_M)} * cos(radians(clat)), 6) AS x,
  round((lat - clat) * {TS.dbl(3.141592653589793 / 180.0 * TR.EARTH_RADIUS_M)}, 6) AS y
FROM (SELECT *,
        sum(CAST(round(lon * CAST(1000000000 AS DOUBLE)) AS BIGINT)) OVER (PARTITION BY track_id)
          / count(*) OVER (PARTITION BY track_id) / CAST(1000000000 AS DOUBLE) AS clon,
        sum(CAST(round(lat * CAST(1000000000 AS DOUBLE)) AS BIGINT)) OVER (PARTITION BY track_id)
          / count(*) OVER (PARTITION BY track_id) / CAST(1000000000 AS DOUBLE) AS clat
FROM (SELECT track_id, pos,
        {TS.dbl(LON0)} + x / {TS.dbl(3.141592653589793 / 180.0 * TR.EARTH_RADIUS_M * __import__('math').cos(__import__('math').radians(LAT0)))} AS lon,
        {TS.dbl(LAT0)} + y / {TS.dbl(3.141592653589793 / 180.0 * TR.EARTH_RADIUS_M)} AS lat
      FROM centre) w) v""",
        TS.MATCHED_CTE, _CENTRE,
    ),
)
def q_track_project(spark, sf_dir):
    ll = TR.unproject_xy(centre(spark, sf_dir), LON0, LAT0).select("track_id", "pos", "lon", "lat")
    p = TR.project_lonlat(ll)
    return p.select("track_id", "pos", F.round("lon", 9).alias("lon"), F.round("lat", 9).alias("lat"),
                    F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@register(
    "track_resample",
    with_fixture("SELECT track_id, idx, round(x, 6) AS x, round(y, 6) AS y FROM resampled",
                 TS.MATCHED_CTE, _CENTRE, _RESAMPLED),
)
def q_track_resample(spark, sf_dir):
    r = TR.resample_closed(centre(spark, sf_dir), RESAMPLE_K)
    return r.select("track_id", "idx", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


SPLINE_POINTS = 1000


@register(
    "track_spline",
    with_fixture(
        f"""SELECT track_id, CAST(k AS INTEGER) AS idx, {TS.spline_at('x')} AS x, {TS.spline_at('y')} AS y
FROM (SELECT *, to_u - ha AS u, sum(ha) OVER (PARTITION BY track_id) / {SPLINE_POINTS - 1} AS step FROM solved) s,
  LATERAL (SELECT unnest(range(CAST(ceil(u / step) AS BIGINT),
    CASE WHEN i = n - 1 THEN {SPLINE_POINTS} ELSE CAST(ceil(to_u / step) AS BIGINT) END)) AS k) p""",
        TS.MATCHED_CTE, _CENTRE, *TS.spline_ctes("centre"),
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def q_track_spline(spark, sf_dir):
    """Closed cubic spline (C2) through the rebuilt centreline."""
    r = TR.spline_closed(centre(spark, sf_dir), SPLINE_POINTS)
    return r.select("track_id", "idx", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


_GEO_COLS_SQL = """SELECT track_id, idx, round(x, 6) AS x, round(y, 6) AS y, round(curvature, 9) AS curvature,
  round(seg_len, 6) AS seg_len, round(tan_x, 6) AS tan_x, round(tan_y, 6) AS tan_y, round(s, 6) AS s,
  round(total_length, 6) AS total_length, n_points, sector_name FROM geo_re"""


def _geo_cols(g):
    r = lambda c, n=6: F.round(c, n).alias(c)
    return g.select("track_id", "idx", r("x"), r("y"), r("curvature", 9), r("seg_len"), r("tan_x"), r("tan_y"),
                    r("s"), r("total_length"), "n_points", "sector_name")


EVEN_POINTS = 500


@register(
    "track_even",
    with_fixture(
        f"""SELECT track_id, CAST(k AS INT) AS idx, round(x + part * (x2 - x), 6) AS x, round(y + part * (y2 - y), 6) AS y,
  round(k * step, 6) AS s
FROM (SELECT *, least(greatest((k * step - (upto - len)) / len, 0), 1) AS part FROM (
  SELECT *, unnest(range(CAST(ceil((upto - len) / step) AS BIGINT),
      CASE WHEN is_last THEN {EVEN_POINTS} ELSE CAST(ceil(upto / step) AS BIGINT) END)) AS k FROM (
    SELECT *, sum(len) OVER (PARTITION BY track_id ORDER BY idx ROWS UNBOUNDED PRECEDING) AS upto,
      sum(len) OVER (PARTITION BY track_id) / CAST({EVEN_POINTS - 1} AS DOUBLE) AS step FROM (
      SELECT *, coalesce(sqrt((x2 - x) * (x2 - x) + (y2 - y) * (y2 - y)), 0) AS len FROM (
        SELECT track_id, idx, x, y, lead(x) OVER w AS x2, lead(y) OVER w AS y2, lead(idx, 2) OVER w IS NULL AS is_last
        FROM resampled WINDOW w AS (PARTITION BY track_id ORDER BY idx)) a) b) c
  WHERE x2 IS NOT NULL AND len > 0) d) e""",
        TS.MATCHED_CTE, _CENTRE, _RESAMPLED,
    ),
)
def q_track_even(spark, sf_dir):
    """The rebuilt track at equal distances."""
    e = TR.resample_even(TR.resample_closed(centre(spark, sf_dir), RESAMPLE_K), EVEN_POINTS)
    return e.select("track_id", "idx", *[F.round(c, 6).alias(c) for c in ("x", "y", "s")])


@register("track_geometry", with_fixture(_GEO_COLS_SQL, TS.MATCHED_CTE, _CENTRE, _RESAMPLED, _GEO_RE))
def q_track_geometry(spark, sf_dir):
    return _geo_cols(rebuilt_geometry(spark, sf_dir))


@register(
    "speed_profile",
    with_fixture(
        """SELECT track_id, idx, round(curvature, 9) AS curvature, round(v_max_ms, 6) AS v_max_ms,
  round(target_speed_ms, 6) AS target_speed_ms FROM prof_re""",
        TS.MATCHED_CTE, _CENTRE, _RESAMPLED, _GEO_RE, _PROF_RE,
    ),
)
def q_speed_profile(spark, sf_dir):
    p = TR.speed_profile(rebuilt_geometry(spark, sf_dir))
    return p.select("track_id", "idx", F.round("curvature", 9).alias("curvature"),
                    F.round("v_max_ms", 6).alias("v_max_ms"), F.round("target_speed_ms", 6).alias("target_speed_ms"))


@register(
    "laps_from_position",
    with_fixture(
        """SELECT car_id, seq, idx, sum(CAST(wrap AS BIGINT)) OVER w AS pos_lap,
  round(cum - coalesce(base, CAST(0 AS DOUBLE)), 6) AS pos_lap_time
FROM (SELECT *, last_value(CASE WHEN wrap THEN cum - dt END IGNORE NULLS) OVER w AS base
      FROM (SELECT *, sum(dt) OVER w AS cum
            FROM (SELECT *, CASE WHEN prev_us IS NULL THEN CAST(0 AS DOUBLE)
                    ELSE least((timestamp - prev_us) / CAST(1000000 AS DOUBLE), CAST(0.1 AS DOUBLE)) END AS dt,
                    coalesce(idx < prev_idx - n_points / 2, false) AS wrap
                  FROM (SELECT m.*, g.n_points,
                          lag(m.idx) OVER (PARTITION BY m.car_id ORDER BY m.seq) AS prev_idx,
                          lag(m.timestamp) OVER (PARTITION BY m.car_id ORDER BY m.seq) AS prev_us
                        FROM matched m JOIN (SELECT DISTINCT track_id, n_points FROM geo_fix) g
                        ON g.track_id = m.track_id) a) b
            WINDOW w AS (PARTITION BY car_id ORDER BY seq ROWS UNBOUNDED PRECEDING)) c
      WINDOW w AS (PARTITION BY car_id ORDER BY seq ROWS UNBOUNDED PRECEDING)) d
WINDOW w AS (PARTITION BY car_id ORDER BY seq ROWS UNBOUNDED PRECEDING)""",
        TS.MATCHED_CTE, _GEO_FIX,
    ),
)
def q_laps_from_position(spark, sf_dir):
    n = fixture_geometry(spark).select("track_id", "n_points").distinct()
    return M.laps_from_position(matched(spark, sf_dir), n)


@register(
    "drs_flag",
    with_fixture(
        """SELECT car_id, seq, idx, round(curvature, 9) AS curvature, drs AS drs_active,
  round(CAST(0.6125 AS DOUBLE) * v * v * CASE WHEN drs THEN CAST(0.7 AS DOUBLE) ELSE CAST(0.9 AS DOUBLE) END
        * CAST(1.6 AS DOUBLE), 6) AS drag_n,
  round(v * v * curvature / CAST(9.81 AS DOUBLE), 6) AS lateral_g
FROM (SELECT m.car_id, m.seq, m.idx, g.curvature, m.speed_kmh / CAST(3.6 AS DOUBLE) AS v,
        coalesce(m.lap_count > 0 AND g.curvature < CAST(0.0005 AS DOUBLE) AND m.speed_kmh > CAST(100 AS DOUBLE),
                 false) AS drs
      FROM matched m LEFT JOIN geo_fix g ON g.track_id = m.track_id AND g.idx = m.idx) t""",
        TS.MATCHED_CTE, _GEO_FIX,
    ),
)
def q_drs_flag(spark, sf_dir):
    return M.drs_channels(matched(spark, sf_dir), fixture_geometry(spark))


@register(
    "pace_state",
    with_fixture(
        """SELECT m.car_id, m.seq, m.idx, round(p.target_speed_ms * CAST(3.6 AS DOUBLE), 6) AS target_speed_kmh,
  CASE WHEN m.speed_kmh / CAST(3.6 AS DOUBLE) < p.target_speed_ms * CAST(0.98 AS DOUBLE) THEN 'accelerating'
       WHEN m.speed_kmh / CAST(3.6 AS DOUBLE) > p.target_speed_ms * CAST(1.02 AS DOUBLE) THEN 'braking'
       ELSE 'hold' END AS pace_state
FROM matched m LEFT JOIN prof_fix p ON p.track_id = m.track_id AND p.idx = m.idx""",
        TS.MATCHED_CTE, _GEO_FIX, _PROF_FIX,
    ),
)
def q_pace_state(spark, sf_dir):
    _, prof = M.fixture_profile(track_points(spark))
    return M.pace(matched(spark, sf_dir), prof)


@register("lap_trace", with_fixture("SELECT * FROM trace", TS.MATCHED_CTE, *TS.TRACE_CTES))
def q_lap_trace(spark, sf_dir):
    return M.lap_trace(M.matched_laps(telemetry(spark, sf_dir), track_points(spark)))


@register(
    "lap_trace_vs_ghost",
    with_fixture(
        """SELECT t.car_id, t.lap_count, t.idx, t.speed_kmh, p.ghost_lap, g.speed_kmh AS ghost_speed_kmh,
  t.speed_kmh - g.speed_kmh AS speed_delta
FROM trace t
JOIN (SELECT car_id, lap_count, lag(lap_count) OVER (PARTITION BY car_id ORDER BY lap_count) AS ghost_lap
      FROM (SELECT DISTINCT car_id, lap_count FROM trace) l) p ON p.car_id = t.car_id AND p.lap_count = t.lap_count
LEFT JOIN trace g ON g.car_id = t.car_id AND g.lap_count = p.ghost_lap AND g.idx = t.idx""",
        TS.MATCHED_CTE, *TS.TRACE_CTES,
    ),
)
def q_lap_trace_vs_ghost(spark, sf_dir):
    return M.lap_trace_vs_ghost(M.matched_laps(telemetry(spark, sf_dir), track_points(spark)))


# ------------------------------------------------------------------------ streaming

from pitwall.session import scratch_path  # noqa: E402
from pitwall.sources.fixtures import read_table  # noqa: E402
from pitwall.streaming import jobs as S  # noqa: E402
from pitwall.streaming import sinks as K  # noqa: E402

STREAM_SPLIT_FILES = 5
LAP_GAP = "6 days"  # longer than any pause inside one fixture lap (a lap is six days)
WINDOW = "1 day"

_CLOSED = "(floor(epoch_us(max(ts)) / 1000) - 10000) * 1000"


def _split_events(spark, sf_dir, n):
    """Event files for a multi-batch replay: the table split into ``n`` time ranges."""
    path = scratch_path(spark, "events-split")
    read_table(spark, sf_dir, "events").repartitionByRange(n, "ts").write.parquet(path)
    return path


@register(
    "stream_decode",
    with_fixture(f"SELECT car_id, track_id, seq, epoch_us(event_time) AS event_us, {_WIRE_SQL} FROM telemetry"),
)
def q_stream_decode(spark, sf_dir):
    out = scratch_path(spark, "stream-decode")
    pk = encode_packets(S.telemetry_stream(spark, sf_dir), "ns")
    K.run_available_now(C.valid_packets(pk, "ns"), f"{out}/_ckpt", path=f"{out}/data")
    d = spark.read.parquet(f"{out}/data")
    return d.select("car_id", "track_id", "seq", F.unix_micros("event_time").alias("event_us"), *WIRE_KEYS)


@register("stream_lap_summary", with_fixture("SELECT * FROM lap_summary", LAP_SUMMARY_CTE))
def q_stream_lap_summary(spark, sf_dir):
    """T3 + T9: update mode over several micro-batches, results read back from the
    JSON result records (S3) and reduced to the latest version of each lap (A21)."""
    src = _split_events(spark, sf_dir, STREAM_SPLIT_FILES)
    out = scratch_path(spark, "stream-laps")
    laps = S.lap_summary_stream(S.telemetry_stream(spark, src, glob="*.parquet", max_files=1))
    K.run_available_now(laps, f"{out}/_ckpt", mode="update",
                        foreach_batch=K.lap_result_writer(f"{out}/rows", f"{out}/json"))
    records = spark.read.parquet(f"{out}/json")
    rows = C.decode_lap_json(records).withColumn("lap_count", F.col("lap_count"))
    return K.latest_version(rows, ["car_id", "lap_count"])


_FINAL_SQL = with_fixture(
    f"""SELECT l.*, s.session_start_us, s.session_end_us
FROM lap_summary l JOIN (
  SELECT car_id, lap_count, min(timestamp) AS session_start_us,
    max(timestamp) + CAST(6 AS BIGINT) * 86400000000 AS session_end_us
  FROM telemetry WHERE lap_count IS NOT NULL GROUP BY car_id, lap_count) s
USING (car_id, lap_count)
WHERE s.session_end_us <= (SELECT {_CLOSED} FROM events)""",
    LAP_SUMMARY_CTE,
)


@register("stream_lap_final", _FINAL_SQL)
def q_stream_lap_final(spark, sf_dir):
    """T4: laps finalised once in append mode; state evicted behind the watermark."""
    out = scratch_path(spark, "stream-final")
    laps = S.lap_final_stream(S.telemetry_stream(spark, sf_dir), LAP_GAP)
    K.run_available_now(laps, f"{out}/_ckpt", path=f"{out}/data")
    d = spark.read.parquet(f"{out}/data")
    return d.select(
        *[c for c in d.columns if c != "session"],
        F.unix_micros("session.start").alias("session_start_us"),
        F.unix_micros("session.end").alias("session_end_us"),
    )


def _window_sql(where: str = "") -> str:
    return with_fixture(
        f"""SELECT car_id, w * 86400000000 AS window_start_us, (w + 1) * 86400000000 AS window_end_us,
  count(*) AS samples, round(avg(speed_kmh), 6) AS avg_speed_kmh, max(speed_kmh) AS max_speed_kmh
FROM (SELECT *, CAST(floor(timestamp / CAST(86400000000 AS DOUBLE)) AS BIGINT) AS w FROM telemetry {where}) t
GROUP BY car_id, w
HAVING (w + 1) * 86400000000 <= (SELECT {_CLOSED} FROM events)"""
    )


@register("stream_window_agg", _window_sql())
def q_stream_window_agg(spark, sf_dir):
    out = scratch_path(spark, "stream-window")
    K.run_available_now(S.window_agg_stream(S.telemetry_stream(spark, sf_dir), WINDOW), f"{out}/_ckpt",
                        path=f"{out}/data")
    return spark.read.parquet(f"{out}/data")


@register("stream_late_data", _window_sql("WHERE lap_count <> (SELECT max(lap_count) - 1 FROM telemetry)"))
def q_stream_late_data(spark, sf_dir):
    """T5 + T7: laps delivered out of order, one restart of the query (from its
    checkpoint) per delivery; rows older than the watermark are dropped.  The last lap
    but one arrives after the last one has moved the watermark past it."""
    base = scratch_path(spark, "stream-late")
    src, out = f"{base}/src", f"{base}/out"
    ev = read_table(spark, sf_dir, "events")
    lap = F.floor((F.dayofmonth("ts") - 1) / 6).cast("int")
    last = ev.agg(F.max(lap)).first()[0] or 0
    for i, due in enumerate((lap < last - 1, lap == last, lap == last - 1)):
        ev.filter(due).write.parquet(f"{src}/delivery={i:02d}")
        stream = S.window_agg_stream(
            telemetry_from_events_stream(spark, f"{src}/*"), WINDOW
        )
        K.run_available_now(stream, f"{out}/_ckpt", path=f"{out}/data")
    return spark.read.parquet(f"{out}/data")


def telemetry_from_events_stream(spark, path):
    return S.telemetry_from_events(S.events_stream(spark, path, glob=None), track_points(spark))


@register(
    "stream_dedup",
    with_fixture("SELECT car_id, seq, timestamp AS event_us, speed_kmh FROM telemetry"),
)
def q_stream_dedup(spark, sf_dir):
    """Every packet delivered twice, the second time in a later micro-batch;
    duplicates (same car and time) are dropped by the state or as older than the watermark."""
    base = scratch_path(spark, "stream-dedup")
    ev = read_table(spark, sf_dir, "events")
    for copy in ("a", "b"):
        ev.write.parquet(f"{base}/src/{copy}")
        d = S.dedup_stream(telemetry_from_events_stream(spark, f"{base}/src/*"))
        d = d.select("car_id", "seq", F.unix_micros("event_time").alias("event_us"), "speed_kmh")
        K.run_available_now(d, f"{base}/_ckpt", path=f"{base}/data")
    return spark.read.parquet(f"{base}/data")


@register("stream_lap_history", SQL["lap_history"])
def q_stream_lap_history(spark, sf_dir):
    """Stateful lap boundary / history / PB per car (applyInPandasWithState)."""
    out = scratch_path(spark, "stream-history")
    K.run_available_now(S.lap_history_stream(S.telemetry_stream(spark, sf_dir)), f"{out}/_ckpt",
                        path=f"{out}/data")
    return spark.read.parquet(f"{out}/data")


@register(
    "stream_archive",
    with_fixture(
        """SELECT car_id, track_id, timestamp * 1000 AS time, speed_kmh, CAST(trunc(rpm) AS INTEGER) AS rpm,
  gear, throttle, brake, g_lat, g_long FROM telemetry"""
    ),
)
def q_stream_archive(spark, sf_dir):
    """K3 + S2/S6: packets replayed into the archive, partitioned by track and car."""
    from pitwall.sources.tracks import read_archive

    out = scratch_path(spark, "stream-archive")
    pk = encode_packets(S.telemetry_stream(spark, sf_dir), "ns")
    K.run_available_now(C.archive_points(pk), f"{out}/_ckpt", foreach_batch=K.archive_writer(f"{out}/data"))
    a = read_archive(spark, f"{out}/data")
    return a.select(F.col("car_id").cast("long").alias("car_id"), "track_id", "time", "speed_kmh", "rpm", "gear",
                    "throttle", "brake", "g_lat", "g_long")


@register(
    "stream_window_sliding",
    with_fixture(
        f"""SELECT car_id, w * 86400000000 AS window_start_us, (w + 2) * 86400000000 AS window_end_us,
  count(*) AS samples, round(avg(speed_kmh), 6) AS avg_speed_kmh, max(speed_kmh) AS max_speed_kmh
FROM (SELECT *, CAST(floor(timestamp / CAST(86400000000 AS DOUBLE)) AS BIGINT) AS w FROM telemetry
      UNION ALL
      SELECT *, CAST(floor(timestamp / CAST(86400000000 AS DOUBLE)) AS BIGINT) - 1 AS w FROM telemetry) t
GROUP BY car_id, w
HAVING (w + 2) * 86400000000 <= (SELECT {_CLOSED} FROM events)"""
    ),
)
def q_stream_window_sliding(spark, sf_dir):
    """T2 sliding: two-day windows every day per car, append mode."""
    out = scratch_path(spark, "stream-sliding")
    s = S.window_agg_stream(S.telemetry_stream(spark, sf_dir), "2 days", "1 day")
    K.run_available_now(s, f"{out}/_ckpt", path=f"{out}/data")
    return spark.read.parquet(f"{out}/data")


from pitwall.plans import stateful  # noqa: E402, F401 - registers its queries


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
