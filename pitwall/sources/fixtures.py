"""Telemetry and track views over the driver's tables.

``events`` becomes a telemetry stream: one user is one car, six days are one lap and
the car drives an ellipse of ``n_points`` track points.  The mapping is fixed by
FIXTURES.md; ``plans/oracle.py`` holds the same mapping as DuckDB SQL.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.functions.channels import gear_band, sector_name

TRACK_ID = "ellipse"
TRACK_POINTS = 2000
SECONDS_PER_LAP = 518400  # six days
# Ellipse semi-axes in metres.
ELLIPSE_A, ELLIPSE_B = 1000.0, 400.0


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table (read-only)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ellipse_xy(idx, n_points: int = TRACK_POINTS):
    """Track point ``idx`` of the ellipse as (x, y) Columns, rounded to 6 decimals."""
    i = F.col(idx) if isinstance(idx, str) else idx
    ang = F.lit(2.0) * F.lit(math.pi) * i / F.lit(float(n_points))
    return F.round(F.lit(ELLIPSE_A) * F.cos(ang), 6), F.round(F.lit(ELLIPSE_B) * F.sin(ang), 6)


def track_points(spark: SparkSession, n_points: int = TRACK_POINTS) -> DataFrame:
    """The reference track: ``track_id, idx, x, y`` on an ellipse (bounded: n_points rows)."""
    x, y = ellipse_xy("id", n_points)
    return spark.range(n_points).select(
        F.lit(TRACK_ID).alias("track_id"), F.col("id").cast("int").alias("idx"), x.alias("x"), y.alias("y")
    )


def event_micros(ts: str = "ts"):
    """Epoch microseconds of a TIMESTAMP_NTZ column from its fields (no session zone involved)."""
    c = F.col(ts)
    day_us = F.unix_date(F.to_date(c)).cast("long") * F.lit(86_400_000_000)
    hm_us = (F.hour(c) * 3600 + F.minute(c) * 60).cast("long") * F.lit(1_000_000)
    sec_us = (F.expr(f"extract(SECOND FROM {ts})") * 1_000_000).cast("long")
    return day_us + hm_us + sec_us


def telemetry_from_events(events: DataFrame, track: DataFrame | None = None, n_points: int = TRACK_POINTS
                          ) -> DataFrame:
    """Works on a batch or a streaming ``events`` DataFrame (``track`` is accepted for
    symmetry with other track tables; the ellipse's points are computed in place)."""
    dom = F.dayofmonth("ts")
    e = events.select(
        "event_id",
        "user_id",
        "value",
        event_micros("ts").alias("timestamp"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.floor((dom - 1) / 6).cast("int").alias("lap_count"),
        (((dom - 1) % 6) * 86400 + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.floor(F.second("ts")))
        .cast("double")
        .alias("lap_time"),
    ).withColumn(
        "true_idx", F.floor(F.col("lap_time") * F.lit(n_points) / F.lit(SECONDS_PER_LAP)).cast("int")
    )
    # A track point is a function of its index, so the equi-join with the track
    # table is evaluated in place: same rows (indices outside the track drop out,
    # as in an inner join), no broadcast job per query.
    px, py = ellipse_xy("true_idx", n_points)
    j = e.filter((F.col("true_idx") >= 0) & (F.col("true_idx") < n_points)).withColumns({"px": px, "py": py})
    eid, k, v, lap = F.col("event_id"), F.col("k"), F.col("value"), F.col("lap_count")
    dbl = lambda n: F.lit(float(n))
    return j.select(
        F.col("user_id").alias("car_id"),
        F.lit(TRACK_ID).alias("track_id"),
        eid.alias("seq"),
        F.timestamp_micros("timestamp").alias("event_time"),
        "timestamp",
        (lap * dbl(SECONDS_PER_LAP) + F.col("lap_time")).alias("time"),
        "lap_count",
        "lap_time",
        F.when(lap == 0, dbl(0))
        .otherwise(dbl(80) + ((F.col("user_id") * 7 + lap * 13) % 50) / dbl(10))
        .alias("last_lap_time"),
        v.alias("speed_kmh"),
        (F.col("px") + (((eid * 13) % 21) - 10) / dbl(100)).alias("x"),
        (F.col("py") + (((eid * 17) % 21) - 10) / dbl(100)).alias("y"),
        sector_name(F.col("true_idx"), n_points).alias("sector_name"),
        (k / dbl(100)).alias("throttle"),
        F.when(k < 20, (20 - k) / dbl(20)).otherwise(dbl(0)).alias("brake"),
        gear_band(v).alias("gear"),
        (10000 + (eid * 31) % 2500).cast("double").alias("rpm"),
        ((((eid * 37) % 601) - 300) / dbl(100)).alias("g_lat"),
        ((((eid * 53) % 901) - 500) / dbl(100)).alias("g_long"),
        (dbl(110) - eid / dbl(1000)).alias("fuel_kg"),
        (eid / dbl(2000)).alias("tire_wear_pct"),
    )


def telemetry(spark: SparkSession, sf_dir: str, n_points: int = TRACK_POINTS) -> DataFrame:
    """The telemetry view of a driver table directory."""
    return telemetry_from_events(read_table(spark, sf_dir, "events"), track_points(spark, n_points), n_points)
