"""Wire schema of a telemetry packet and fixed output column orders."""

from __future__ import annotations

from pyspark.sql import types as T

# The 17 packet keys of the wire format, in wire order.
WIRE_FIELDS = [
    ("timestamp", T.LongType()),
    ("time", T.DoubleType()),
    ("lap_count", T.IntegerType()),
    ("lap_time", T.DoubleType()),
    ("last_lap_time", T.DoubleType()),
    ("speed_kmh", T.DoubleType()),
    ("x", T.DoubleType()),
    ("y", T.DoubleType()),
    ("sector_name", T.StringType()),
    ("throttle", T.DoubleType()),
    ("brake", T.DoubleType()),
    ("gear", T.IntegerType()),
    # rpm is sent as a float; declaring it integer would silently null it
    ("rpm", T.DoubleType()),
    ("g_lat", T.DoubleType()),
    ("g_long", T.DoubleType()),
    ("fuel_kg", T.DoubleType()),
    ("tire_wear_pct", T.DoubleType()),
]

WIRE_KEYS = [name for name, _ in WIRE_FIELDS]

PACKET_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in WIRE_FIELDS])

# Columns every telemetry table carries besides the wire keys.
KEY_COLUMNS = ["car_id", "track_id", "seq", "event_time"]

TELEMETRY_COLUMNS = KEY_COLUMNS + WIRE_KEYS

# The lap row, in the order the lap result stream publishes it.
LAP_SUMMARY_COLUMNS = [
    "lap_count",
    "avg_speed_kmh",
    "max_speed_kmh",
    "min_speed_kmh",
    "avg_throttle",
    "avg_brake",
    "throttle_pct",
    "max_g_lat",
    "max_g_long",
    "min_g_long",
    "fuel_start_kg",
    "fuel_end_kg",
    "fuel_used_kg",
    "fuel_per_lap",
    "tire_wear_pct",
    "tire_deg_rate",
    "aggression_index",
    "lap_time_s",
    "last_lap_time_s",
    "sample_count",
    "lap_start_timestamp",
    "lap_end_timestamp",
    "lap_duration_ms",
]

LAP_RESULT_SCHEMA = T.StructType(
    [T.StructField("car_id", T.LongType(), True)]
    + [
        T.StructField(
            c,
            T.IntegerType()
            if c == "lap_count"
            else T.LongType()
            if c in ("sample_count", "lap_start_timestamp", "lap_end_timestamp")
            else T.DoubleType(),
            True,
        )
        for c in LAP_SUMMARY_COLUMNS
    ]
)

# Archive point fields and their defaults when the key is missing.
ARCHIVE_FIELDS = [
    ("speed_kmh", "double", 0.0),
    ("rpm", "int", 0),
    ("gear", "int", 0),
    ("throttle", "double", 0.0),
    ("brake", "double", 0.0),
    ("g_lat", "double", 0.0),
    ("g_long", "double", 0.0),
]
