"""Lap aggregates, lap boundaries, history/personal bests and session views.

All group keys start with ``car_id``; aggregates are mergeable (partial + final
hash aggregate), so a hot car is combined map-side before the shuffle.  Ordered
operators go through ``ordered_scan`` (chunked, skew-safe) instead of a window
partitioned by car alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.functions.formatting import fixed, fixed_or_dash
from pitwall.functions.ordered import SCAN_CHUNK, Scan, ordered_scan
from pitwall.schema import LAP_SUMMARY_COLUMNS

# Order of samples inside a car: the packet sequence (arrival order).
ORDER = ["seq"]
HIGH_THROTTLE = 0.5
BRAKE_ON = 0.1
LOW_FUEL_KG = 10.0
ROUND = 6


# What is gathered of each channel over a lap's samples; ``first`` and ``last`` go by ``ORDER``.
GATHERED = {
    "speed_kmh": ("mean", "least", "most"),
    "throttle": ("mean",),
    "brake": ("mean",),
    "g_lat": ("most",),
    "g_long": ("least", "most"),
    "fuel_kg": ("first", "last"),
    "tire_wear_pct": ("first", "most"),
    "lap_time": ("most",),
    "last_lap_time": ("last",),
    "timestamp": ("first", "last"),
    "event_time": ("least", "most"),
}


def lap_aggregates(order: Column | None = None) -> list[Column]:
    """A1-A18 as mergeable aggregates ``<statistic>_<channel>``, for batch and streams alike.

    The order is one long, the packet sequence: the aggregate stays a hash aggregate (a struct
    would force a sort), and the result does not depend on a shuffle.
    """
    by = F.col(ORDER[0]) if order is None else order
    make = {"mean": F.avg, "least": F.min, "most": F.max, "first": lambda c: F.min_by(c, by), "last": lambda c: F.max_by(c, by)}
    gathered = [make[kind](channel).alias(f"{kind}_{channel}") for channel, kinds in GATHERED.items() for kind in kinds]
    full = F.sum((F.col("throttle") > HIGH_THROTTLE).cast("int"))
    return [F.count(F.lit(1)).alias("samples"), full.alias("full_throttle"), *gathered]


def finish_lap_row(agg: DataFrame, keys: list[str], digits: int = ROUND) -> DataFrame:
    """The fixed lap row (after the key columns) from what was gathered."""
    g, rounded = F.col, lambda c: F.round(c, digits)
    burnt = g("first_fuel_kg") - g("last_fuel_kg")
    span_us = F.unix_micros("most_event_time") - F.unix_micros("least_event_time")
    row = {
        **{f"avg_{c}": rounded(g(f"mean_{c}")) for c in ("speed_kmh", "throttle", "brake")},
        **{f"{side}_{c}": g(f"{kind}_{c}") for c in ("speed_kmh", "g_lat", "g_long")
           for side, kind in (("max", "most"), ("min", "least")) if kind in GATHERED[c]},
        **{f"lap_{end}_timestamp": g(f"{kind}_timestamp") for end, kind in (("start", "first"), ("end", "last"))},
        **{f"fuel_{end}_kg": g(f"{kind}_fuel_kg") for end, kind in (("start", "first"), ("end", "last"))},
        "fuel_used_kg": burnt,
        "fuel_per_lap": burnt,
        "throttle_pct": g("full_throttle") / g("samples") * 100,
        "aggression_index": rounded(g("mean_throttle") * 50 + g("mean_brake") * 50),
        "tire_wear_pct": g("most_tire_wear_pct"),
        "tire_deg_rate": g("most_tire_wear_pct") - g("first_tire_wear_pct"),
        "lap_time_s": g("most_lap_time"),
        "last_lap_time_s": g("last_last_lap_time"),
        # from event time, in real milliseconds whatever the packets' unit
        "lap_duration_ms": span_us / F.lit(1000.0),
        "sample_count": g("samples"),
        "lap_count": g("lap_count"),
    }
    return agg.select(*[k for k in keys if k != "lap_count"], *[row[c].alias(c) for c in LAP_SUMMARY_COLUMNS])


def lap_summary(tel: DataFrame, keys: tuple[str, ...] = ("car_id",), digits: int = ROUND) -> DataFrame:
    """A1-A18 + X1-X6 per (car, lap).  Rows without a lap number are not a lap."""
    gk = [*keys, "lap_count"]
    agg = tel.filter(F.col("lap_count").isNotNull()).groupBy(*gk).agg(*lap_aggregates())
    return finish_lap_row(agg, gk, digits)


def lap_quality(tel: DataFrame, brake_on: float = BRAKE_ON, chunk_width: int = SCAN_CHUNK) -> DataFrame:
    """A19 consistency (sample std-dev of speed) and A20 braking zones (rising edges)."""
    d = ordered_scan(
        tel.filter(F.col("lap_count").isNotNull()).select("car_id", "lap_count", "seq", "speed_kmh", "brake"),
        ["car_id", "lap_count"],
        ORDER,
        [Scan("_prev_brake", "lag", F.col("brake"))],
        chunk_by="seq",
        chunk_width=chunk_width,
    )
    edge = (F.col("brake") > brake_on) & ~F.coalesce(F.col("_prev_brake") > brake_on, F.lit(False))
    return d.groupBy("car_id", "lap_count").agg(
        F.round(F.stddev_samp("speed_kmh"), ROUND).alias("consistency_score"),
        F.sum(F.coalesce(edge, F.lit(False)).cast("long")).alias("braking_zones_count"),
        F.count(F.lit(1)).alias("sample_count"),
    )


def _valid_time(t: Column) -> Column:
    return (t > 0) & (t < F.lit(float("inf")))


def session_summary(laps: DataFrame) -> DataFrame:
    """A23-A26 per car over lap rows; out-laps (lap <= 0) are excluded."""
    t = F.col("last_lap_time_s")
    best = F.min(F.when(_valid_time(t), F.struct(t.alias("t"), F.col("lap_count").alias("lap"))))
    return (
        laps.filter(F.col("lap_count") > 0)
        .groupBy("car_id")
        .agg(
            F.count(F.lit(1)).alias("total_laps"),
            F.max("lap_count").alias("last_lap"),
            best.alias("_best"),
            F.round(F.avg(F.when(_valid_time(t), t)), ROUND).alias("avg_lap_time_s"),
        )
        .select(
            "car_id",
            "total_laps",
            "last_lap",
            F.col("_best.lap").alias("best_lap"),
            F.col("_best.t").alias("best_lap_time_s"),
            "avg_lap_time_s",
        )
    )


def lap_table(laps: DataFrame, ordered: bool = True) -> DataFrame:
    """The formatted lap table, newest lap first, best lap flagged."""
    rows = laps.filter(F.col("lap_count") > 0)
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))  # missing shows as 0
    t = F.col("last_lap_time_s")
    # over a car's lap rows, which are few beside its samples: the laps are aggregated once
    best = F.min(F.when(_valid_time(t), F.struct(t.alias("t"), F.col("lap_count").alias("lap")))).over(
        Window.partitionBy("car_id"))
    out = rows.withColumn("best_lap", best["lap"]).select(
        "car_id",
        "lap_count",
        fixed(z("avg_speed_kmh"), 1).alias("avg_speed_text"),
        fixed(z("max_speed_kmh"), 1).alias("max_speed_text"),
        fixed(z("fuel_used_kg"), 2).alias("fuel_used_text"),
        fixed(z("throttle_pct"), 1, "%").alias("throttle_text"),
        fixed_or_dash(z("last_lap_time_s"), 3).alias("lap_time_text"),
        F.coalesce(F.col("sample_count"), F.lit(0)).cast("string").alias("samples_text"),
        fixed(z("fuel_per_lap"), 2).alias("fuel_per_lap_text"),
        fixed(z("tire_deg_rate"), 2).alias("tire_deg_text"),
        fixed(z("aggression_index"), 1).alias("aggression_text"),
        F.coalesce(F.col("best_lap") == F.col("lap_count"), F.lit(False)).alias("is_best_lap"),
        F.format_string(
            "Lap %d: Avg Speed=%.1f km/h, Fuel Used=%.2f kg, Samples=%d",
            F.col("lap_count"),
            F.round(z("avg_speed_kmh"), 1),
            F.round(z("fuel_used_kg"), 2),
            F.col("sample_count"),
        ).alias("summary_line"),
    )
    return out.orderBy("car_id", F.desc("lap_count")) if ordered else out


def last_n_laps(laps: DataFrame, n: int = 5) -> DataFrame:
    """O2: the newest ``n`` laps per car (a top-k report).

    ``row_number() <= n`` lets Catalyst insert a partial WindowGroupLimit before the
    shuffle, so each map task forwards at most ``n`` rows per car.
    """
    w = Window.partitionBy("car_id").orderBy(F.desc("lap_count"))
    return laps.withColumn("recency", F.row_number().over(w)).filter(F.col("recency") <= n)


def latest_per_key(rows: DataFrame, keys: list[str], version: str | Column) -> DataFrame:
    """Later write wins; one ``max_by(column, version)`` per column (mergeable,
    hash-aggregated for numeric columns)."""
    v = F.col(version) if isinstance(version, str) else version
    value_cols = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*[F.max_by(c, v).alias(c) for c in value_cols])


def lap_boundaries(tel: DataFrame, chunk_width: int = SCAN_CHUNK) -> DataFrame:
    """H1: effective lap = running max of the lap number in arrival order.

    A packet starts a lap only when its lap number exceeds every earlier one; older
    lap numbers count as the current lap.  A missing lap number reads as 0.
    """
    lap = F.coalesce(F.col("lap_count"), F.lit(0))
    d = ordered_scan(
        tel,
        ["car_id"],
        ORDER,
        [Scan("_lap_before", "max_before", lap)],
        chunk_by="seq",
        chunk_width=chunk_width,
    )
    start = F.col("_lap_before").isNull() | (lap > F.col("_lap_before"))
    return (
        d.withColumn("effective_lap", F.greatest(lap, F.col("_lap_before")))
        .withColumn("is_lap_start", start)
        .withColumnRenamed("_lap_before", "previous_lap")
    )


def lap_history(tel: DataFrame, chunk_width: int = SCAN_CHUNK) -> DataFrame:
    """H2/H3: at the first packet of each new lap, the finished lap's time and PB flag."""
    b = lap_boundaries(
        tel.select("car_id", "seq", "lap_count", "last_lap_time"), chunk_width
    )
    t = F.coalesce(F.col("last_lap_time"), F.lit(0.0))
    hist = b.filter(F.col("is_lap_start") & F.col("previous_lap").isNotNull() & (t > 0)).select(
        "car_id", "seq", F.col("previous_lap").cast("int").alias("lap"), t.alias("lap_time")
    )
    h = ordered_scan(
        hist, ["car_id"], ORDER, [Scan("_best_before", "min_before", F.col("lap_time"))],
        chunk_by="seq", chunk_width=chunk_width,
    )
    pb = F.col("_best_before").isNull() | (F.col("lap_time") < F.col("_best_before"))
    return h.select("car_id", "lap", "lap_time", F.when(pb, "PB").otherwise("OK").alias("status"))


def live_state(tel: DataFrame, low_fuel_kg: float = LOW_FUEL_KG) -> DataFrame:
    """A22 + F5: latest packet per car rendered as text (missing values show 0/'N')."""
    cols = ["speed_kmh", "gear", "rpm", "lap_time", "fuel_kg", "tire_wear_pct", "x", "y"]
    s = tel.groupBy("car_id").agg(F.max("seq").alias("seq"), *[F.max_by(c, "seq").alias(c) for c in cols])
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return s.select(
        "car_id",
        "seq",
        z("speed_kmh").cast("long").cast("string").alias("speed_text"),
        F.coalesce(F.col("gear").cast("string"), F.lit("N")).alias("gear_text"),
        z("rpm").cast("long").cast("string").alias("rpm_text"),
        fixed(z("lap_time"), 3).alias("lap_time_text"),
        fixed(z("fuel_kg"), 1, " KG").alias("fuel_text"),
        (z("fuel_kg") < low_fuel_kg).alias("low_fuel"),
        fixed(z("tire_wear_pct"), 1, "%").alias("wear_text"),
        z("x").alias("x"),
        z("y").alias("y"),
    )


def fuel_alerts(tel: DataFrame, low_fuel_kg: float = LOW_FUEL_KG) -> DataFrame:
    """packets below the low-fuel line (streaming-safe filter)."""
    return tel.filter(F.col("fuel_kg") < low_fuel_kg).select("car_id", "seq", "timestamp", "fuel_kg")


def sector_times(tel: DataFrame, sectors: tuple[str, ...] = ("Sector 1", "Sector 2", "Sector 3")) -> DataFrame:
    """Time spent per sector and lap, one aggregation with conditional columns.

    Equivalent to ``groupBy(car, lap).pivot(sector, sectors)`` without the second
    aggregation a pivot plans.
    """
    us = F.unix_micros("event_time")
    aggs = []
    for i, s in enumerate(sectors, start=1):
        hit = F.col("sector_name") == s
        aggs.append(
            ((F.max(F.when(hit, us)) - F.min(F.when(hit, us))) / F.lit(1e6)).alias(f"sector_{i}_s")
        )
        aggs.append(F.count(F.when(hit, 1)).alias(f"sector_{i}_samples"))
    return tel.filter(F.col("lap_count").isNotNull()).groupBy("car_id", "lap_count").agg(*aggs)
