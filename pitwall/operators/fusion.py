"""Per-sample ordered channels and multi-rate sensor fusion.

All ordered work runs through ``ordered_scan`` chunked on the packet sequence,
so a car's history is split over many tasks; stages share one partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.functions import channels as ch
from pitwall.functions.ordered import SCAN_CHUNK, Scan, ordered_scan

ORDER = ["seq"]
MAX_DT_S = 0.1
ROUND = 6
# Chunk width for event-time chunking: ten minutes in microseconds.
TIME_CHUNK_US = 600 * 1_000_000


def _us():
    return F.unix_micros("event_time")


def with_dt(tel: DataFrame, max_dt: float = MAX_DT_S, chunk_width: int = SCAN_CHUNK, extra=None) -> DataFrame:
    """H6: ``dt = min(t - t_prev, max_dt)`` per car, 0 on a car's first sample.

    ``extra`` stages run after dt on the same chunking (e.g. running sums of dt).
    """
    d = tel.withColumn("_us", _us()).drop("event_time")
    stages = [[Scan("_prev_us", "lag", F.col("_us"))]]
    if extra:
        # the dt expression is inlined so later stages need no extra column pass
        stages += extra
    out = ordered_scan(d, ["car_id"], ORDER, stages, chunk_by="seq", chunk_width=chunk_width)
    return out


def dt_expr(max_dt: float = MAX_DT_S):
    gap = (F.col("_us") - F.col("_prev_us")) / F.lit(1e6)
    return F.when(F.col("_prev_us").isNull(), F.lit(0.0)).otherwise(F.least(gap, F.lit(max_dt)))


def sample_dt(tel: DataFrame, max_dt: float = MAX_DT_S, chunk_width: int = SCAN_CHUNK) -> DataFrame:
    d = with_dt(tel.select("car_id", "seq", "event_time"), max_dt, chunk_width)
    return d.select("car_id", "seq", F.round(dt_expr(max_dt), ROUND).alias("dt_s"))


def cumulative_distance(tel: DataFrame, max_dt: float = MAX_DT_S, chunk_width: int = SCAN_CHUNK) -> DataFrame:
    """H9: distance = running sum of speed * dt (metres)."""
    step = ch.kmh_to_ms("speed_kmh") * dt_expr(max_dt)
    d = with_dt(
        tel.select("car_id", "seq", "event_time", "speed_kmh"), max_dt, chunk_width,
        extra=[[Scan("distance_m", "sum", step)]],
    )
    return d.select("car_id", "seq", F.round(dt_expr(max_dt), ROUND).alias("dt_s"),
                    F.round("distance_m", ROUND).alias("distance_m"))


def tire_wear(tel: DataFrame, max_dt: float = MAX_DT_S, chunk_width: int = SCAN_CHUNK) -> DataFrame:
    """C2 over H9: grip decays with distance, wear in percent."""
    step = ch.kmh_to_ms("speed_kmh") * dt_expr(max_dt)
    d = with_dt(
        tel.select("car_id", "seq", "event_time", "speed_kmh"), max_dt, chunk_width,
        extra=[[Scan("_dist", "sum", step)]],
    )
    g = ch.grip(F.col("_dist"))
    return d.select(
        "car_id",
        "seq",
        F.round("_dist", ROUND).alias("distance_m"),
        F.round(g, ROUND).alias("grip"),
        F.round(ch.wear_pct(g), ROUND).alias("wear_pct"),
    )


def fuel_estimate(tel: DataFrame, fuel0: float = ch.FUEL_START_KG, max_dt: float = MAX_DT_S,
                  chunk_width: int = SCAN_CHUNK) -> DataFrame:
    """``max(0, fuel0 - sum(0.002 * throttle * dt * (v/100 + 1)))``; burn >= 0 so the
    clamp of the total equals clamping every step."""
    burn = ch.fuel_burn("throttle", dt_expr(max_dt), ch.kmh_to_ms("speed_kmh"))
    d = with_dt(
        tel.select("car_id", "seq", "event_time", "speed_kmh", "throttle"), max_dt, chunk_width,
        extra=[[Scan("_burn", "sum", burn)]],
    )
    est = F.greatest(F.lit(0.0), F.lit(fuel0) - F.coalesce(F.col("_burn"), F.lit(0.0)))
    return d.select("car_id", "seq", F.round(est, ROUND).alias("fuel_est_kg"))


def derived_channels(tel: DataFrame, chunk_width: int = SCAN_CHUNK) -> DataFrame:
    """D10, D11, C1, C4 (DRS closed), H14: per-sample physics channels."""
    d = tel.select("car_id", "seq", "speed_kmh", "fuel_kg", _us().alias("_us"))
    d = ordered_scan(
        d, ["car_id"], ORDER,
        [Scan("_prev_us", "lag", F.col("_us")), Scan("_prev_v", "lag", F.col("speed_kmh"))],
        chunk_by="seq", chunk_width=chunk_width,
    )
    v = ch.kmh_to_ms(ch.clamp_min("speed_kmh"))
    dt = (F.col("_us") - F.col("_prev_us")) / F.lit(1e6)
    accel = F.when(dt > 0, (v - ch.kmh_to_ms(ch.clamp_min("_prev_v"))) / dt / F.lit(ch.G))
    r = lambda c: F.round(c, ROUND)
    return d.select(
        "car_id",
        "seq",
        r(ch.clamp_min("speed_kmh")).alias("speed_kmh_clamped"),
        r(v).alias("speed_ms"),
        r(ch.total_mass("fuel_kg")).alias("total_mass_kg"),
        r(ch.aero_force(v, F.lit(ch.CL))).alias("downforce_n"),
        r(ch.aero_force(v, F.lit(ch.CD_BASE))).alias("drag_n"),
        r(accel).alias("accel_long_g"),
    )


def gear_check(tel: DataFrame) -> DataFrame:
    """Gear implied by speed next to the reported gear."""
    band = ch.gear_band("speed_kmh")
    return tel.select(
        "car_id", "seq", "speed_kmh", "gear", band.alias("gear_band"),
        F.coalesce(band == F.col("gear"), F.lit(False)).alias("gear_matches"),
    )


def downsample(df: DataFrame, period_s: float, keys: tuple[str, ...] = ("car_id",), cols: list[str] | None = None
               ) -> DataFrame:
    """H8 (bucket form): the first sample of every ``period_s`` tumbling bucket per key.

    A mergeable ``min_by`` aggregate (partial aggregation before the shuffle).  The
    greedy gate of a sampling loop (emit when ``t - last_emitted >= period``) can keep
    a different subset when samples straddle bucket edges.
    """
    cols = cols or [c for c in df.columns if c not in keys]
    bucket = F.floor(F.unix_micros("event_time") / F.lit(int(period_s * 1e6))).cast("long")
    return (
        df.withColumn("bucket", bucket)
        .groupBy(*keys, "bucket")
        .agg(*[(F.min("seq") if c == "seq" else F.min_by(c, "seq")).alias(c) for c in cols])
    )


# The sensors of the car and the packet keys each one reports.
SENSOR_FIELDS = {
    "speedometer": ["speed_kmh"],
    "gps": ["x", "y", "sector_name", "lap_count"],
    "accelerometer": ["g_lat", "g_long"],
    "ecu": ["rpm", "gear", "throttle", "brake", "fuel_kg", "tire_wear_pct"],
    "timing": ["lap_time", "last_lap_time", "time", "timestamp"],
}


def sensor_tables(tel: DataFrame, periods_s: dict[str, float | None]) -> dict[str, DataFrame]:
    """Per-sensor readings at each sensor's own rate (``None`` = every sample)."""
    out = {}
    for name, fields in SENSOR_FIELDS.items():
        cols = ["car_id", "seq", "event_time", *[f for f in fields if f != "timestamp"]]
        base = tel.select(*cols)
        p = periods_s.get(name)
        out[name] = base if p is None else downsample(base, p, cols=cols[1:]).drop("bucket")
    return out


def sensor_fusion(sensors: dict[str, DataFrame], chunk_width: int = TIME_CHUNK_US) -> DataFrame:
    """H7: merge readings of all sensors into full packets, last observation carried forward.

    Readings are unioned (missing columns NULL), merged per (car, tick) with the
    later-registered sensor winning a shared key, then every field carries its
    last non-NULL value forward in time.  Chunked on event-time micros.
    """
    names = list(sensors)
    frames = [
        df.withColumn("_rank", F.lit(i)) for i, df in enumerate(sensors[n] for n in names)
    ]
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    fields = [c for c in u.columns if c not in ("car_id", "event_time", "seq", "_rank")]
    ticks = u.groupBy("car_id", "event_time").agg(
        F.max("seq").alias("seq"),
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_rank"))).alias(c) for c in fields],
    ).withColumn("_us", F.unix_micros("event_time"))
    fused = ordered_scan(
        ticks, ["car_id"], ["_us"], [Scan(f"_f_{c}", "last", F.col(c)) for c in fields],
        chunk_by="_us", chunk_width=chunk_width,
    )
    return fused.select("car_id", "event_time", "seq", *[F.col(f"_f_{c}").alias(c) for c in fields])


# ----------------------------------------------------------------- H8 exact gate

GATE_ROWS = 65536  # samples of all cars in the time of one chunk, on average
GATE_LEAST_BLOCKS = 16  # periods per chunk at least


def _ship_by_value() -> None:
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _gate_next(t, period):
    import numpy as np

    return np.searchsorted(t, t + period, side="left")


def _gate_follow(nxt, start, n):
    """Last index of the chains starting at ``start`` (vectorised pointer following)."""
    import numpy as np

    cur = np.asarray(start, dtype=np.int64).copy()
    last = cur.copy()
    live = cur < n
    while live.any():
        last[live] = cur[live]
        cur[live] = nxt[cur[live]]
        live = cur < n
    return last


def _groups(batches, keys):
    """Consecutive groups of rows sorted by ``keys`` across Arrow batches.

    Holds at most one group in memory (the one that may continue in the next
    batch), so memory is bounded by the largest group, not by the partition.
    """
    import numpy as np
    import pandas as pd

    held = []
    for pdf in batches:
        if pdf.empty:
            continue
        k = pdf[keys].to_numpy()
        starts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(axis=1)])
        if held and (pd.concat(held[-1:])[keys].to_numpy()[-1] != k[0]).any():
            yield pd.concat(held, ignore_index=True)
            held = []
        for a, b in zip(starts, np.r_[starts[1:], len(pdf)]):
            part = pdf.iloc[a:b]
            if b == len(pdf):
                held.append(part)  # may continue in the next batch
            else:
                held.append(part)
                yield pd.concat(held, ignore_index=True)
                held = []
    if held:
        yield pd.concat(held, ignore_index=True)


def _batched(frames, rows: int = 10000):
    """Concatenate small per-group outputs into Arrow-sized batches."""
    import pandas as pd

    buf, n = [], 0
    for f in frames:
        buf.append(f)
        n += len(f)
        if n >= rows:
            yield pd.concat(buf, ignore_index=True)
            buf, n = [], 0
    if buf:
        yield pd.concat(buf, ignore_index=True)


def _gate_chunk_summary(period: int, width: int):
    import numpy as np
    import pandas as pd

    def run(batches):
        return _batched(each(batches))

    def each(batches):
        for g in _groups(batches, ["car_id", "_chunk"]):
            t, s = g["_us"].to_numpy(np.int64), g["seq"].to_numpy(np.int64)
            n, chunk = len(t), int(g["_chunk"].iloc[0])
            # the chain enters at the first sample >= threshold, and the threshold is
            # below chunk start + period: only these samples can be entry points
            k = min(n, int(np.searchsorted(t, chunk * width + period, side="left")) + 1)
            cand = np.arange(k)
            last = _gate_follow(_gate_next(t, period), cand, n)
            yield pd.DataFrame({
                "car_id": np.full(k, g["car_id"].iloc[0], dtype=np.int64), "_chunk": np.full(k, chunk),
                "cand_us": t[cand], "cand_seq": s[cand], "exit_us": t[last],
            })

    return run


def _gate_resolve(period: int):
    import numpy as np
    import pandas as pd

    def run(batches):
        return _batched(each(batches))

    def each(batches):
        for g in _groups(batches, ["car_id"]):
            chunk = g["_chunk"].to_numpy(np.int64)
            cu, cs, ex = (g[c].to_numpy(np.int64) for c in ("cand_us", "cand_seq", "exit_us"))
            bounds = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1], True])
            out, threshold = [], None
            for a, b in zip(bounds[:-1], bounds[1:]):
                i = a if threshold is None else a + int(np.searchsorted(cu[a:b], threshold, side="left"))
                if i < b:
                    out.append((int(chunk[a]), int(cu[i]), int(cs[i])))
                    threshold = int(ex[i]) + period
            car = int(g["car_id"].iloc[0])
            yield pd.DataFrame([(car, *o) for o in out], columns=["car_id", "_chunk", "start_us", "start_seq"])

    return run


def _gate_emit(period: int):
    import numpy as np

    def run(batches):
        return _batched(each(batches))

    def each(batches):
        for g in _groups(batches, ["car_id", "_chunk"]):
            t, s = g["_us"].to_numpy(np.int64), g["seq"].to_numpy(np.int64)
            start = int(np.flatnonzero((t == g["start_us"].iloc[0]) & (s == g["start_seq"].iloc[0]))[0])
            nxt, keep, cur = _gate_next(t, period), [], start
            while cur < len(t):
                keep.append(cur)
                cur = int(nxt[cur])
            yield g.iloc[keep].drop(columns=["start_us", "start_seq", "_chunk"])

    return run


def rate_gate(df: DataFrame, period_s: float, cols: list[str] | None = None,
              blocks_per_chunk: int | None = None) -> DataFrame:
    """H8 exact: per car, emit a sample when ``t - last_emitted >= period`` (the first
    sample is always emitted), in event-time order with ties by sequence.  A sample
    without a time cannot pass it.

    The gate is sequential, so it is cut into time chunks of ``blocks_per_chunk``
    periods; by default as many as hold about 65,536 samples of all cars, from the table's time
    span and row count, so that a car with any share of the rows is cut too.  Only samples in a chunk's first period (and the first one after it)
    can be where the chain enters the chunk, so pass 1 follows every such entry to
    its exit per (car, chunk); pass 2 chains the small per-chunk summaries per car;
    pass 3 re-emits each chunk from its resolved entry.  Every grouped task holds
    one chunk, never a whole car.
    """
    _ship_by_value()
    period = int(round(period_s * 1e6))
    if blocks_per_chunk is None:
        us = F.unix_micros("event_time")
        low, high, n = df.agg(F.min(us), F.max(us), F.count(us)).first()
        span = (high - low) if n else 0
        blocks_per_chunk = max(GATE_LEAST_BLOCKS, span * GATE_ROWS // (max(n, 1) * period))
    width = period * blocks_per_chunk
    cols = [c for c in (cols or []) if c not in ("car_id", "seq", "event_time")]
    d = df.select("car_id", "seq", "event_time", *cols).filter(F.col("event_time").isNotNull())
    d = d.withColumn("_us", F.unix_micros("event_time"))
    d = d.withColumn("_chunk", F.floor(F.col("_us") / F.lit(width)).cast("long"))
    # one shuffle clusters each (car, chunk); passes 1 and 3 read the same exchange
    clustered = d.repartition("car_id", "_chunk")
    order = ["car_id", "_chunk", "_us", "seq"]
    summary = clustered.select("car_id", "_chunk", "seq", "_us").sortWithinPartitions(*order).mapInPandas(
        _gate_chunk_summary(period, width),
        "car_id long, _chunk long, cand_us long, cand_seq long, exit_us long",
    )
    starts = summary.repartition("car_id").sortWithinPartitions("car_id", "_chunk", "cand_us", "cand_seq").mapInPandas(
        _gate_resolve(period), "car_id long, _chunk long, start_us long, start_seq long"
    )
    joined = clustered.join(starts, ["car_id", "_chunk"])
    out_schema = T.StructType(
        [f for f in joined.schema.fields if f.name not in ("start_us", "start_seq", "_chunk")]
    )
    emitted = joined.repartition("car_id", "_chunk").sortWithinPartitions(*order).mapInPandas(
        _gate_emit(period), out_schema
    )
    return emitted.drop("_us")
