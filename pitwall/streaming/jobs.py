"""Structured Streaming operators (T1-T11) built from the batch operators.

Sources are file streams here (Kafka in deployment, see ``sources.packets``);
every operator is a plain function from a streaming DataFrame to a streaming
DataFrame, and ``sinks`` runs and persists them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from pitwall.operators.laps import finish_lap_row, lap_aggregates
from pitwall.sources.fixtures import telemetry_from_events, track_points  # noqa: F401

EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
WATERMARK = "10 seconds"


def events_stream(spark: SparkSession, path: str, glob: str | None = "events.parquet",
                  max_files: int | None = None) -> DataFrame:
    """S1 stand-in: the events table(s) under ``path`` as a file stream (fixed schema)."""
    r = spark.readStream.schema(EVENTS_SCHEMA)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.parquet(path)


def telemetry_stream(spark: SparkSession, path: str, **kw) -> DataFrame:
    """Telemetry view over a stream of event files (stream-static join with the track)."""
    return telemetry_from_events(events_stream(spark, path, **kw), track_points(spark))


def lap_summary_stream(tel: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """T1 + T3: the lap aggregate in update mode.

    Parity with the original job: the key has no event-time column, so the
    watermark bounds nothing and state is kept for every lap; ``lap_final_stream``
    is the bounded variant.
    """
    agg = (
        tel.withWatermark("event_time", watermark)
        .filter(F.col("lap_count").isNotNull())
        .groupBy("car_id", "lap_count")
        .agg(*lap_aggregates())
    )
    return finish_lap_row(agg, ["car_id", "lap_count"])


def lap_final_stream(tel: DataFrame, gap: str, watermark: str = WATERMARK) -> DataFrame:
    """T4: each lap finalised once (append mode) and its state evicted.

    Groups by ``car_id, lap_count, session_window(event_time, gap)``: a lap closes
    when the watermark passes its last sample plus ``gap``.  A pause longer than
    ``gap`` inside one lap splits it, so ``gap`` must exceed the longest pause.
    """
    agg = (
        tel.withWatermark("event_time", watermark)
        .filter(F.col("lap_count").isNotNull())
        .groupBy("car_id", "lap_count", F.session_window("event_time", gap).alias("session"))
        .agg(*lap_aggregates())
    )
    return finish_lap_row(agg, ["car_id", "lap_count", "session"])


def window_agg_stream(tel: DataFrame, size: str, slide: str | None = None, watermark: str = WATERMARK) -> DataFrame:
    """Tumbling (or sliding) event-time windows per car, append mode."""
    w = F.window("event_time", size, slide) if slide else F.window("event_time", size)
    return (
        tel.withWatermark("event_time", watermark)
        .groupBy("car_id", w.alias("window"))
        .agg(
            F.count(F.lit(1)).alias("samples"),
            F.round(F.avg("speed_kmh"), 6).alias("avg_speed_kmh"),
            F.max("speed_kmh").alias("max_speed_kmh"),
        )
        .select(
            "car_id",
            F.unix_micros("window.start").alias("window_start_us"),
            F.unix_micros("window.end").alias("window_end_us"),
            "samples",
            "avg_speed_kmh",
            "max_speed_kmh",
        )
    )


def dedup_stream(tel: DataFrame, keys: tuple[str, ...] = ("car_id", "timestamp"), watermark: str = WATERMARK) -> DataFrame:
    """Drop redelivered packets (at-least-once sources) within the watermark.

    A packet is known by its car and time: a producer that retries writes a new offset.
    """
    return tel.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(list(keys))


def _ship_by_value() -> None:
    """Pickle this module's functions by value, so Python workers need not import pitwall."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


HISTORY_SCHEMA = "car_id long, lap int, lap_time double, status string"
HISTORY_STATE = "current_lap long, fastest double"


def _history_step(key, frames, state):
    """Lap boundary + history + PB for one car and one micro-batch.

    State is two numbers per car (current lap, fastest time).  Of each lap number only its
    first packet can begin a lap, so that is all that is kept of the frames, which arrive
    in any order; these rows are then processed by sequence with running max/min.
    """
    first: dict[int, tuple[int, float]] = {}
    for frame in frames:
        frame = frame.assign(lap_count=frame["lap_count"].fillna(0).astype("int64"),
                             last_lap_time=frame["last_lap_time"].fillna(0.0))
        for row in frame.loc[frame.groupby("lap_count")["seq"].idxmin()].itertuples(index=False):
            found = (int(row.seq), float(row.last_lap_time))
            first[int(row.lap_count)] = min(first.get(int(row.lap_count), found), found)
    rows = sorted((seq, lap, t) for lap, (seq, t) in first.items())
    if state.exists:
        cur, fastest = state.get
    else:
        cur, fastest = -1, float("inf")
    laps = np.array([r[1] for r in rows], dtype=np.int64)
    t = np.array([r[2] for r in rows], dtype=np.float64)
    run = np.maximum.accumulate(np.concatenate([[cur], laps]))
    before = run[:-1]
    emit = (laps > before) & (before != -1) & (t > 0)
    times, done = t[emit], before[emit]
    best_before = np.minimum.accumulate(np.concatenate([[fastest], times]))[:-1]
    status = np.where(times < best_before, "PB", "OK")
    new_fastest = float(min([fastest, *times.tolist()])) if len(times) else fastest
    state.update((int(run[-1]), new_fastest))
    if not len(times):
        return
    yield pd.DataFrame({
        "car_id": np.full(len(times), key[0], dtype=np.int64),
        "lap": done.astype(np.int32),
        "lap_time": times,
        "status": status,
    })


def lap_history_stream(tel: DataFrame) -> DataFrame:
    """Streaming lap history keyed by car (state store holds two numbers per car)."""
    _ship_by_value()
    return (
        tel.select("car_id", "seq", "lap_count", "last_lap_time")
        .groupBy("car_id")
        .applyInPandasWithState(_history_step, HISTORY_SCHEMA, HISTORY_STATE, "append", GroupStateTimeout.NoTimeout)
    )


def start_lap_analytics(packets: DataFrame, rows_path: str, json_path: str, checkpoint: str,
                        trigger: str = "5 seconds", ts_unit: str = "ns", watermark: str = WATERMARK):
    """E1 as a long-running query: decode -> event time -> watermark -> lap aggregate
    (update mode) -> typed rows + JSON result records every ``trigger`` (T6, T9).

    ``packets`` is a streaming packet table (Kafka or files, ``sources.packets``);
    malformed packets are filtered out here and kept by a separate ``quarantine`` query.
    """
    from pitwall.operators.clean import valid_packets
    from pitwall.streaming.sinks import lap_result_writer

    laps = lap_summary_stream(valid_packets(packets, ts_unit), watermark)
    return (
        laps.writeStream.option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(processingTime=trigger)
        .foreachBatch(lap_result_writer(rows_path, json_path))
        .start()
    )
