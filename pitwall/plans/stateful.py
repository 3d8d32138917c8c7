"""Queries of the sequential stream operators (``streaming.ordered_state``).

The table is delivered in disorder: its time span is cut in two, and of each half one half of
the rows (by hash) comes a delivery late, mixed with what is next.  Every delivery is a run of its own,
which goes on from the checkpoint of the one before.  The last delivery also has a packet of another
car, far ahead, that lets the watermark pass all others once its batch is done.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwall.operators import clean as C
from pitwall.operators import fusion as FU
from pitwall.operators import laps as L
from pitwall.operators import matching as M
from pitwall.plans import track_sql as TS
from pitwall.plans.catalog import (
    _FUSED, FUSION_PERIODS, GATE_S, SQL, WINDOW, faulty_packets, register, telemetry_from_events_stream,
)
from pitwall.plans.oracle import LAP_SUMMARY_CTE, with_fixture
from pitwall.session import scratch_path
from pitwall.sources.fixtures import read_table, telemetry, track_points
from pitwall.sources.packets import encode_packets
from pitwall.sources.tracks import read_archive
from pitwall.streaming import audit as A
from pitwall.streaming import dead_letters as DL
from pitwall.streaming import jobs as S
from pitwall.streaming import ordered_state as O
from pitwall.streaming import sinks as K

PARTS = 2
AHEAD_DAYS = 90
DAY_US = 86_400_000_000
LAP_GAP_DAYS, EXPIRE_DAYS = 12, 30


def disorder(table, time: str, by: str):
    """``(deliveries, watermark delay)``: filters of ``table`` for each delivery, and the delay that bears them."""
    us = F.unix_micros(F.col(time).cast("timestamp"))
    low, high = table.agg(F.min(us), F.max(us)).first()
    width = ((high or 0) - (low or 0)) // PARTS + 1
    part = F.floor((us - F.lit(low or 0)) / F.lit(width)).cast("int")
    turn = part + F.pmod(F.xxhash64(by), F.lit(2)).cast("int")
    return [turn == i for i in range(PARTS + 1)], f"{width // 1_000_000 + 1} seconds"


def ahead(table, time: str, car: str):
    """One packet of car -1, ``AHEAD_DAYS`` after the last one; other columns but the number are null."""
    last = table.agg(F.max(time).alias(time))
    return last.select(*[
        F.lit(-1).cast(f.dataType).alias(f.name) if f.name == car
        else (F.col(time) + F.expr(f"INTERVAL '{AHEAD_DAYS}' DAY")).cast(f.dataType).alias(f.name) if f.name == time
        else F.lit(0).cast(f.dataType).alias(f.name) if f.name in ("event_id", "seq")
        else F.lit('{"k":0}').alias(f.name) if f.name == "props"
        else F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema.fields])


def deliver(spark, sf_dir, name, build):
    """Runs ``build(telemetry stream, watermark)`` once for each delivery of the events; gives what came out."""
    base = scratch_path(spark, name)
    events = read_table(spark, sf_dir, "events")
    turns, delay = disorder(events, "ts", "event_id")
    for i, due in enumerate(turns):
        part = events.where(due)
        if i == PARTS:
            part = part.unionByName(ahead(events, "ts", "user_id"))
        part.write.parquet(f"{base}/src/delivery={i:02d}")
        K.run_available_now(build(telemetry_from_events_stream(spark, f"{base}/src/*"), delay),
                            f"{base}/_ckpt", path=f"{base}/data", rocksdb=True)
    return spark.read.parquet(f"{base}/data")


@register("stream_rate_gate", SQL["rate_gate"])
def q_stream_rate_gate(spark, sf_dir):
    """H8: the exact gate over a shuffled stream, restarted after each delivery."""
    out = deliver(spark, sf_dir, "stream-gate",
                  lambda tel, delay: O.rate_gate_stream(tel, GATE_S, ["speed_kmh"], delay))
    return out.select("car_id", "seq", F.col("us").alias("event_us"), "speed_kmh")


@register("stream_sensor_fusion", SQL["sensor_fusion"])
def q_stream_sensor_fusion(spark, sf_dir):
    """H7: five sensor streams, each shuffled for itself, under the least of their watermarks."""
    base = scratch_path(spark, "stream-fusion")
    # all sensors are cut at the same times
    turns, delay = disorder(telemetry(spark, sf_dir).select("event_time", "seq"), "event_time", "seq")
    tables = FU.sensor_tables(telemetry(spark, sf_dir), FUSION_PERIODS)
    schemas = {name: t.schema for name, t in tables.items()}
    for name, t in tables.items():
        t.write.parquet(f"{base}/all/{name}")
    tables = {name: spark.read.schema(schemas[name]).parquet(f"{base}/all/{name}") for name in tables}
    for i in range(PARTS + 1):
        for name, t in tables.items():
            part = t.where(turns[i])
            if i == PARTS:
                part = part.unionByName(ahead(t, "event_time", "car_id"))
            part.write.parquet(f"{base}/src/{name}/delivery={i:02d}")
        sensors = {name: spark.readStream.schema(schemas[name]).parquet(f"{base}/src/{name}/*") for name in tables}
        K.run_available_now(O.sensor_fusion_stream(sensors, delay), f"{base}/_ckpt", path=f"{base}/data", rocksdb=True)
    return spark.read.parquet(f"{base}/data").select("car_id", F.col("us").alias("event_us"), "seq", *_FUSED)


def _ghost(spark, sf_dir):
    points = track_points(spark)
    return deliver(spark, sf_dir, "stream-ghost", lambda tel, delay: O.ghost_stream(
        M.map_match(tel, points), LAP_GAP_DAYS * DAY_US, EXPIRE_DAYS * DAY_US, watermark=delay))


_GHOST_LAPS = """ghost_laps AS (
SELECT car_id, lap_count, lag(lap_count) OVER (PARTITION BY car_id ORDER BY lap_count) AS ghost_lap
FROM (SELECT DISTINCT car_id, lap_count FROM trace) l
)"""


@register(
    "stream_ghost",
    with_fixture(
        """SELECT m.car_id, m.seq, CAST(m.effective_lap AS INTEGER) AS lap, m.idx, coalesce(m.speed_kmh, 0) AS speed_kmh,
  CAST(p.ghost_lap AS INTEGER) AS ghost_lap, g.speed_kmh AS ghost_speed_kmh,
  coalesce(m.speed_kmh, 0) - g.speed_kmh AS speed_delta
FROM mb m JOIN ghost_laps p ON p.car_id = m.car_id AND p.lap_count = m.effective_lap
LEFT JOIN trace g ON g.car_id = m.car_id AND g.lap_count = p.ghost_lap AND g.idx = m.idx""",
        TS.MATCHED_CTE, *TS.TRACE_CTES, _GHOST_LAPS,
    ),
)
def q_stream_ghost(spark, sf_dir):
    """T8 + H5 + J5: every sample beside the previous lap's value at its track point."""
    d = _ghost(spark, sf_dir).where("kind = 'sample'")
    return d.select("car_id", "seq", "lap", "idx", "speed_kmh", "ghost_lap", "ghost_speed_kmh",
                    (F.col("speed_kmh") - F.col("ghost_speed_kmh")).alias("speed_delta"))


@register(
    "stream_lap_close",
    with_fixture(
        f"""SELECT l.car_id, CAST(l.lap AS INTEGER) AS lap, l.samples, l.last_us, h.lap_time, h.status,
  CASE WHEN h.closed THEN 'next lap' ELSE 'timer' END AS closed_by
FROM (SELECT car_id, effective_lap AS lap, count(*) AS samples, max(timestamp) AS last_us FROM mb
      GROUP BY car_id, effective_lap) l
LEFT JOIN (
  SELECT car_id, previous_lap AS lap, true AS closed, CASE WHEN t > 0 THEN t END AS lap_time,
    CASE WHEN t > 0 THEN CASE WHEN best IS NULL OR t < best THEN 'PB' ELSE 'OK' END END AS status
  FROM (SELECT *, min(CASE WHEN t > 0 THEN t END) OVER (PARTITION BY car_id ORDER BY seq
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best
        FROM (SELECT car_id, seq, previous_lap, timestamp, coalesce(last_lap_time, 0) AS t,
                lag(timestamp) OVER (PARTITION BY car_id ORDER BY seq) AS before, is_lap_start FROM mb) b
        WHERE is_lap_start AND previous_lap IS NOT NULL) s
  WHERE timestamp - before <= {LAP_GAP_DAYS * DAY_US}) h
USING (car_id, lap)""",
        TS.MATCHED_CTE, *TS.TRACE_CTES[:1],
    ),
)
def q_stream_lap_close(spark, sf_dir):
    """A row for each lap as it ends, by the next lap's first packet or by timer."""
    d = _ghost(spark, sf_dir).where("kind = 'lap'")
    return d.select("car_id", "lap", "samples", F.col("us").alias("last_us"), "lap_time", "status", "closed_by")


@register(
    "stream_audit",
    with_fixture(
        f"""SELECT d.delivery,
  CAST(sum(CASE WHEN t.delivery <= d.delivery THEN 1 ELSE 0 END) AS BIGINT) AS delivered,
  CAST(sum(CASE WHEN t.delivery <= d.delivery AND t.kept AND t.window_end <= d.mark THEN 1 ELSE 0 END) AS BIGINT) AS emitted,
  CAST(sum(CASE WHEN t.delivery <= d.delivery AND t.kept AND t.window_end > d.mark THEN 1 ELSE 0 END) AS BIGINT) AS in_state,
  CAST(sum(CASE WHEN t.delivery <= d.delivery AND NOT t.kept THEN 1 ELSE 0 END) AS BIGINT) AS dropped
FROM marks d, (
  SELECT o.*, window_end > coalesce(p.mark, CAST(-1 AS BIGINT)) AS kept
  FROM (SELECT delivery, (CAST(floor(timestamp / CAST(86400000000 AS DOUBLE)) AS BIGINT) + 1) * 86400000000 AS window_end
        FROM due) o LEFT JOIN marks p ON p.delivery = o.delivery - 1) t
GROUP BY d.delivery""",
        """due AS (
SELECT timestamp, CASE lap_count WHEN (SELECT max(lap_count) FROM telemetry) THEN 1
  WHEN (SELECT max(lap_count) - 1 FROM telemetry) THEN 2 ELSE 0 END AS delivery FROM telemetry
)""",
        """marks AS (
SELECT delivery, max((CAST(floor(t / CAST(1000 AS DOUBLE)) AS BIGINT) - 10000) * 1000) OVER (ORDER BY delivery) AS mark
FROM (SELECT delivery, max(timestamp) AS t FROM due GROUP BY delivery) m
)""",
    ),
)
def q_stream_audit(spark, sf_dir):
    """T5 + T7: where every packet of three deliveries went; the last but one lap comes too late.
    Delivered are emitted, in a window still open, or dropped."""
    base = scratch_path(spark, "stream-audit")
    ev = read_table(spark, sf_dir, "events")
    lap = F.floor((F.dayofmonth("ts") - 1) / 6).cast("int")
    last = ev.agg(F.max(lap)).first()[0] or 0
    rows = []
    for i, due in enumerate((lap < last - 1, lap == last, lap == last - 1)):
        ev.filter(due).write.parquet(f"{base}/src/delivery={i:02d}")
        stream = S.window_agg_stream(telemetry_from_events_stream(spark, f"{base}/src/*"), WINDOW)
        q = K.run_available_now(stream, f"{base}/_ckpt", path=f"{base}/data")
        rows.append(A.account(spark, i, rows, q, f"{base}/_ckpt", spark.read.parquet(f"{base}/data")))
    return spark.createDataFrame(rows, A.ACCOUNT).drop("groups_dropped")


def mended(json, reasons):
    """Speeds that are no numbers become 0; packets without a time or that are no JSON can't be mended."""
    return F.when(F.array_contains(reasons, "bad_type:speed_kmh"),
                  F.regexp_replace(json, r'"speed_kmh":"[^"]*"', '"speed_kmh":0.0'))


@register(
    "stream_dead_letters",
    with_fixture(
        """SELECT car_id, track_id, seq, CASE WHEN seq % 40 = 3 THEN 1 ELSE 0 END AS attempt,
  CASE seq % 40 WHEN 1 THEN 'malformed_json' WHEN 2 THEN 'missing_timestamp' WHEN 3 THEN 'mended' ELSE 'valid' END AS fate,
  CASE WHEN seq % 40 IN (1, 2) THEN NULL WHEN seq % 40 = 3 THEN CAST(0 AS DOUBLE) ELSE speed_kmh END AS speed_kmh
FROM telemetry"""
    ),
)
def q_stream_dead_letters(spark, sf_dir):
    """Damaged packets in a stream, split batch by batch, mended where possible and replayed:
    what became of every packet."""
    base = scratch_path(spark, "stream-letters")
    packets = faulty_packets(spark, sf_dir).select("car_id", "track_id", "seq", "json", F.lit(None).cast("string").alias("origin"),
                                                   F.lit(0).alias("attempt"))
    half = F.col("seq") % 2
    for i in range(3):
        if i < 2:
            packets.where(half == i).write.parquet(f"{base}/inbox/delivery={i}")
        else:
            DL.replay(spark, f"{base}/out", mended, f"{base}/inbox")
        K.run_available_now(DL.packet_files(spark, f"{base}/inbox/*"), f"{base}/_ckpt",
                            foreach_batch=DL.split_writer(f"{base}/out"))
    valid, rejected = (DL.committed(spark, f"{base}/out", kind) for kind in ("valid", "rejected"))
    # a packet's last attempt tells what became of it
    mended_ones = valid.where("attempt > 0").select("origin")
    return valid.select(
        "car_id", "track_id", "seq", "attempt", F.when(F.col("attempt") > 0, "mended").otherwise("valid").alias("fate"), "speed_kmh",
    ).unionByName(rejected.join(mended_ones, "origin", "left_anti").select(
        "car_id", "track_id", "seq", "attempt", F.array_join("reasons", ",").alias("fate"),
        F.lit(None).cast("double").alias("speed_kmh")))


FAST_LAP_S = 80.5


@register(
    "archive_compare",
    with_fixture(
        f"""SELECT t.car_id, CAST(floor(t.timestamp / CAST(86400000000 AS DOUBLE)) AS BIGINT) AS day, count(*) AS samples,
  max(t.speed_kmh) AS max_speed_kmh, round(avg(t.throttle), 6) AS avg_throttle
FROM telemetry t JOIN (SELECT car_id FROM lap_summary WHERE lap_count > 0 AND last_lap_time_s > 0
  GROUP BY car_id HAVING min(last_lap_time_s) < CAST({FAST_LAP_S} AS DOUBLE)) f USING (car_id)
GROUP BY t.car_id, day""",
        LAP_SUMMARY_CTE,
    ),
)
def q_archive_compare(spark, sf_dir):
    """The stored history of the cars with a fast lap, from the archive's buckets of these cars alone."""
    out = scratch_path(spark, "archive-compare")
    pk = encode_packets(S.telemetry_stream(spark, sf_dir), "ns")
    K.run_available_now(C.archive_points(pk), f"{out}/_ckpt", foreach_batch=K.archive_writer(f"{out}/data"))
    cars = L.session_summary(L.lap_summary(telemetry(spark, sf_dir))).where(F.col("best_lap_time_s") < FAST_LAP_S)
    history = read_archive(spark, f"{out}/data", cars=cars)
    return history.groupBy(F.col("car_id").cast("long").alias("car_id"),
                           F.floor(F.col("time") / DAY_US / 1000).cast("long").alias("day")).agg(
        F.count(F.lit(1)).alias("samples"), F.max("speed_kmh").alias("max_speed_kmh"),
        F.round(F.avg("throttle"), 6).alias("avg_throttle"))
