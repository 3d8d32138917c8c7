"""Streaming behaviour: finalised laps evict state, late rows drop, restarts resume."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwall.operators import laps as L
from pitwall.session import scratch_path
from pitwall.streaming import jobs as S
from pitwall.streaming import sinks as K

from .helpers import TEL_SCHEMA, make_tel


def _deliver_and_run(spark, batches, build, mode="append"):
    """Write each batch as a new file, restarting the query from its checkpoint each time."""
    base = scratch_path(spark, "test-stream")
    progress = []
    for i, rows in enumerate(batches):
        make_tel(spark, rows).coalesce(1).write.parquet(f"{base}/src/d={i:03d}")
        stream = build(spark.readStream.schema(TEL_SCHEMA).parquet(f"{base}/src/*"))
        q = K.run_available_now(stream, f"{base}/ckpt", path=f"{base}/out", mode=mode)
        progress += q.recentProgress
    return spark.read.parquet(f"{base}/out"), progress


def _lap(lap, start, n=50, car=1):
    return [{"car_id": car, "lap_count": lap, "t": start + k, "seq": int((start + k) * 10), "speed_kmh": 100.0 + k}
            for k in range(n)]


def test_lap_final_emits_once_evicts_state_and_drops_late_rows(spark):
    laps = [_lap(i, 60.0 * i) for i in range(4)]
    stale = [dict(r, seq=r["seq"] + 1) for r in _lap(1, 60.0)]  # old rows re-sent after the laps
    future = _lap(9, 10_000.0)
    out, progress = _deliver_and_run(spark, [*laps, stale, future],
                                     lambda s: S.lap_final_stream(s, "20 seconds"))
    rows = {r.lap_count: r.sample_count for r in out.collect()}
    assert rows == {0: 50, 1: 50, 2: 50, 3: 50}
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in progress for op in p.get("stateOperators", []))
    assert dropped >= 50
    removed = sum(op.get("numRowsRemoved", 0) for p in progress for op in p.get("stateOperators", []))
    assert removed >= 4


def test_update_mode_lap_state_is_kept_for_every_lap(spark):
    """Parity mode (key without event time): nothing is evicted, late rows still count."""
    base = scratch_path(spark, "test-update")
    batches = [_lap(0, 0.0), _lap(1, 60.0), [dict(r, seq=r["seq"] + 1) for r in _lap(0, 0.0, n=5)]]
    for i, rows in enumerate(batches):
        make_tel(spark, rows).coalesce(1).write.parquet(f"{base}/src/d={i:03d}")
        stream = S.lap_summary_stream(spark.readStream.schema(TEL_SCHEMA).parquet(f"{base}/src/*"))
        K.run_available_now(stream, f"{base}/ckpt", mode="update",
                            foreach_batch=K.lap_result_writer(f"{base}/rows", f"{base}/json"))
    latest = K.latest_version(spark.read.parquet(f"{base}/rows"), ["car_id", "lap_count"])
    counts = {r.lap_count: r.sample_count for r in latest.collect()}
    assert counts == {0: 55, 1: 50}
    versions = spark.read.parquet(f"{base}/rows").filter("lap_count = 0").count()
    assert versions == 2  # lap 0 re-emitted when its late rows arrived


def test_stateful_history_across_batches_equals_batch(spark):
    rows = []
    seq = 0
    for lap, t in [(1, 0.0), (2, 91.0), (1, 0.0), (2, 91.0), (3, 88.5), (3, 88.5), (5, 87.0), (6, 89.0)]:
        rows.append({"lap_count": lap, "last_lap_time": t, "seq": seq, "t": float(seq)})
        seq += 1
    batches = [rows[:3], rows[3:6], rows[6:]]
    out, _ = _deliver_and_run(spark, batches, S.lap_history_stream)
    got = sorted((r.lap, r.lap_time, r.status) for r in out.collect())
    want = sorted((r.lap, r.lap_time, r.status) for r in L.lap_history(make_tel(spark, rows)).collect())
    assert got == want and len(got) == 4


def test_window_agg_closed_windows_only(spark):
    rows = [{"t": float(t), "seq": t, "speed_kmh": float(t)} for t in range(0, 30)]
    out, _ = _deliver_and_run(spark, [rows], lambda s: S.window_agg_stream(s, "10 seconds"))
    got = sorted((r.window_start_us, r.samples) for r in out.collect())
    # watermark = 29 s - 10 s = 19 s: only the window [0, 10) is closed
    assert [s for _, s in got] == [10]
    assert out.agg(F.max("max_speed_kmh")).first()[0] == 9.0


def test_dedup_drops_redelivered_packets(spark):
    rows = [{"t": float(t), "seq": t, "speed_kmh": 1.0} for t in range(20)]
    out, _ = _deliver_and_run(spark, [rows + rows[:10]], S.dedup_stream)
    assert out.count() == 20


def test_long_running_lap_job_with_processing_time_trigger(spark):
    from pitwall.sources.packets import encode_packets, file_packets

    base = scratch_path(spark, "test-job")
    tel = make_tel(spark, _lap(1, 0.0, n=20) + _lap(2, 30.0, n=10))
    encode_packets(tel, "ns").write.parquet(f"{base}/in")
    q = S.start_lap_analytics(file_packets(spark, f"{base}/in"), f"{base}/rows", f"{base}/json",
                              f"{base}/ckpt", trigger="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    latest = K.latest_version(spark.read.parquet(f"{base}/rows"), ["car_id", "lap_count"])
    assert {r.lap_count: r.sample_count for r in latest.collect()} == {1: 20, 2: 10}
    assert spark.read.parquet(f"{base}/json").count() >= 2


def test_fan_out_two_queries_one_source(spark):
    """Independent consumers of one source, each with its own checkpoint and state."""
    base = scratch_path(spark, "test-fanout")
    make_tel(spark, _lap(1, 0.0, n=30)).coalesce(1).write.parquet(f"{base}/src/d=000")
    src = spark.readStream.schema(TEL_SCHEMA).parquet(f"{base}/src/*")
    K.run_available_now(S.window_agg_stream(src, "10 seconds"), f"{base}/ck1", path=f"{base}/o1")
    K.run_available_now(S.dedup_stream(src), f"{base}/ck2", path=f"{base}/o2")
    assert spark.read.parquet(f"{base}/o1").count() == 1  # watermark 29 s - 10 s: only [0, 10) is closed
    assert spark.read.parquet(f"{base}/o2").count() == 30
