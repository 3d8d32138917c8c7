"""Rejected packets of a stream: a crash between the writes, repair, replay; and the account of late packets."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pitwall.session import scratch_path
from pitwall.streaming import audit as A
from pitwall.streaming import dead_letters as DL
from pitwall.streaming import jobs as S
from pitwall.streaming import sinks as K

from .helpers import TEL_SCHEMA, make_tel


def packets(spark, texts):
    return spark.createDataFrame([(1, "t", i, t, None, 0) for i, t in enumerate(texts)], DL.PACKETS)


def run(spark, base, **kw):
    K.run_available_now(DL.packet_files(spark, f"{base}/inbox/*"), f"{base}/ckpt",
                        foreach_batch=DL.split_writer(f"{base}/out", **kw))


def fix(json, reasons):
    return F.when(F.array_contains(reasons, "bad_type:speed_kmh"), F.regexp_replace(json, '"fast"', "7.5"))


def test_crash_between_the_writes_then_repair(spark):
    base = scratch_path(spark, "test-letters")
    good, bad, hopeless = '{"timestamp":1,"speed_kmh":5.0}', '{"timestamp":2,"speed_kmh":"fast"}', "not json"
    packets(spark, [good, bad, hopeless, None, good]).coalesce(1).write.parquet(f"{base}/inbox/a")

    def crash(batch_id):
        raise RuntimeError("executor and driver are gone")

    with pytest.raises(Exception, match="gone"):
        run(spark, base, after_rejected=crash)
    # rejected packets of the broken batch stand there, but nobody sees them
    assert spark.read.parquet(f"{base}/out/rejected").count() > 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        DL.commits(spark, f"{base}/out").count()
    run(spark, base)
    assert [(r.delivered, r.valid, r.rejected) for r in DL.commits(spark, f"{base}/out").collect()] == [(5, 2, 3)]
    assert DL.committed(spark, f"{base}/out", "valid").count() == 2
    rejected = {r.seq: (list(r.reasons), r.attempt) for r in DL.committed(spark, f"{base}/out", "rejected").collect()}
    assert rejected[1] == (["bad_type:speed_kmh"], 0) and rejected[2] == (["malformed_json"], 0) and len(rejected) == 3
    assert all("#" in r.origin for r in DL.committed(spark, f"{base}/out", "rejected").collect())

    assert DL.replay(spark, f"{base}/out", fix, f"{base}/inbox") == 1
    assert DL.replay(spark, f"{base}/out", fix, f"{base}/inbox") == 0  # each batch once
    run(spark, base)
    valid = {(r.seq, r.attempt): r.speed_kmh for r in DL.committed(spark, f"{base}/out", "valid").collect()}
    assert valid == {(0, 0): 5.0, (4, 0): 5.0, (1, 1): 7.5}
    counts = DL.commits(spark, f"{base}/out").agg(F.sum("delivered"), F.sum("valid") + F.sum("rejected")).first()
    assert tuple(counts) == (6, 6)
    # a packet handed over twice is known by its origin
    again = DL.committed(spark, f"{base}/out", "rejected").where("seq = 1").select("origin").first().origin
    twice = spark.createDataFrame([(1, "t", 1, bad.replace('"fast"', "7.5"), again, 1)], DL.PACKETS)
    twice.write.parquet(f"{base}/inbox/b")
    run(spark, base)
    assert DL.committed(spark, f"{base}/out", "valid").count() == 3


def test_repairs_end_after_the_last_attempt(spark):
    base = scratch_path(spark, "test-letters")
    packets(spark, ["not json"]).write.parquet(f"{base}/inbox/a")
    worse = lambda json, reasons: F.concat(json, F.lit("!"))
    for _ in range(4):
        run(spark, base)
        DL.replay(spark, f"{base}/out", worse, f"{base}/inbox", attempts=3)
    tried = sorted(r.attempt for r in DL.committed(spark, f"{base}/out", "rejected").collect())
    assert tried == [0, 1, 2]


def test_account_of_late_packets(spark):
    base = scratch_path(spark, "test-audit")
    first = [{"t": float(t), "seq": t, "speed_kmh": 1.0} for t in range(0, 40)]
    late = [{"t": float(t), "seq": 100 + t, "speed_kmh": 1.0} for t in (1, 2, 3, 35)]  # three behind the mark, one not
    rows = []
    for i, part in enumerate([first, late]):
        make_tel(spark, part).coalesce(1).write.parquet(f"{base}/src/d={i}")
        stream = S.window_agg_stream(spark.readStream.schema(TEL_SCHEMA).parquet(f"{base}/src/*"), "10 seconds")
        q = K.run_available_now(stream, f"{base}/ckpt", path=f"{base}/out")
        rows.append(A.account(spark, i, rows, q, f"{base}/ckpt", spark.read.parquet(f"{base}/out")))
    # watermark 29 s: windows [0, 10) and [10, 20) are closed
    assert rows == [(0, 40, 20, 20, 0, 0), (1, 44, 20, 21, 3, 1)]
    held = {(r.window_start_us // 10**6) % 86400: r.samples for r in A.open_windows(spark, f"{base}/ckpt").collect()}
    assert sorted(held.values()) == [10, 11]


def test_what_update_mode_keeps_and_final_laps_evict(spark):
    """T3 keeps a group for every lap, T4 none for closed ones: read from the state itself."""
    base = scratch_path(spark, "test-state")
    laps = [{"lap_count": n, "t": 60.0 * n + k, "seq": 60 * n + k, "speed_kmh": 1.0} for n in range(4) for k in range(5)]
    make_tel(spark, laps + [{"lap_count": 9, "t": 9000.0, "seq": 9999}]).coalesce(1).write.parquet(f"{base}/src/d=0")
    src = spark.readStream.schema(TEL_SCHEMA).parquet(f"{base}/src/*")
    K.run_available_now(S.lap_final_stream(src, "20 seconds"), f"{base}/c1", path=f"{base}/o1")
    K.run_available_now(S.lap_summary_stream(src), f"{base}/c2", mode="update",
                        foreach_batch=K.lap_result_writer(f"{base}/rows", f"{base}/json"))
    assert spark.read.parquet(f"{base}/o1").count() == 4
    assert A.groups_in_state(spark, f"{base}/c1") == 1 and A.groups_in_state(spark, f"{base}/c2") == 5
