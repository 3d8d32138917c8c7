"""Topic contract, positions, coercion and the shared folder."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pitwall import session
from pitwall.operators import clean as C
from pitwall.operators import fusion as FU
from pitwall.operators import laps as L
from pitwall.operators import matching as M
from pitwall.operators import track as TR
from pitwall.sources.packets import packets_of_records
from pitwall.streaming import jobs as S
from tests.helpers import make_tel

LINE = [("trk", i, float(i), 0.0) for i in range(100)]
POINTS = "track_id string, idx int, x double, y double"


def test_records_without_key_get_default_tags(spark):
    body = '{"timestamp":1,"speed_kmh":5.0}'
    raw = spark.createDataFrame(
        [(None, body, 0), ("44|spa", body, 1), ("44", body, 2), ("abc|spa", body, 3), ("", body, 4)],
        "key string, value string, offset long").select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), "offset")
    got = [(r.car_id, r.track_id) for r in packets_of_records(raw, default_car=7).orderBy("seq").collect()]
    assert got == [(7, "unknown"), (44, "spa"), (44, "unknown"), (7, "spa"), (7, "unknown")]
    assert C.archive_points(packets_of_records(raw)).filter("car_id IS NULL").count() == 0


def test_archive_of_null_tags_uses_the_defaults(spark):
    raw = spark.createDataFrame([(None, None, 1, '{"timestamp":1}')], "car_id long, track_id string, seq long, json string")
    r = C.archive_points(raw, default_tags={"car_id": 3}).first()
    assert (r.car_id, r.track_id) == (3, "unknown")


def test_text_car_id_survives_the_lap_record(spark):
    tel = make_tel(spark, [{"t": float(i), "lap_count": 1, "speed_kmh": 1.0} for i in range(3)])
    laps = L.lap_summary(tel).withColumn("car_id", F.lit("44"))
    r = C.decode_lap_json(C.lap_json(laps)).first()
    assert r.car_id == 44 and r.lap_count == 1


def test_numeric_text_and_whole_floats_are_values(spark):
    rows = [(1, "t", i, j) for i, j in enumerate([
        '{"timestamp":1,"speed_kmh":"5.0","gear":3.0,"rpm":"11234.5"}', '{"timestamp":1,"lap_count":2.0}',
        '{"timestamp":1,"lap_count":2.5}', '{"timestamp":1,"speed_kmh":"fast"}', '{"timestamp":1,"rpm":null}'])]
    raw = spark.createDataFrame(rows, "car_id long, track_id string, seq long, json string")
    a = {r.seq: r for r in C.archive_points(raw, keep_seq=True).collect()}
    assert set(a) == {0, 1, 2} and (a[0].speed_kmh, a[0].gear, a[0].rpm) == (5.0, 3, 11234)
    assert {r.seq for r in C.quarantine(raw).collect()} == {2, 3}
    v = {r.seq: r for r in C.valid_packets(raw).collect()}
    assert set(v) == {0, 1, 4} and v[1].lap_count == 2 and v[0].speed_kmh == 5.0 and v[0].gear == 3


def test_packet_without_position_may_begin_a_lap(spark):
    pts = spark.createDataFrame(LINE, POINTS)
    rows = [{"lap_count": 1, "x": 1.0, "y": 0.0, "speed_kmh": 1.0}, {"lap_count": 3, "speed_kmh": 2.0},
            {"lap_count": 2, "x": 9.0, "y": 0.0, "speed_kmh": 3.0}]
    tel = make_tel(spark, rows)
    laps = {r.seq: r.effective_lap for r in L.lap_boundaries(tel.select("car_id", "seq", "lap_count")).collect()}
    assert laps == {0: 1, 1: 3, 2: 3}
    trace = {(r.lap_count, r.idx) for r in M.lap_trace(M.matched_laps(tel, pts)).collect()}
    assert trace == {(1, 1), (3, 9)}


def test_positions_that_are_missing_or_nan(spark):
    pts = spark.createDataFrame(LINE, POINTS)
    tel = make_tel(spark, [{"x": 5.0, "y": 0.0}, {"x": float("nan"), "y": 0.0}, {"x": 7.0}, {}])
    assert {r.seq: r.idx for r in M.map_match(tel, pts).collect()} == {0: 5}
    assert {r.seq: r.idx for r in M.map_match(tel, pts, missing_as_zero=True).collect()} == {0: 5, 2: 7, 3: 0}


def test_large_dimensions_join_without_broadcast(spark):
    pts = spark.createDataFrame(LINE, POINTS)
    hinted = [M.bounded(pts, limit)._jdf.queryExecution().analyzed().toString() for limit in (100, 99)]
    assert "broadcast" in hinted[0] and "broadcast" not in hinted[1]


def test_gate_ignores_samples_without_time(spark):
    tel = make_tel(spark, [{"t": float(i), "speed_kmh": 1.0} for i in range(10)])
    tel = tel.withColumn("event_time", F.when(F.col("seq") != 4, F.col("event_time")))
    assert [r.seq for r in FU.rate_gate(tel, 2.0).orderBy("seq").collect()] == [0, 2, 5, 7, 9]


def test_history_step_keeps_one_packet_a_lap():
    import pandas as pd

    class State:
        exists = False

        def update(self, value):
            self.value = value

    frames = [pd.DataFrame({"seq": [5, 1, 9], "lap_count": [2, 1, 3], "last_lap_time": [90.0, 0.0, 88.0]}),
              pd.DataFrame({"seq": [2, 6, 7], "lap_count": [1, 1, None], "last_lap_time": [0.0, 90.0, None]})]
    state = State()
    out = pd.concat(S._history_step((44,), iter(frames), state))
    assert out[["lap", "lap_time", "status"]].values.tolist() == [[1, 90.0, "PB"], [2, 88.0, "PB"]]
    assert state.value == (3, 88.0)


def test_shared_folder_must_be_named_on_a_cluster(monkeypatch):
    class Context:
        def __init__(self, master, folder=None):
            self.master, self.folder = master, folder

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        def __init__(self, master, folder=None, conf=None):
            self.sparkContext, self.conf = Context(master, folder), conf or {}

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.checkpoint_root(Session(master))
    assert session.checkpoint_root(Session("yarn", conf={"spark.checkpoint.dir": "hdfs:///c/"})) == "hdfs:///c"
    assert session.checkpoint_root(Session("yarn", folder="hdfs:///d")) == "hdfs:///d"
    assert session.checkpoint_root(Session("local[2]"))


def test_even_points_travel_the_summed_distance(spark):
    import math

    uneven = [(0, 0.0, 0.0), (1, 10.0, 0.0), (2, 12.0, 1.0), (3, 400.0, 30.0), (4, 400.0, 31.0), (5, 0.0, 700.0)]
    pts = spark.createDataFrame([("t", *p) for p in uneven], "track_id string, pos int, x double, y double")
    even = TR.resample_even(TR.resample_closed(pts, 20), 400)
    rows = TR.track_geometry(even.drop("s")).orderBy("idx").collect()
    assert [r.idx for r in rows] == list(range(400))
    travelled = 0.0
    steps = [math.dist((a.x, a.y), (b.x, b.y)) for a, b in zip(rows, rows[1:])]
    for r, step in zip(rows, [0.0, *steps]):
        travelled += step
        assert abs(r.s - travelled) <= max(steps) * 2
    assert max(steps) < 1.05 * sum(steps) / len(steps)
