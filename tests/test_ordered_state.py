"""Sequential stream operators: order, restarts, late rows, timers and the state that stays."""

from __future__ import annotations

import random
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.operators import fusion as FU
from pitwall.operators import laps as L
from pitwall.session import scratch_path
from pitwall.streaming import ordered_state as O
from pitwall.streaming import sinks as K

from .helpers import TEL_SCHEMA, make_tel


class Value:
    def __init__(self, *_):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = tuple(value)

    def clear(self):
        self.value = None


class Rows(Value):
    def get(self):
        return iter(self.value or [])

    def appendList(self, rows):
        self.value = (self.value or []) + list(rows)

    def put(self, rows):
        self.value = list(rows)


class Map:
    def __init__(self, *_):
        self.value = {}

    def containsKey(self, key):
        return key in self.value

    def getValue(self, key):
        return self.value.get(key)

    def updateValue(self, key, value):
        self.value[key] = value

    def keys(self):
        return list(self.value)

    def removeKey(self, key):
        self.value.pop(key, None)

    def clear(self):
        self.value = {}


class Handle:
    """State and timers of one key, as the engine would keep them."""

    def __init__(self):
        self.states, self.timers = {}, set()

    def _state(self, kind, name):
        return self.states.setdefault(name, kind())

    def getValueState(self, name, *_):
        return self._state(Value, name)

    def getListState(self, name, *_):
        return self._state(Rows, name)

    def getMapState(self, name, *_):
        return self._state(Map, name)

    def registerTimer(self, t):
        self.timers.add(t)

    def deleteTimer(self, t):
        self.timers.discard(t)

    def listTimers(self):
        return iter(sorted(self.timers))


def run(processor, key, batches, delay_ms):
    """Feeds micro-batches of rows; the watermark follows the greatest time of the batches before."""
    handle, mark, out = Handle(), 0, []

    def fire():
        for t in [t for t in sorted(handle.timers) if t <= mark]:
            handle.timers.discard(t)
            out.extend(processor.handleExpiredTimer((key,), times, SimpleNamespace(getExpiryTimeInMs=lambda: t)))

    for rows in batches:
        processor.init(handle)  # a restart: everything comes from the state
        times = SimpleNamespace(getCurrentWatermarkInMs=lambda: mark)
        if len(rows):
            out.extend(processor.handleInputRows((key,), iter([rows]), times))
        fire()
        mark = max(mark, int(rows["us"].max()) // 1000 - delay_ms) if len(rows) else mark
        fire()
    return (pd.concat(out, ignore_index=True) if out else pd.DataFrame()), handle


def disordered(rng, frame, delay_us):
    """The rows in three to six batches; none is later than the delay against those before it."""
    at = frame["us"].to_numpy() + np.array([rng.randint(0, delay_us - 1000) for _ in range(len(frame))])
    order = np.argsort(at, kind="stable")
    cuts = sorted(rng.sample(range(1, len(frame)), rng.randint(2, 5)))
    return [frame.iloc[p] for p in np.split(order, cuts)]


FLUSH = 10**15


def flushed(frame):
    """A row far ahead of all others, which stays in the state."""
    last = frame.iloc[-1:].copy()
    last["us"] = FLUSH
    last["seq"] = 10**9
    return last


def schema_of(frame, ints=()):
    return T.StructType([T.StructField(c, T.LongType() if c in ("us", "seq", *ints) else T.DoubleType()) for c in frame])


@pytest.mark.parametrize("seed", range(12))
def test_gate_equals_a_loop(seed):
    rng = random.Random(seed)
    us = sorted(rng.randrange(10**7, 10**8, rng.choice([1, 250_000])) for _ in range(200))
    frame = pd.DataFrame({"us": us, "seq": range(200), "v": [rng.random() for _ in us]})
    want, last = [], None
    for t, s in zip(us, range(200)):
        if last is None or t >= last + 700_000:
            want.append(s)
            last = t
    got, handle = run(O._Gate(schema_of(frame), 700_000, "car_id"), 1,
                      [*disordered(rng, frame, 9_000_000), flushed(frame)], 9_000)
    assert got["seq"].tolist() == want and set(got["car_id"]) == {1}
    assert len(handle.states["pending"].value) == 1 and len(handle.timers) == 1


@pytest.mark.parametrize("seed", range(8))
def test_fusion_equals_last_values(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(150):
        rank = rng.randrange(3)
        rows.append({"us": rng.randrange(10**7, 5 * 10**7, 100_000), "seq": i, "rank": rank,
                     "a": rng.randint(1, 9) if rank != 1 and rng.random() < 0.8 else None,
                     "b": rng.random() if rank == 1 else None})
    frame = pd.DataFrame(rows).sort_values("us", ignore_index=True)
    # of one tick and rank, the last reading in order of arrival has no place in the contract
    clean = frame.groupby(["us", "rank"], as_index=False).last().sort_values("us", ignore_index=True)
    want = {}
    carry = {"a": None, "b": None}
    for us, tick in clean.sort_values(["us", "rank"]).groupby("us"):
        for r in tick.itertuples():
            carry = {"a": r.a if r.a == r.a else carry["a"], "b": r.b if r.b == r.b else carry["b"]}
        want[us] = (tick.seq.max(), carry["a"], carry["b"])
    clean = clean[["us", "seq", "rank", "a", "b"]]
    fields = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())])
    got, _ = run(O._Fusion(schema_of(clean, ("rank", "a")), fields, "car_id"), 1,
                 [*disordered(rng, clean, 9_000_000), flushed(clean)], 9_000)
    none = lambda x: None if x is None or x != x else x
    assert {r.us: (r.seq, none(r.a), none(r.b)) for r in got.itertuples()} == want


def brute_ghost(rows, gap_limit, gap):
    """The dashboard's loop: current lap's array and the previous lap's."""
    out, lap, ghost, ghost_lap, own, last_idx, samples, fastest, last_us = [], -1, {}, None, {}, -1, 0, float("inf"), None
    closed = False
    for us, seq, number, idx, speed, t in rows:
        if lap >= 0 and not closed and us - last_us > gap:
            out.append(("lap", lap, samples, None, None, "timer"))
            closed = True
        if number > lap:
            if lap >= 0:
                status = None if t <= 0 else "PB" if t < fastest else "OK"
                fastest = min(fastest, t) if t > 0 else fastest
                if not closed:
                    out.append(("lap", lap, samples, t if t > 0 else None, status, "next lap"))
                if own:
                    ghost, ghost_lap = own, lap
            lap, own, last_idx, samples, closed = number, {}, -1, 0, False
        samples, last_us = samples + 1, us
        if idx is None:
            continue
        near = last_idx >= 0 and abs(idx - last_idx) < gap_limit
        for i in range(min(idx, last_idx), max(idx, last_idx) + 1) if near else (idx,):
            own[i] = speed
        last_idx = idx
        out.append(("sample", seq, lap, idx, speed, ghost_lap, ghost.get(idx)))
    if lap >= 0 and not closed:
        out.append(("lap", lap, samples, None, None, "timer"))
    return out


@pytest.mark.parametrize("seed", range(10))
def test_ghost_equals_a_loop(seed):
    rng = random.Random(seed)
    us, lap, rows = 10**7, 0, []
    for seq in range(240):
        us += rng.choice([50_000, 100_000, 700_000, 3_000_000])
        lap += rng.random() < 0.05
        number = lap if rng.random() > 0.05 else max(0, lap - 1)  # a late lap number doesn't end a lap
        rows.append((us, seq, number, None if rng.random() < 0.1 else rng.randrange(700), float(rng.randint(50, 300)),
                     rng.choice([0.0, 80.5, 79.25, 90.0])))
    frame = pd.DataFrame(rows, columns=["us", "seq", "lap", "idx", "speed_kmh", "last_lap_time"])
    schema = T.StructType([T.StructField("us", T.LongType()), T.StructField("seq", T.LongType()),
                           T.StructField("lap", T.LongType()), T.StructField("idx", T.IntegerType()),
                           T.StructField("speed_kmh", T.DoubleType()), T.StructField("last_lap_time", T.DoubleType())])
    gap, expire = 2_000_000, 10**9
    flush = pd.DataFrame({"us": pd.Series([], dtype="int64")})
    got, handle = run(O._Ghost(schema, 500, gap, expire), 1, [*disordered(rng, frame, 9_000_000), flush], 9_000)
    # the watermark moves on by packets of other cars
    processor = O._Ghost(schema, 500, gap, expire)
    processor.init(handle)
    rest = []
    for mark in (us // 1000 + 1, us // 1000 + gap // 1000 + 1, FLUSH // 1000):
        times = SimpleNamespace(getCurrentWatermarkInMs=lambda: mark)
        for t in [t for t in sorted(handle.timers) if t <= mark]:
            handle.timers.discard(t)
            rest += processor.handleExpiredTimer((1,), times, None)
    got = pd.concat([got, *rest], ignore_index=True)
    none = lambda x: None if x is None or x is pd.NA or x != x else x
    seen = [(("sample", r.seq, r.lap, r.idx, r.speed_kmh, none(r.ghost_lap), none(r.ghost_speed_kmh))
             if r.kind == "sample" else ("lap", r.lap, r.samples, none(r.lap_time), none(r.status), r.closed_by))
            for r in got.itertuples()]
    assert seen == brute_ghost(rows, 500, gap)
    # after the last alarm the car's state is gone
    assert not handle.timers and not handle.states["meta"].exists() and not handle.states["points"].value


def test_gate_on_a_stream_restarts_and_drops_late_rows(spark):
    base = scratch_path(spark, "test-gate")
    rows = [{"t": 1000.0 + 0.3 * i, "seq": i, "speed_kmh": float(i)} for i in range(60)]
    odd = [{"car_id": None, "t": 1003.0, "seq": 900}, {"t": 1004.0, "seq": None}]
    late = [{"t": 1000.15, "seq": 901, "speed_kmh": 1.0}]
    ahead = [{"car_id": 2, "t": 9000.0, "seq": 902}]
    for i, part in enumerate([rows[30:45] + rows[:20], rows[45:] + rows[20:30] + odd, ahead, late + ahead]):
        make_tel(spark, part).coalesce(1).write.parquet(f"{base}/src/d={i:03d}")
        stream = spark.readStream.schema(TEL_SCHEMA).parquet(f"{base}/src/*")
        q = K.run_available_now(O.rate_gate_stream(stream, 1.0, ["speed_kmh"], "15 seconds"), f"{base}/ckpt",
                                path=f"{base}/out", rocksdb=True)
        store = spark.conf.get(K.STATE_STORE)
        assert "RocksDB" not in store  # the session's own choice is back
    got = sorted(r.seq for r in spark.read.parquet(f"{base}/out").collect())
    want = FU.rate_gate(make_tel(spark, rows), 1.0, ["speed_kmh"])
    assert got == sorted(r.seq for r in want.collect())
    assert sum(s.numRowsDroppedByWatermark for p in q.recentProgress for s in p.stateOperators) == 1


def test_history_of_the_ghost_stream_equals_batch(spark):
    base = scratch_path(spark, "test-ghost")
    rows = []
    for lap, t in [(1, 0.0), (2, 91.0), (1, 0.0), (2, 91.0), (3, 88.5), (3, 88.5), (5, 87.0), (6, 89.0)]:
        seq = len(rows)
        rows.append({"lap_count": lap, "last_lap_time": t, "seq": seq, "t": float(seq), "speed_kmh": 100.0 + seq})
    for i, part in enumerate([rows[3:6] + rows[:3], rows[6:], [{"car_id": 2, "t": 9000.0, "seq": 0, "lap_count": 0}]]):
        make_tel(spark, part).coalesce(1).write.parquet(f"{base}/src/d={i:03d}")
        stream = spark.readStream.schema(TEL_SCHEMA).parquet(f"{base}/src/*")
        stream = stream.withColumn("idx", F.pmod(F.col("seq") * 7, F.lit(5)).cast("int"))
        K.run_available_now(O.ghost_stream(stream, 60_000_000, 60_000_000, watermark="10 seconds"), f"{base}/ckpt",
                            path=f"{base}/out", rocksdb=True)
    out = spark.read.parquet(f"{base}/out")
    got = sorted((r.lap, r.lap_time, r.status) for r in out.where("kind = 'lap' AND status IS NOT NULL").collect())
    assert got == sorted((r.lap, r.lap_time, r.status) for r in L.lap_history(make_tel(spark, rows)).collect())
    assert [r.lap for r in out.where("closed_by = 'timer'").collect()] == [6]
    assert out.where("kind = 'sample'").count() == len(rows)


def test_fusion_needs_the_least_watermark(spark):
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max")
    try:
        with pytest.raises(ValueError, match="multipleWatermarkPolicy"):
            O.sensor_fusion_stream({"a": spark.readStream.format("rate").load()})
    finally:
        spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")


class Counted(Handle):
    """Counts the state objects' calls that write."""

    calls = 0

    def _state(self, kind, name):
        held = super()._state(kind, name)
        for name in ("appendList", "put", "update"):
            if hasattr(held, name) and not hasattr(getattr(held, name), "counted"):
                def call(*a, real=getattr(held, name)):
                    Counted.calls += 1
                    return real(*a)

                call.counted = True
                setattr(held, name, call)
        return held


def many_cars(rng, cars, n):
    us = sorted(rng.sample(range(10**7, 10**8), n))
    return pd.DataFrame({"car_id": [rng.randrange(cars) for _ in us], "us": us, "seq": range(n),
                         "v": [rng.random() if rng.random() < 0.7 else None for _ in us]})


def drained(make, frame, cut=6 * 10**7):
    """Two batches, each drained, through a bucket that holds all cars; and one car by itself."""
    handle, out = Counted(), []
    Counted.calls = 0
    for part, mark in ((frame[frame.us < cut], cut // 1000), (frame[frame.us >= cut], 10**9)):
        p = make()
        p.init(handle)
        p.handleInputRows((0,), iter([part.sample(frac=1, random_state=1)]), SimpleNamespace(getCurrentWatermarkInMs=lambda: 0))
        handle.timers.clear()
        out += p.handleExpiredTimer((0,), SimpleNamespace(getCurrentWatermarkInMs=lambda: mark), None)
    return pd.concat(out, ignore_index=True).sort_values("seq", ignore_index=True), Counted.calls


@pytest.mark.parametrize("seed", range(3))
def test_a_bucket_keeps_its_cars_apart_in_few_calls(seed):
    """The calls to the state don't grow with the cars: state kept by car took one or more for each."""
    frame = many_cars(random.Random(seed), 60, 900)
    fields = T.StructType([T.StructField("v", T.DoubleType())])
    ranked = frame.assign(rank=0)
    for rows, make in (
            (frame, lambda: O._Gate(schema_of(frame, ("car_id",)), 900_000, "car_id")),
            (ranked, lambda: O._Fusion(schema_of(ranked[["car_id", "us", "seq", "rank", "v"]], ("car_id", "rank")), fields, "car_id"))):
        got, calls = drained(make, rows)
        alone = pd.concat([drained(make, rows[rows.car_id == c])[0] for c in rows.car_id.unique()])
        pd.testing.assert_frame_equal(got, alone.sort_values("seq", ignore_index=True))
        assert calls <= 8 and len(got) > 200


def test_ghosts_of_a_bucket_equal_those_of_each_car():
    rng = random.Random(4)
    frame = many_cars(rng, 40, 1200).drop(columns="v")
    frame = frame.assign(lap=frame.us // 2 * 10**-7, idx=[None if rng.random() < 0.1 else rng.randrange(1500) for _ in range(1200)],
                         speed_kmh=[float(rng.randint(50, 300)) for _ in range(1200)], last_lap_time=80.0)
    frame["lap"] = frame["lap"].astype("int64")
    schema = T.StructType([*schema_of(frame[["car_id", "us", "seq", "lap"]], ("car_id", "lap")),
                           T.StructField("idx", T.IntegerType()), T.StructField("speed_kmh", T.DoubleType()),
                           T.StructField("last_lap_time", T.DoubleType())])
    make = lambda: O._Ghost(schema, 500, 10**7, 10**7)
    order = ["car_id", "us", "kind", "lap"]
    got = drained(make, frame)[0].sort_values(order, ignore_index=True)
    alone = pd.concat([drained(make, frame[frame.car_id == c])[0] for c in frame.car_id.unique()])
    pd.testing.assert_frame_equal(got, alone.sort_values(order, ignore_index=True), check_dtype=False)
    assert (got.kind == "sample").sum() == frame.idx.notna().sum() and got.ghost_speed_kmh.notna().any()
