"""Sequential operators on streams: state in RocksDB, rows taken in event-time order.

Cars are dealt by hash to ``BUCKETS`` groups of state: a call to the state, a timer and a frame then
serve a group of cars and not one, so their number depends on the buckets and not on the cars.  ``InOrder``
is the common part.  Rows of a bucket are put down in list state as they arrive, in any
order; an event-time timer takes those out that the watermark has passed, sorted by time and sequence,
and hands them to ``step``, which keeps the cars apart.  The result therefore depends on the rows and not
on how they were delivered, as long as none is later than the watermark's delay (later ones are dropped, as
by Spark's own stateful operators).  A bucket has one timer, the earliest moment at which there is something to do.

State lives in the RocksDB provider with its changelog in the checkpoint, so a restarted query
goes on where the last committed micro-batch ended.  Rows in it are Arrow streams: values that go one by one
cost more than the work on them.  What a bucket holds is its cars' rows of the watermark's delay
plus the operator's own state; a drain reads what one micro-batch and the delay hold of one bucket, which the
source's rate limit bounds.

Rows without a key, time or sequence number have no place in an order and are left out.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pitwall.operators.matching import GAP_LIMIT
from pitwall.streaming.jobs import WATERMARK

BLOCK = 512  # track points whose values are kept as one block
BUCKETS = 1024  # groups of cars whose state is kept together


def _ship_by_value() -> None:
    """Pickle this module's classes by value, so Python workers need not import pitwall."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data) -> pa.Table:
    return pa.ipc.open_stream(bytes(data)).read_all()


class InOrder(StatefulProcessor):
    """Feeds ``step(rows)`` with the rows of a bucket's cars in order of ``(us, seq)``.

    ``schema`` tells what is kept of a pending row; without a column ``car`` the group's key is the car.
    """

    def __init__(self, schema: T.StructType, car: str):
        self.keyed = car not in schema.names
        self.schema = T.StructType([T.StructField(car, T.LongType()), *schema.fields]) if self.keyed else schema
        self.columns, self.car = self.schema.names, car

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.arrow = to_arrow_schema(self.schema)
        self.pending = handle.getListState("pending", "rows binary")
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        """The operator's own state."""

    def step(self, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        raise NotImplementedError

    def alarm(self, watermark: int, waiting: set) -> tuple[list[pd.DataFrame], int | None]:
        """What the passing of time alone brings about, and when (in ms) to be asked again;
        ``waiting`` are the cars with pending rows."""
        return [], None

    def _blob(self, frame: pd.DataFrame) -> tuple[bytes]:
        return (_packed(pa.Table.from_pandas(frame, schema=self.arrow, preserve_index=False)),)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True)
        if self.keyed:
            frame.insert(0, self.car, key[0])
        frame = frame.loc[frame["us"] // 1000 >= timerValues.getCurrentWatermarkInMs(), self.columns]
        if len(frame):
            self.pending.appendList([self._blob(frame)])
            # each call to the state is a round trip: a timer that is early enough stays
            due, known = int(frame["us"].min()) // 1000 + 1, list(self.handle.listTimers())
            if not known or due < min(known):
                for t in known:
                    self.handle.deleteTimer(t)
                self.handle.registerTimer(due)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        held = [_unpacked(r[0]) for r in self.pending.get()]
        again, waiting = [], set()
        if held:
            held = pa.concat_tables(held).to_pandas()
            now = (held["us"] // 1000 < mark).to_numpy()
            rest = held[~now]
            if len(rest):
                again.append(int(rest["us"].min()) // 1000 + 1)
                waiting = set(rest[self.car])
            if now.any():
                if len(rest):
                    self.pending.put([self._blob(rest)])
                else:
                    self.pending.clear()
                yield from self.step(held[now].sort_values(["us", "seq"], kind="stable", ignore_index=True))
        out, when = self.alarm(mark, waiting)
        yield from out
        # the timer that rang was the only one
        if again or when is not None:
            self.handle.registerTimer(min(again + ([when] if when is not None else [])))

    def close(self) -> None:
        pass


def in_order(stream: DataFrame, key: str, processor: InOrder, out_schema: str, buckets: int) -> DataFrame:
    """``stream(key, us, seq, ...)``, with a watermark, through an ordered operator (append mode)."""
    _ship_by_value()
    return (stream.where(F.col(key).isNotNull() & F.col("us").isNotNull() & F.col("seq").isNotNull())
            .withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
            .groupBy("_bucket").transformWithStateInPandas(processor, out_schema, "append", "eventTime"))


def _timed(stream: DataFrame, watermark: str) -> DataFrame:
    return stream.withWatermark("event_time", watermark).withColumn("us", F.unix_micros("event_time"))


# --- H8: exact rate gate -------------------------------------------------------------------


class _Gate(InOrder):
    def __init__(self, schema: T.StructType, period: int, key: str):
        super().__init__(schema, key)
        self.period = period

    def open(self, handle):
        self.last = handle.getValueState("last", "cars binary")

    def step(self, rows):
        found = self.last.get()
        last = dict(zip(*_unpacked(found[0]).to_pydict().values())) if found else {}
        rows = rows.sort_values(self.car, kind="stable", ignore_index=True)
        us, cars = rows["us"].tolist(), rows[self.car]
        first = np.flatnonzero(cars.ne(cars.shift()).to_numpy()).tolist()
        kept = []
        for a, b in zip(first, [*first[1:], len(us)]):
            car = cars[a]
            i = bisect_left(us, last[car] + self.period, a, b) if car in last else a
            while i < b:
                kept.append(i)
                last[car] = us[i]
                i = bisect_left(us, us[i] + self.period, i, b)
        if kept:
            types = self.arrow.field(self.car).type
            self.last.update((_packed(pa.table({"car": pa.array(last.keys(), types),
                                                "us": pa.array(last.values(), pa.int64())})),))
            yield rows.iloc[kept]


def rate_gate_stream(samples: DataFrame, period_s: float, cols: list[str], watermark: str = WATERMARK,
                     buckets: int = BUCKETS) -> DataFrame:
    """H8 on a stream: per car, a sample passes when ``period_s`` has gone by since the last one that
    passed, in event-time order with ties by sequence.  The state is one time per car."""
    keep = _timed(samples, watermark).select("car_id", "event_time", "us", "seq", *cols)
    schema = T.StructType([f for f in keep.schema.fields if f.name != "event_time"])
    return in_order(keep, "car_id", _Gate(schema, int(round(period_s * 1e6)), "car_id"), schema, buckets)


# --- H7: fusion of sensors -----------------------------------------------------------------


class _Fusion(InOrder):
    """Carries the last value of every field; a tick is the readings of one time."""

    def __init__(self, schema: T.StructType, fields: T.StructType, key: str):
        super().__init__(schema, key)
        self.fields, self.whole = fields.names, [f.name for f in fields if isinstance(f.dataType, T.IntegralType)]
        self.kept = T.StructType([self.schema[key], *fields])

    def open(self, handle):
        self.carry = handle.getValueState("carry", "cars binary")

    def step(self, rows):
        # of a tick the last registered sensor with a value wins; last() passes over nulls
        tick = [self.car, "us"]
        found = rows.sort_values([*tick, "rank"], kind="stable")[[*tick, "seq", *self.fields]].groupby(tick, sort=False)
        ticks = found[self.fields].last().reset_index()
        ticks["seq"] = found["seq"].max().to_numpy()
        before = self.carry.get()
        if before:
            before = _unpacked(before[0]).to_pandas()
            fresh = before[self.car].isin(ticks[self.car])
            old, ticks = before[~fresh], pd.concat([before[fresh], ticks], ignore_index=True)
        # a car's carried row, which has no time, comes first
        ticks = ticks.sort_values(self.car, kind="stable", ignore_index=True)
        ticks[self.fields] = ticks.groupby(self.car, sort=False)[self.fields].ffill()
        carry = ticks.drop_duplicates(self.car, keep="last")[[self.car, *self.fields]]
        if before is not None and len(old):
            carry = pd.concat([old, carry], ignore_index=True)
        self.carry.update((_packed(pa.Table.from_pandas(carry, schema=to_arrow_schema(self.kept), preserve_index=False)),))
        out = ticks[ticks["us"].notna()]
        out = out.astype({"us": "int64", "seq": "int64"})
        for c in self.whole:  # pandas makes doubles of whole numbers beside nulls
            out[c] = pd.Series([None if x is None or x != x else int(x) for x in out[c].tolist()], out.index, dtype=object)
        yield out[[self.car, "us", "seq", *self.fields]]


def sensor_fusion_stream(sensors: dict[str, DataFrame], watermark: str = WATERMARK, buckets: int = BUCKETS) -> DataFrame:
    """H7 on streams: readings of several sensor streams merged into full packets, last value carried forward.

    Every sensor is a stream with its own watermark.  A tick may go out only when all of them have passed
    it, so the query's watermark must be the least of theirs: Spark's default
    ``spark.sql.streaming.multipleWatermarkPolicy=min``, which is checked here.  A sensor that falls
    silent holds back the fused packets, as the dashboard would wait for it.
    """
    spark = next(iter(sensors.values())).sparkSession
    if spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy", "min") != "min":
        raise ValueError("fusion needs spark.sql.streaming.multipleWatermarkPolicy=min")
    union = None
    for rank, stream in enumerate(sensors.values()):
        s = _timed(stream, watermark).withColumn("rank", F.lit(rank))
        union = s if union is None else union.unionByName(s, allowMissingColumns=True)
    lead = ("car_id", "event_time", "us", "seq", "rank")
    fields = [f for f in union.schema.fields if f.name not in lead]
    keep = union.select(*lead, *[f.name for f in fields])
    schema = T.StructType([keep.schema["car_id"], keep.schema["us"], keep.schema["seq"], keep.schema["rank"], *fields])
    out = T.StructType([keep.schema["car_id"], keep.schema["us"], keep.schema["seq"], *fields])
    return in_order(keep, "car_id", _Fusion(schema, T.StructType(fields), "car_id"), out, buckets)


# --- T8: laps, personal bests and the ghost -------------------------------------------------

GHOST_ROWS = ("kind string, car_id long, lap int, seq long, us long, idx int, speed_kmh double, ghost_lap int, "
              "ghost_speed_kmh double, samples long, lap_time double, status string, closed_by string")
_NAMES = [part.strip().split(" ")[0] for part in GHOST_ROWS.split(",")]
_META = T.StructType([
    T.StructField("car", T.LongType()), T.StructField("lap", T.LongType()), T.StructField("side", T.IntegerType()),
    T.StructField("last_idx", T.IntegerType()), T.StructField("painted", T.BooleanType()),
    T.StructField("ghost_lap", T.LongType()), T.StructField("samples", T.LongType()),
    T.StructField("first_us", T.LongType()), T.StructField("last_us", T.LongType()),
    T.StructField("fastest", T.DoubleType()), T.StructField("closed", T.BooleanType())])
_NEW = dict(lap=-1, side=0, last_idx=-1, painted=False, ghost_lap=None, samples=0, first_us=0, last_us=0,
            fastest=math.inf, closed=False)


class _Trace:
    """Values of a car by track point in blocks of points; two sides: own lap and ghost.  In map state
    they are one entry, as runs of points with the same value, read when first needed and written back once a drain."""

    def __init__(self, state, car, known: bool):
        self.state, self.car, self.blocks, self.dirty = state, car, {}, False
        found = state.getValue((car,)) if known else None
        if found:
            at, runs, value = (np.frombuffer(bytes(b), t) for b, t in zip(found, (np.int64, np.int32, np.float64)))
            full = np.repeat(value, runs).reshape(-1, BLOCK)
            self.blocks = {(int(s), int(b)): row for (s, b), row in zip(at.reshape(-1, 2), full)}

    def get(self, side: int, idx: int) -> float:
        block = self.blocks.get((side, idx // BLOCK))
        return math.nan if block is None else float(block[idx % BLOCK])

    def paint(self, side: int, low: int, high: int, value: float) -> None:
        for b in range(low // BLOCK, high // BLOCK + 1):
            if (side, b) not in self.blocks:
                self.blocks[side, b] = np.full(BLOCK, np.nan)
            self.blocks[side, b][max(low - b * BLOCK, 0):high - b * BLOCK + 1] = value
        self.dirty = True

    def wipe(self, side: int) -> None:
        self.blocks = {at: v for at, v in self.blocks.items() if at[0] != side}
        self.dirty = True

    def write(self) -> None:
        if not self.dirty:
            return
        full = np.concatenate(list(self.blocks.values())) if self.blocks else np.zeros(0)
        bits = full.view(np.int64)
        first = np.flatnonzero(np.r_[True, bits[1:] != bits[:-1]]) if len(bits) else np.zeros(0, np.int64)
        runs = np.diff(np.r_[first, len(bits)]).astype(np.int32)
        self.state.updateValue((self.car,), (np.array(list(self.blocks), np.int64).tobytes(), runs.tobytes(),
                                             full[first].tobytes()))


class _Ghost(InOrder):
    def __init__(self, schema: T.StructType, gap_limit: int, gap: int, expire: int):
        super().__init__(schema, "car_id")
        self.gap_limit, self.gap, self.expire = gap_limit, gap, expire

    def open(self, handle):
        self.meta = handle.getValueState("meta", "cars binary")
        self.points = handle.getMapState("points", "car long", "blocks binary, runs binary, value binary")

    def _metas(self) -> dict:
        """What is known of each car of the bucket, by car."""
        found = self.meta.get()
        return {m["car"]: m for m in _unpacked(found[0]).to_pylist()} if found else {}

    def _keep(self, metas: dict) -> None:
        if metas:
            self.meta.update((_packed(pa.Table.from_pylist(list(metas.values()), schema=to_arrow_schema(_META))),))
        else:
            self.meta.clear()

    def _closing(self, m, lap_time, status, by) -> tuple:
        return ("lap", m["car"], m["lap"], None, m["last_us"], None, None, None, None, m["samples"], lap_time, status, by)

    def step(self, rows):
        metas, traces, out = self._metas(), {}, []
        names = ("car_id", "us", "seq", "lap", "idx", "speed_kmh", "last_lap_time")
        for car, us, seq, lap, idx, speed, last_time in zip(*(rows[c].tolist() for c in names)):
            if car not in traces:
                traces[car] = _Trace(self.points, car, car in metas)
                metas.setdefault(car, {"car": car, **_NEW})
            m, trace = metas[car], traces[car]
            if m["lap"] >= 0 and not m["closed"] and us - m["last_us"] > self.gap:
                out.append(self._closing(m, None, None, "timer"))
                m["closed"] = True
            if lap > m["lap"]:
                if m["lap"] >= 0:
                    status = None
                    if last_time > 0:
                        status = "PB" if last_time < m["fastest"] else "OK"
                        m["fastest"] = min(m["fastest"], last_time)
                    if not m["closed"]:
                        out.append(self._closing(m, last_time if status else None, status, "next lap"))
                    if m["painted"]:  # this lap's trace becomes the ghost, the old ghost goes
                        m["ghost_lap"], m["side"], m["painted"] = m["lap"], 1 - m["side"], False
                        trace.wipe(m["side"])
                m.update(lap=lap, last_idx=-1, samples=0, first_us=us, closed=False)
            m["samples"] += 1
            m["last_us"] = us
            if idx == idx and idx is not None:
                idx = int(idx)
                near = m["last_idx"] >= 0 and abs(idx - m["last_idx"]) < self.gap_limit
                trace.paint(m["side"], min(idx, m["last_idx"]) if near else idx,
                            max(idx, m["last_idx"]) if near else idx, speed)
                m.update(last_idx=idx, painted=True)
                ghost = trace.get(1 - m["side"], idx) if m["ghost_lap"] is not None else math.nan
                out.append(("sample", car, m["lap"], seq, us, idx, speed, m["ghost_lap"], ghost,
                            None, None, None, None))
        for trace in traces.values():
            trace.write()
        self._keep(metas)
        if out:
            yield self._frame(out)

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=_NAMES)
        for c in ("seq", "idx", "ghost_lap", "samples"):
            frame[c] = frame[c].astype("Int64")
        return frame

    def alarm(self, watermark, waiting):
        """Closes a lap after ``gap`` without packets and forgets the car after ``expire`` more."""
        metas = self._metas()
        out, gone, when, changed = [], [], [], False
        for car, m in metas.items():
            close_at = (m["last_us"] + self.gap) // 1000 + 1
            if watermark < close_at:
                when.append(close_at)
                continue
            if not m["closed"]:
                out.append(self._closing(m, None, None, "timer"))
                m["closed"] = changed = True
            if watermark < close_at + self.expire // 1000:
                when.append(close_at + self.expire // 1000)
            elif car not in waiting:
                gone.append(car)
        for car in gone:
            del metas[car]
            self.points.removeKey((car,))
        if changed or gone:
            self._keep(metas)
        return [self._frame(out)] if out else [], min(when, default=None)


def ghost_stream(matched: DataFrame, gap_us: int, expire_us: int, gap_limit: int = GAP_LIMIT,
                 watermark: str = WATERMARK, buckets: int = BUCKETS) -> DataFrame:
    """T8 + H5: each sample beside the previous lap's value at its track point, and a row for each lap
    when it ends (``kind`` is ``sample`` or ``lap``; columns ``GHOST_ROWS``).

    ``matched`` has ``car_id, event_time, seq, lap_count, idx, speed_kmh, last_lap_time``; samples without a
    position (null ``idx``) count for laps and paint nothing.  The lap of a sample is the greatest lap number so far; a
    sample within ``gap_limit`` points of the one before it in its lap paints all points
    between them.  A lap ends with the first packet of a later one, which tells its time (a best one is ``PB``), or after
    ``gap_us`` without packets, by timer and without a time; ``expire_us`` after that the car's
    state goes (event-time timers take the place of a TTL, which counts processing time).
    State of a car: two traces of the track's points, as runs of one value, and one row.
    """
    keep = _timed(matched, watermark).select(
        "car_id", "event_time", "us", "seq", F.coalesce(F.col("lap_count"), F.lit(0)).cast("long").alias("lap"),
        F.col("idx").cast("int").alias("idx"), F.coalesce(F.col("speed_kmh"), F.lit(0.0)).alias("speed_kmh"),
        F.coalesce(F.col("last_lap_time"), F.lit(0.0)).alias("last_lap_time"))
    schema = T.StructType([f for f in keep.schema.fields if f.name != "event_time"])
    return in_order(keep, "car_id", _Ghost(schema, gap_limit, gap_us, expire_us), GHOST_ROWS, buckets)
