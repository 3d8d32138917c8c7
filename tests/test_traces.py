"""Lap traces painted block by block: results of a loop over samples, and what is shuffled."""

from __future__ import annotations

import random

import pytest

from pitwall.operators import matching as M

from .helpers import make_tel


def loop(rows, gap_limit):
    """Values by (car, lap, idx) and each lap's lap before, sample by sample."""
    trace, last, laps = {}, {}, {}
    for car, lap, idx, v in rows:
        before = last.get((car, lap))
        near = before is not None and abs(idx - before) < gap_limit
        for i in range(min(idx, before), max(idx, before) + 1) if near else (idx,):
            trace[car, lap, i] = v
        last[car, lap] = idx
        laps.setdefault(car, set()).add(lap)
    ghost = {(c, b): a for c, n in laps.items() for a, b in zip(sorted(n), sorted(n)[1:])}
    return trace, ghost


def matched(spark, rng, n=1500):
    rows, lap = [], {c: 0 for c in (1, 2, 3)}
    for seq in range(n):
        car = rng.choice([1, 1, 1, 2, 3]) if seq < n - 3 else 3
        lap[car] += rng.choice([0] * 40 + [1, 2])
        rows.append((car, lap[car], rng.randrange(90), float(seq)))
    tel = make_tel(spark, [{"car_id": c, "lap_count": lap, "speed_kmh": v, "throttle": v / 2, "t": float(i)}
                           for i, (c, lap, _, v) in enumerate(rows)])
    at = spark.createDataFrame([(i, r[2]) for i, r in enumerate(rows)], "seq long, idx int")
    return tel.join(at, "seq"), rows


@pytest.mark.parametrize("block,batch_rows", [(512, 10_000), (16, 7), (7, 1)])
def test_traces_equal_a_loop(spark, block, batch_rows):
    d, rows = matched(spark, random.Random(block))
    trace, ghost = loop(rows, 40)
    got = M.lap_trace(d, 40, block=block, batch_rows=batch_rows).collect()
    assert len(got) == len(trace)
    assert {(r.car_id, r.lap_count, r.idx): (r.speed_kmh, r.throttle, r.brake) for r in got} == {
        k: (v, v / 2, 0.0) for k, v in trace.items()}
    got = M.lap_trace_vs_ghost(d, 40, block=block, batch_rows=batch_rows).collect()
    assert len(got) == len(trace)
    for r in got:
        lap = ghost.get((r.car_id, r.lap_count))
        assert r.speed_kmh == trace[r.car_id, r.lap_count, r.idx] and r.ghost_lap == lap
        assert r.ghost_speed_kmh == trace.get((r.car_id, lap, r.idx))


@pytest.mark.parametrize("trace", [M.lap_trace, M.lap_trace_vs_ghost])
def test_points_are_listed_after_the_last_shuffle(spark, trace):
    d, _ = matched(spark, random.Random(1), 60)
    plan = trace(d)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    listed = next(i for i, x in enumerate(lines) if "explode(sequence(cast(lo" in x)
    assert not any(op in x for x in lines[:listed] for op in ("Aggregate", "Join", "Repartition", "Sort"))
