"""The chunked two-level scan equals a plain window, whatever the chunk width."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pitwall.functions.ordered import Scan, Segment, ordered_scan, segmented_scan


def _data(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for car in range(3):
        seq = 0
        for _ in range(rnd.randint(1, 60)):
            seq += rnd.randint(1, 4)
            v = None if rnd.random() < 0.2 else rnd.randint(-5, 9)
            rows.append((car, seq, v))
    return spark.createDataFrame(rows, "car long, seq long, v int")


def _scans():
    v = F.col("v")
    return [Scan("mx", "max", v), Scan("mn", "min", v), Scan("sm", "sum", v), Scan("lst", "last", v),
            Scan("lg", "lag", v), Scan("mnb", "min_before", v), Scan("mxb", "max_before", v)]


def _python(rows):
    out = {}
    by = {}
    for car, seq, v in sorted(rows):
        by.setdefault(car, []).append((seq, v))
    for car, xs in by.items():
        seen = []
        for i, (seq, v) in enumerate(xs):
            nn = [x for x in seen if x is not None]
            incl = nn + ([v] if v is not None else [])
            last = next((x for x in reversed(seen + [v]) if x is not None), None)
            out[(car, seq)] = (
                max(incl) if incl else None,
                min(incl) if incl else None,
                sum(incl) if incl else None,
                last,
                xs[i - 1][1] if i else None,
                min(nn) if nn else None,
                max(nn) if nn else None,
            )
            seen.append(v)
    return out


@pytest.mark.parametrize("seed,width", [(1, 2), (2, 3), (3, 7), (4, 1000)])
def test_chunked_scan_matches_sequential(spark, seed, width):
    df = _data(spark, seed)
    got = ordered_scan(df, ["car"], ["seq"], _scans(), chunk_by="seq", chunk_width=width)
    ref = _python([tuple(r) for r in df.collect()])
    for r in got.collect():
        assert (r.mx, r.mn, r.sm, r.lst, r.lg, r.mnb, r.mxb) == ref[(r.car, r.seq)], (width, r)


def test_staged_scan_uses_previous_stage(spark):
    df = _data(spark, 7)
    stages = [[Scan("lg", "lag", F.col("seq"))], [Scan("gap_sum", "sum", F.col("seq") - F.coalesce("lg", "seq"))]]
    got = ordered_scan(df, ["car"], ["seq"], stages, chunk_by="seq", chunk_width=3)
    firsts = {r.car: r.f for r in df.groupBy("car").agg(F.min("seq").alias("f")).collect()}
    for r in got.collect():
        assert r.gap_sum == r.seq - firsts[r.car]


@pytest.mark.parametrize("seed,width", [(1, 1), (2, 2), (3, 3), (4, 7), (5, 1000)])
def test_segmented_scan_matches_sequential(spark, seed, width):
    """Sums that restart, with values and resets that depend on the row before."""
    df = _data(spark, seed).withColumn("w", F.col("v") / 4)
    drop = F.col("before") > F.col("v")
    got = segmented_scan(
        df, ["car"], ["seq"], {"before": F.col("v"), "gap": F.col("seq")},
        [Segment("n", F.coalesce(drop, F.lit(False)).cast("long")), Segment("s", F.col("w"), drop),
         Segment("g", F.col("seq") - F.coalesce("gap", F.col("seq")), F.col("v") == 3), Segment("all", F.col("v"))],
        chunk_by="seq", chunk_width=width)
    assert set(got.columns) == {"car", "seq", "v", "w", "before", "gap", "n", "s", "g", "all"}
    want, state = {}, {}
    for r in sorted(df.collect(), key=lambda r: (r.car, r.seq)):
        p = state.get(r.car)
        fell = p is not None and p["v"] is not None and r.v is not None and p["v"] > r.v
        n = (p["n"] if p else 0) + fell
        s = (0 if fell or not p else p["s"]) + (r.w or 0)
        g = (0 if r.v == 3 or not p else p["g"]) + (r.seq - (p["seq"] if p else r.seq))
        total = (p["all"] if p else 0) + (r.v or 0)
        state[r.car] = {"v": r.v, "seq": r.seq, "n": n, "s": s, "g": g, "all": total}
        want[(r.car, r.seq)] = (p["v"] if p else None, p["seq"] if p else None, n, s, g, total)
    seen = {(r.car, r.seq): (r.before, r.gap, r.n, r.s, r.g, r["all"]) for r in got.collect()}
    assert seen == want


def test_segmented_scan_leaves_out_rows_without_a_place(spark):
    df = spark.createDataFrame([(1, 1, 2), (None, 2, 3), (1, None, 4), (1, 3, 5)], "car long, seq long, v int")
    got = segmented_scan(df, ["car"], ["seq"], {"b": F.col("v")}, [Segment("s", F.col("v"))], "seq", 2)
    assert sorted((r.seq, r.b, r.s) for r in got.collect()) == [(1, None, 2), (3, 2, 7)]
    empty = segmented_scan(df.limit(0), ["car"], ["seq"], {}, [Segment("s", F.col("v"))], "seq", 2)
    assert empty.columns == ["car", "seq", "v", "s"] and empty.collect() == []
