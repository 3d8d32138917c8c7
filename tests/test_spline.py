"""The closed cubic spline against a dense solve."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from pitwall.operators import track as TR

SCHEMA = "track_id string, pos int, x double, y double"


def dense(points, n_points):
    """Positions and second derivatives of the periodic spline by a dense linear system."""
    p = np.array(points, dtype=float)
    n = len(p)
    h = np.linalg.norm(np.roll(p, -1, 0) - p, axis=1)
    a = np.zeros((n, n))
    d = np.zeros((n, 2))
    for i in range(n):
        a[i, i - 1] += h[i - 1]
        a[i, i] += 2 * (h[i - 1] + h[i])
        a[i, (i + 1) % n] += h[i]
        d[i] = 6 * ((p[(i + 1) % n] - p[i]) / h[i] - (p[i] - p[i - 1]) / h[i - 1])
    m = np.linalg.solve(a, d)
    u = np.r_[0, np.cumsum(h)]
    out = []
    for k in range(n_points):
        at = k * u[-1] / (n_points - 1)
        i = min(int(np.searchsorted(u, at, side="right")) - 1, n - 1)
        t, s, j = at - u[i], u[i + 1] - at, (i + 1) % n
        out.append((m[i] * s**3 + m[j] * t**3) / (6 * h[i]) + (p[i] / h[i] - m[i] * h[i] / 6) * s
                   + (p[j] / h[i] - m[j] * h[i] / 6) * t)
    return np.array(out)


def frame(spark, tracks):
    return spark.createDataFrame([(k, i, float(x), float(y)) for k, pts in tracks.items() for i, (x, y) in enumerate(pts)],
                                 SCHEMA).repartition(3)


def test_many_tracks_against_a_dense_solve(spark):
    rng = np.random.default_rng(2)
    tracks = {}
    for k, n in enumerate([3, 4, 5, 7, 16, 33, 150]):
        turn = np.sort(rng.random(n)) * 2 * np.pi
        tracks[f"t{k}"] = np.c_[np.cos(turn), np.sin(turn)] * rng.uniform(20, 900, (n, 1))
    got = {}
    for r in TR.spline_closed(frame(spark, tracks), 200).collect():
        got.setdefault(r.track_id, {})[r.idx] = (r.x, r.y)
    for k, pts in tracks.items():
        assert sorted(got[k]) == list(range(200))
        assert np.abs(np.array([got[k][i] for i in range(200)]) - dense(pts, 200)).max() < 1e-8


def test_curvature_is_continuous_and_that_of_a_circle(spark):
    turn = np.arange(40) / 40 * 2 * np.pi
    got = TR.spline_closed(frame(spark, {"c": np.c_[100 * np.cos(turn), 100 * np.sin(turn)]}), 4001).orderBy("idx").collect()
    k = np.array([r.curvature for r in got])
    assert np.abs(k - 0.01).max() < 1e-4  # a circle of 100 m
    assert np.abs(np.diff(k)).max() < 2e-6  # no jumps, at the waypoints either (every 100th point is one)
    assert abs(got[0].x - got[-1].x) < 1e-9 and abs(got[0].y - got[-1].y) < 1e-9
    assert all(abs(got[100 * i].x - 100 * np.cos(turn[i])) < 1e-9 for i in range(40))


def test_odd_waypoints(spark):
    square = [(0, 0), (10, 0), (10, 10), (0, 10)]
    doubled = [(0, 0), (0, 0), (10, 0), (10, 10), (10, 10), (10, 10), (0, 10), (0, 0)]
    d = frame(spark, {"a": square, "b": doubled, "two": [(0, 0), (1, 1)], "same": [(3, 3)] * 5})
    d = d.unionByName(spark.createDataFrame([("a", 99, None, 4.0), ("none", 0, None, None)], SCHEMA))
    got = TR.spline_closed(d, 50)
    by = {t: [(r.x, r.y) for r in got.where(F.col("track_id") == t).orderBy("idx").collect()] for t in ("a", "b")}
    assert len(by["a"]) == 50 and np.abs(np.array(by["a"]) - np.array(by["b"])).max() < 1e-12
    assert {r.track_id for r in got.collect()} == {"a", "b"}
    assert TR.spline_closed(d.limit(0), 50).collect() == []
