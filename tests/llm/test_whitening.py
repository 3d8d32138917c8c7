import math

import numpy as np
import pytest
from pyspark.sql import types as T

from pitwall.llm import whitening as W

from .helpers import SF

VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    # names that the operator uses inside
    T.StructField("id", T.StringType()), T.StructField("v", T.StringType()), T.StructField("x", T.StringType()),
    T.StructField("a.b", T.StringType())])


def vectors_of(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "p", "q", "r", "s") for i, v in rows], VECTORS).repartition(parts)


def brute(rows, k):
    """Whitened values (up to sign), deviations and shares from a dense covariance."""
    x = np.array([[math.floor(float(np.float32(c)) * 64) + 1_000_000 for c in v] for v in rows], dtype=object)
    n, s = len(x), x.sum(axis=0)
    dev = [int(sum((n * a - b) ** 2 for a, b in zip(r, s))) for r in x]
    c = np.array([[(n * a - b) / n for a, b in zip(r, s)] for r in x], dtype=float)
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    keep = [j for j in range(min(k, len(e))) if e[j] > W.RANK * e[0]]
    return c @ u[:, keep] / np.sqrt(e[keep]), dev, e[keep] / e.sum()


def check(got, rows, k=W.COMPONENTS, each=1):
    want, dev, share = brute(rows, k)
    values = np.array([r.whitened for r in sorted(got, key=lambda r: (r.vec_id, r.component))]).reshape(want.shape)
    sign = np.sign((values * want).sum(axis=0))
    assert np.abs(values * sign - want).max() < 1e-8
    assert {(r.vec_id, r.deviation, r.n) for r in got} == {(i, d, len(rows)) for i, d in enumerate(dev)}
    for r in got:
        assert abs(r.explained / share[r.component - 1] - 1) < 1e-9
        assert r.identity_error < 1e-9


def test_query_against_dense(spark):
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    got = W.op13_whitening(spark, SF)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    ids = {v: i for i, v in enumerate(sorted(rows))}
    got = [r.asDict() | {"vec_id": ids[r.vec_id]} for r in got.collect()]
    assert len(got) == len(rows) * 32
    from pyspark.sql import Row

    check([Row(**g) for g in got], [rows[v] for v in sorted(rows)])


def test_odd_rows_and_sums_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(W, "_FAN", 2)
    monkeypatch.setattr(W, "_BLOCK", 8 * 6 * 4)  # four vectors a block
    rng = np.random.default_rng(1)
    good = (rng.standard_normal((57, 6)) * [9, 5, 3, 2, 1, 0.5]).tolist()
    good[5] = good[6] = good[7]
    odd = [(None, None), (900, None), (901, []), (902, [1.0] * 5), (903, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
           (904, [math.nan] * 6), (905, [1.0, math.inf, 1.0, 1.0, 1.0, 1.0]), (906, [None])]
    blocks, wide = W.packed(vectors_of(spark, [*enumerate(good), *odd], parts=9))
    assert wide == 6
    check(W.transform(blocks, W.fit(blocks, wide)).collect(), good)


def test_repeats_null_ids_and_lost_rank(spark):
    flat = [[float(a), float(a), float(b), 1.0] for a in range(5) for b in range(4)]  # rank two
    blocks, wide = W.packed(vectors_of(spark, list(enumerate(flat))))
    got = W.transform(blocks, W.fit(blocks, wide)).collect()
    assert {r.component for r in got} == {1, 2}
    check(got, flat)
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 1.0]), (None, [1.0, 1.0])]
    blocks, wide = W.packed(vectors_of(spark, rows))
    got = W.transform(blocks, W.fit(blocks, wide)).collect()
    assert sorted((r.vec_id is None, r.component) for r in got) == [(False, 1)] * 2 + [(False, 2)] * 2 + [(True, 1)] * 2 + [(True, 2)] * 2


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 40])
def test_nothing_to_whiten(spark, rows):
    blocks, wide = W.packed(vectors_of(spark, rows))
    assert W.transform(blocks, W.fit(blocks, wide)).collect() == []


def test_huge_entries(spark):
    rows = [(i, [3e38 if i == 3 else float(i), -1e30 if i == 4 else float(i * i % 7)]) for i in range(9)]
    blocks, wide = W.packed(vectors_of(spark, rows))
    got = W.transform(blocks, W.fit(blocks, wide)).collect()
    assert len(got) == 18 and all(math.isfinite(r.whitened) and r.identity_error < 1e-4 for r in got)
    assert all(r.deviation is None for r in got)


@pytest.mark.parametrize("values", [np.linspace(1, 2, 90), 1 / np.arange(1, 91) ** 2, np.repeat([3.0, 2.0, 1.0], 30),
                                    np.r_[[9.0, 8.0], np.zeros(88)]])
def test_solver_against_dense(values):
    u = np.linalg.qr(np.random.default_rng(3).standard_normal((90, 90)))[0]
    m = (u * values) @ u.T
    m = (m + m.T) / 2
    e, x = W.leading(lambda w: m @ w, 90, 12, np.trace(m))
    assert np.abs(e - np.sort(np.linalg.eigvalsh(m))[::-1][:12]).max() < 1e-13 * values.max()
    assert np.linalg.norm(m @ x - x * e, axis=0).max() < 1e-12 * values.max()
    assert np.abs(x.T @ x - np.eye(12)).max() < 1e-12
