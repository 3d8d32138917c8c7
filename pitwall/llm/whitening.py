"""Whitening of embeddings by block Jacobi-Davidson.

The covariance ``V`` of all vectors is never formed: the solver only asks for ``V W`` of a few
columns ``W``, and each such product is one Spark pass over the vectors, which are centred
before they are multiplied (``centre (centre' W) / n``, summed over tasks in a fixed tree).

1. *Subspace.* Rayleigh-Ritz in an orthonormal basis gives Ritz pairs; those whose residual has
   reached double precision are locked, from the top.
2. *Correction.* For each wanted pair that is not yet there, the projected equation
   ``(I - U U')(V - theta)(I - U U') t = -r`` is solved roughly by MINRES, ``U`` being the locked
   and the wanted Ritz vectors.  All equations of a round advance together: a MINRES step is
   one product, whatever their number.
3. The corrections extend the basis; a basis that has grown to ``GROWN`` blocks is shrunk to its best
   Ritz vectors.

What the driver holds are the basis and the products, ``dimensions x columns`` each; nothing
there grows with the number of vectors.

Entries are first taken to integers (``floor(64 c) + 1000000``), so sums and squared deviations are
exact integers.  An entry is kept apart from its dimension's mean by an integer base and a
fraction, so centring loses no digits.

Defined cases: vectors that are null, or hold null, NaN or infinite entries, are left out; so are
vectors of another length than the most frequent one (the longest of equally frequent), and
vectors without entries.  Entries beyond +-2^55 / 64 count as that.  Ids may be null or repeated:
each row is whitened for itself.  Components of (nearly) no variance, ``e <= RANK * e1``, can't be whitened and
are not returned, so equal vectors, a single one or an empty table give no rows.  A squared deviation
beyond a long is null.  Of equal eigenvalues, any orthonormal vectors of their space are
components.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.common import save, ship, table

COMPONENTS = 32
#: Columns of the first basis beyond the wanted ones.
GUARD = 8
#: Steps of an inner MINRES, and the share of its residual at which it ends.
STEPS, INNER = 8, 1e-4
#: Blocks of wanted columns that the basis may grow to.
GROWN = 4
ROUNDS = 200
#: Residuals at which a pair is locked, against the largest eigenvalue, times sqrt(dimensions).
LOCK = 16 * np.finfo(float).eps
RANK = 1e-11
SCALE, SHIFT = 64, 1_000_000
_LIMIT = 1 << 55
#: Bytes of one packed block of vectors, and partial sums that reach the driver at once.
_BLOCK, _FAN = 1 << 21, 32
_SEED = 5


class Fit(NamedTuple):
    """Components of the vectors' covariance: ``vectors`` are columns, ``values`` fall."""

    n: int
    sums: list
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


# --- vectors as packed blocks ------------------------------------------------------------


def _usable(embeddings: DataFrame, vector: str, key: str) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return embeddings.select(F.col(key).cast("long").alias("id"), v.alias("v")).where(
        F.col("v").isNotNull() & (F.size("v") > 0) & ~F.coalesce(bad, F.lit(False)))


def _pack(batches):
    """``(ids, x)`` of up to a block of vectors a row; ``x`` are 64-bit integers, row by row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        v = batch.column("v")
        flat = np.asarray(v.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
        wide = len(flat) // batch.num_rows
        x = np.clip(np.floor(flat * SCALE), -_LIMIT, _LIMIT).astype(np.int64).reshape(-1, wide) + SHIFT
        step = max(1, _BLOCK // (8 * wide))
        for at in range(0, len(x), step):
            part = x[at:at + step]
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column("id").slice(at, step).to_pylist()], pa.list_(pa.int64())),
                 pa.array([part.tobytes()], pa.binary())], ["ids", "x"])


def packed(embeddings: DataFrame, vector: str = "embedding", key: str = "vec_id") -> tuple[DataFrame, int]:
    """Usable vectors as written blocks, and their dimension (0: there are none)."""
    ship()
    usable = _usable(embeddings, vector, key)
    lengths = usable.groupBy(F.size("v").alias("wide")).count().orderBy(F.desc("count"), F.desc("wide")).first()
    wide = lengths["wide"] if lengths else 0
    blocks = usable.where(F.size("v") == wide).mapInArrow(_pack, "ids array<bigint>, x binary")
    return save(blocks, "vectors"), wide


# --- sums over all blocks ----------------------------------------------------------------


def _total(blocks: DataFrame, part: Callable, shape: tuple) -> np.ndarray:
    """Sum of ``part(x)`` (float64 of ``shape``) over all blocks: by task, then in a tree whose
    shape and order follow the partitions, until few sums are left for the driver."""
    def tasks(batches):
        from pyspark import TaskContext

        sums = np.zeros(shape)
        for batch in batches:
            for x in batch.column("x"):
                sums += part(np.frombuffer(x.as_buffer(), dtype=np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([sums.tobytes()], pa.binary())],
            ["task", "sums"])

    def merge(group: pa.Table) -> pa.Table:
        group = group.sort_by("task")
        sums = np.zeros(shape)
        for one in group.column("sums"):
            sums += np.frombuffer(one.as_buffer()).reshape(shape)
        return pa.table({"task": pa.array([group.column("task")[0].as_py() // _FAN], pa.int64()),
                         "sums": pa.array([sums.tobytes()], pa.binary())})

    found = blocks.select("x").mapInArrow(tasks, "task bigint, sums binary")
    left = found.rdd.getNumPartitions()
    while left > _FAN:
        found = found.groupBy(F.floor(F.col("task") / _FAN)).applyInArrow(merge, "task bigint, sums binary")
        left = -(-left // _FAN)
    sums = np.zeros(shape)
    for one in found.toArrow().sort_by("task").column("sums"):
        sums += np.frombuffer(one.as_buffer()).reshape(shape)
    return sums


def _counts(blocks: DataFrame, wide: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of their entries (of high and low halves, as longs)."""
    def tasks(batches):
        n, high, low = 0, np.zeros(wide, np.int64), np.zeros(wide, np.int64)
        for batch in batches:
            for x in batch.column("x"):
                x = np.frombuffer(x.as_buffer(), dtype=np.int64).reshape(-1, wide)
                n += len(x)
                high += (x >> 28).sum(axis=0)
                low += (x & ((1 << 28) - 1)).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([n], pa.int64()), pa.array([high.tolist()], pa.list_(pa.int64())),
             pa.array([low.tolist()], pa.list_(pa.int64()))], ["n", "high", "low"])

    parts = blocks.select("x").mapInArrow(tasks, "n bigint, high array<bigint>, low array<bigint>")
    rows = (parts.select("n", F.posexplode(F.arrays_zip("high", "low")).alias("d", "s"))
            .groupBy("d").agg(F.sum("n").alias("n"), F.sum("s.high").alias("high"), F.sum("s.low").alias("low"))
            .orderBy("d").collect())
    return (rows[0]["n"] if rows else 0), [(r["high"] << 28) + r["low"] for r in rows]


def _centre(n: int, sums: list[int]) -> Callable:
    """``x -> x - sums / n`` as doubles: whole numbers are subtracted first, exactly."""
    base = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return lambda x: (x.reshape(-1, len(base)) - base).astype(np.float64) - rest


# --- block Jacobi-Davidson ---------------------------------------------------------------


def _minres(product: Callable, theta: np.ndarray, out: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    """Rough solutions of ``P (V - theta_j) P t_j = rhs_j``, ``P = I - out out'``, by one MINRES
    recurrence a column (Lanczos vectors, Givens rotations); a step is one product."""
    def p(w):
        w = w - out @ (out.T @ w)
        return w - out @ (out.T @ w)

    def unit(w):
        size = np.linalg.norm(w, axis=0)
        return size, np.divide(w, size, out=np.zeros_like(w), where=size > 0)

    beta, v = unit(p(rhs))
    first, v_old = beta.copy(), np.zeros_like(v)
    phi = beta.copy()
    cos, sin = -np.ones_like(beta), np.zeros_like(beta)
    delta, eps = np.zeros_like(beta), np.zeros_like(beta)
    d1, d2, t = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    lanczos = np.zeros_like(beta)
    for _ in range(STEPS):
        if not (phi > INNER * first).any():
            break
        w = p(product(v)) - theta * v - lanczos * v_old
        alpha = (v * w).sum(axis=0)
        lanczos, v_new = unit(p(w - alpha * v))
        # the new column of the tridiagonal matrix, through the last rotation
        d, gamma_bar = cos * delta + sin * alpha, sin * delta - cos * alpha
        eps_now, delta = eps, -cos * lanczos
        eps = sin * lanczos
        gamma = np.hypot(gamma_bar, lanczos)
        safe = gamma > 0
        cos = np.divide(gamma_bar, gamma, out=-np.ones_like(gamma), where=safe)
        sin = np.divide(lanczos, gamma, out=np.zeros_like(gamma), where=safe)
        tau, phi = cos * phi, np.abs(sin * phi) * np.sign(phi)
        step = np.divide(v - d * d1 - eps_now * d2, gamma, out=np.zeros_like(v), where=safe)
        t = t + np.where(safe, tau, 0) * step
        d2, d1, v_old, v = d1, step, v, v_new
    return p(t)


def _orthonormal(new: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The part of ``new`` outside ``basis`` as orthonormal columns; columns that are (nearly) in it go."""
    for _ in range(2):
        new = new - basis @ (basis.T @ new)
        size = np.linalg.norm(new, axis=0)
        new = new[:, size > 1e-300] / size[size > 1e-300]
    if not new.shape[1]:
        return new
    left, size, _ = np.linalg.svd(new, full_matrices=False)
    new = left[:, size > 1e-8]
    new = new - basis @ (basis.T @ new)
    return np.linalg.qr(new)[0]


def leading(product: Callable, wide: int, count: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` greatest eigenvalues of a symmetric matrix, known by ``product`` alone, and their
    vectors.  ``scale`` bounds its norm from above (its trace does)."""
    count = min(count, wide)
    goal = LOCK * np.sqrt(wide)
    start = np.random.default_rng(_SEED).standard_normal((wide, min(wide, count + GUARD)))
    q = np.linalg.qr(start)[0]
    vq = product(q)
    locked, values = np.zeros((wide, 0)), np.zeros(0)
    best, stuck = np.inf, 0
    for _ in range(ROUNDS):
        h = q.T @ vq
        theta, s = np.linalg.eigh((h + h.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        want = min(count - len(values), q.shape[1])
        u, vu = q @ s[:, :want], vq @ s[:, :want]
        r = vu - u * theta[:want]
        r -= locked @ (locked.T @ r)
        size = np.linalg.norm(r, axis=0)
        top = max([*values[:1], theta[0] if len(theta) else 0.0, 0.0])
        if top <= scale * np.finfo(float).eps:
            break
        # summing over many vectors rounds too: pairs that stop improving near that point are there
        stuck = stuck + 1 if size.max() > best / 2 else 0
        best = min(best, size.max())
        there = size <= max(goal, 1e3 * goal if stuck >= 3 else 0) * top
        lock = int(np.argmin(there)) if not there.all() else want
        if lock:
            locked, values = np.hstack([locked, u[:, :lock]]), np.r_[values, theta[:lock]]
            keep = s[:, lock:]
            q, vq = q @ keep, vq @ keep
            u, r, theta, best, stuck = u[:, lock:], r[:, lock:], theta[lock:], np.inf, 0
            want -= lock
        if len(values) == count:
            break
        out = np.hstack([locked, u])
        t = _minres(product, theta[:want], out, -r) if out.shape[1] < wide else r
        if q.shape[1] + want > GROWN * (count + GUARD):
            keep = min(q.shape[1], want + GUARD)
            theta, s = np.linalg.eigh(q.T @ vq)
            q, vq = q @ s[:, ::-1][:, :keep], vq @ s[:, ::-1][:, :keep]
        new = _orthonormal(t, np.hstack([locked, q]))
        if new.shape[1]:
            q, vq = np.hstack([q, new]), np.hstack([vq, product(new)])
        elif q.shape[1]:  # nothing to add: the products are taken afresh
            q = _orthonormal(q, locked)
            vq = product(q)
        else:
            q = _orthonormal(np.random.default_rng(len(values)).standard_normal((wide, count + GUARD)), locked)
            vq = product(q)
    else:
        raise ArithmeticError(f"{count - len(values)} of {count} components did not settle in {ROUNDS} rounds")
    order = np.argsort(-values, kind="stable")
    vectors = locked[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]) if vectors.size else np.ones(0)
    return values[order], vectors * signs


# --- fit and transform -------------------------------------------------------------------


def fit(blocks: DataFrame, wide: int, components: int = COMPONENTS) -> Fit:
    """Leading components of all packed vectors, and how far their whitened covariance is from the identity."""
    n, sums = _counts(blocks, wide)
    if not n:
        return Fit(0, [], np.zeros(0), np.zeros((wide, 0)), 0.0, 0.0)
    centre = _centre(n, sums)
    trace = float(_total(blocks, lambda x: np.square(centre(x)).sum().reshape(1), (1,))[0]) / n

    def product(w: np.ndarray) -> np.ndarray:
        w = np.ascontiguousarray(w)

        def part(x):
            c = centre(x)
            return c.T @ (c @ w)

        return _total(blocks, part, w.shape) / n

    values, vectors = leading(product, wide, components, trace) if trace > 0 else (np.zeros(0), np.zeros((wide, 0)))
    keep = values > RANK * values[0] if len(values) else np.zeros(0, bool)
    values, vectors = values[keep], vectors[:, keep]
    found = Fit(n, sums, values, vectors, trace, 0.0)
    return found._replace(identity_error=_identity_error(blocks, found))


def _identity_error(blocks: DataFrame, found: Fit) -> float:
    k = len(found.values)
    if not k:
        return 0.0
    centre, to = _centre(found.n, found.sums), found.vectors / np.sqrt(found.values)
    mean = _total(blocks, lambda x: (centre(x) @ to).sum(axis=0), (k,)) / found.n

    def part(x):
        y = centre(x) @ to - mean
        return y.T @ y

    return float(np.abs(_total(blocks, part, (k, k)) / found.n - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list:
    """Exact ``sum((n x - sums)^2)`` of each row; None beyond a long."""
    base = [s // n for s in sums]
    off = x - np.array(base, dtype=np.int64)  # n x - sums = n off - rest
    if not len(off):
        return []
    if (n * (int(np.abs(off).max()) + 1)) ** 2 * len(sums) < 1 << 63:
        return np.square(off * n - np.array([s % n for s in sums], dtype=np.int64)).sum(axis=1).tolist()
    rest = np.array([s % n for s in sums], dtype=object)
    exact = (np.square(off.astype(object) * n - rest)).sum(axis=1)
    return [v if v < 1 << 63 else None for v in exact]


def transform(blocks: DataFrame, found: Fit) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for each packed
    vector and component."""
    schema = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double")
    k, wide = len(found.values), len(found.sums)
    if not k:
        return blocks.sparkSession.createDataFrame([], schema)
    centre, to = _centre(found.n, found.sums), found.vectors / np.sqrt(found.values)
    explained = found.values / found.trace

    def rows(batches):
        for batch in batches:
            for ids, x in zip(batch.column("ids"), batch.column("x")):
                x = np.frombuffer(x.as_buffer(), dtype=np.int64).reshape(-1, wide)
                size = len(x) * k
                each = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays([
                    ids.values.take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(size, found.n)),
                    pa.array(_deviations(x, found.n, found.sums), pa.int64()).take(pa.array(each)),
                    pa.array((centre(x) @ to).reshape(-1)),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(size, found.identity_error)),
                ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return blocks.mapInArrow(rows, schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks, wide = packed(table(spark, sf_dir, "embeddings"))
    return transform(blocks, fit(blocks, wide))
