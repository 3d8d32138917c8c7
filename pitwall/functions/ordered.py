"""Skew-safe ordered scans (running max/min/sum, last non-null, lag) per key.

A window partitioned only by car puts a car's whole history into one task; a car
holding a third of all rows would then be one task over a third of the data.
``ordered_scan`` splits every key's history into chunks of the chunk column
(``chunk_width`` units, monotone in the order), runs the window inside
``(keys, chunk)`` and adds the carry of all earlier chunks, which is computed on the
per-chunk totals (rows / chunk rows, a much smaller table).  This is a two-level
prefix scan: every task sees at most one chunk of one key.

Totals are read off each chunk's last row of the window output, which is already
hash-partitioned by ``(keys, chunk)``: the input is scanned and shuffled once and the
window is evaluated twice over the same shuffle files.  Only the small carry table moves
(AQE broadcasts it at run time when its measured size allows).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Chunk width in units of the chunk column. For a per-car packet counter at 100 Hz
# this is about eleven minutes of driving per task.
SCAN_CHUNK = 1 << 16

KINDS = ("max", "min", "sum", "last", "lag", "min_before", "max_before")


@dataclass(frozen=True)
class Scan:
    """One output column: ``name`` = running ``kind`` of ``expr`` in scan order.

    kinds: ``max``/``min``/``sum`` running and inclusive; ``last`` last non-null value
    so far (inclusive); ``lag`` value of the previous row of the key (NULL on the
    first); ``min_before``/``max_before`` extreme over all earlier rows (exclusive).
    """

    name: str
    kind: str
    expr: Column

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown scan kind {self.kind!r}")


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def ordered_scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    scans: list[Scan] | list[list[Scan]],
    chunk_by: str | None = None,
    chunk_width: int | None = SCAN_CHUNK,
) -> DataFrame:
    """Add one column per ``Scan``; rows are ordered by ``order`` within ``keys``.

    ``scans`` may be a list of stages (lists); a stage can use the columns of the
    stages before it.  All stages share one chunking, so later stages reuse the
    partitioning of the first and add no shuffle of the full data.

    ``chunk_by`` must be a numeric column non-decreasing in ``order`` (e.g. the
    packet sequence or event-time micros).  With ``chunk_by=None`` the window is
    partitioned by ``keys`` alone; use that only where a key is bounded by
    construction (a track's points).  With chunks, rows with a null key or a null
    ``chunk_by`` have no place in any order and are left out.
    """
    stages = scans if scans and isinstance(scans[0], list) else [scans]
    if chunk_by is None or chunk_width is None:
        w = Window.partitionBy(*keys).orderBy(*_cols(order))
        run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        out = df
        for stage in stages:
            out = out.withColumns({s.name: _local(s, w, run, before) for s in stage})
        return out

    ck, rn = "_scan_chunk", "_scan_rn"
    w = Window.partitionBy(*keys, ck).orderBy(*_cols(order))
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    wc = Window.partitionBy(*keys).orderBy(ck)
    earlier = wc.rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumn(ck, F.floor(F.col(chunk_by) / F.lit(chunk_width)).cast("long"))
    # rows without a key or a place in the order; said here, so that the join below adds no
    # filter to one branch only
    for c in (*keys, ck):
        out = out.filter(F.col(c).isNotNull())
    out = out.withColumn(rn, F.row_number().over(w))
    for stage in stages:
        local = out.withColumns({f"_loc_{s.name}": _local(s, w, run, before) for s in stage})
        # The chunk's last row whole: both branches then need the same columns of the input,
        # so its scan and its shuffle are shared (ReuseExchange) instead of run twice.
        last = F.max_by(F.struct(*[c for c in local.columns if c not in (*keys, ck)],
                                 *[s.expr.alias(f"_exp_{s.name}") for s in stage]), F.col(rn))
        totals = local.groupBy(*keys, ck).agg(last.alias("_last"))
        totals = totals.select(*keys, ck, *[_total(s).alias(f"_tot_{s.name}") for s in stage])
        carry = totals.select(*keys, ck, *[_carry(s, wc, earlier).alias(f"_car_{s.name}") for s in stage])
        out = local.join(carry, [*keys, ck], "left")
        out = out.withColumns(
            {s.name: _combine(s, F.col(f"_car_{s.name}"), F.col(f"_loc_{s.name}"), F.col(rn)) for s in stage}
        )
        out = out.drop(*[f"_{kind}_{s.name}" for s in stage for kind in ("loc", "car")])
    return out.drop(ck, rn)


def _local(s: Scan, w, run, before) -> Column:
    e = s.expr
    if s.kind == "max":
        return F.max(e).over(run)
    if s.kind == "min":
        return F.min(e).over(run)
    if s.kind == "sum":
        return F.sum(e).over(run)
    if s.kind == "last":
        return F.last(e, ignorenulls=True).over(run)
    if s.kind == "lag":
        return F.lag(e, 1).over(w)
    if s.kind == "max_before":
        return F.max(e).over(before)
    return F.min(e).over(before)  # min_before


def _total(s: Scan) -> Column:
    """Chunk total read off the window output at the chunk's last row."""
    loc, expr = F.col(f"_last._loc_{s.name}"), F.col(f"_last._exp_{s.name}")
    if s.kind in ("max", "min", "sum", "last"):
        return loc
    if s.kind == "max_before":
        return F.greatest(loc, expr)
    if s.kind == "min_before":
        return F.least(loc, expr)
    return expr  # lag: value of the chunk's last row


def _carry(s: Scan, wc, earlier) -> Column:
    t = F.col(f"_tot_{s.name}")
    if s.kind in ("max", "max_before"):
        return F.max(t).over(earlier)
    if s.kind in ("min", "min_before"):
        return F.min(t).over(earlier)
    if s.kind == "sum":
        return F.sum(t).over(earlier)
    if s.kind == "last":
        return F.last(t, ignorenulls=True).over(earlier)
    return F.lag(t, 1).over(wc)  # lag: last row of the previous non-empty chunk


def _combine(s: Scan, carry: Column, local: Column, rn: Column) -> Column:
    if s.kind in ("max", "max_before"):
        return F.greatest(carry, local)
    if s.kind in ("min", "min_before"):
        return F.least(carry, local)
    if s.kind == "sum":
        return F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(carry + local)
    if s.kind == "last":
        return F.coalesce(local, carry)
    return F.when(rn == 1, carry).otherwise(local)  # lag


# ------------------------------------------------------------- segmented sums in one pass


@dataclass(frozen=True)
class Segment:
    """One output column: running sum of ``value`` in scan order that starts anew at rows where
    ``reset`` holds (such a row's value is the first of its segment; no ``reset``: one segment).

    Both may use the columns named in ``lags`` of ``segmented_scan``.  Null values add nothing
    and a null ``reset`` is no reset.
    """

    name: str
    value: Column
    reset: Column | None = None


def segmented_scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    lags: dict[str, Column],
    segments: list[Segment],
    chunk_by: str,
    chunk_width: int = SCAN_CHUNK,
) -> DataFrame:
    """Add the previous row's values (``lags``) and segmented running sums that may depend on them.

    ``(sum, reset)`` pairs combine associatively: ``(a, r) + (b, s) = (b if s else a + b, r or s)``.
    So one pass over the chunks does all of it.  Within a chunk the first row's previous row is not
    known, so that row is set aside; the carry table, one row a chunk, knows it from the chunk before,
    evaluates the same expressions there, and scans the chunks' pairs.  The input is shuffled once, whatever the number
    of columns and however they depend on each other's lags.

    ``chunk_by`` as in ``ordered_scan``; rows with a null key or a null ``chunk_by`` are left out.
    """
    ck, rn = "_scan_chunk", "_scan_rn"
    w = Window.partitionBy(*keys, ck).orderBy(*_cols(order))
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.withColumn(ck, F.floor(F.col(chunk_by) / F.lit(chunk_width)).cast("long"))
    for c in (*keys, ck):
        out = out.filter(F.col(c).isNotNull())
    inside = F.col(rn) > 1
    out = out.withColumn(rn, F.row_number().over(w)).withColumns({n: F.lag(e, 1).over(w) for n, e in lags.items()})

    def reset(s: Segment) -> Column:
        return F.coalesce(s.reset, F.lit(False)) if s.reset is not None else F.lit(False)

    def value(s: Segment) -> Column:
        return F.coalesce(s.value, F.lit(0).cast("long"))

    local = out.withColumns({f"_seg_{s.name}": F.sum(F.when(inside & reset(s), 1).otherwise(0)).over(run)
                             for s in segments})
    for s in segments:
        # the same hash partitioning serves: segments lie within chunks
        part = Window.partitionBy(*keys, ck, f"_seg_{s.name}").orderBy(*_cols(order))
        part = part.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local = local.withColumn(f"_loc_{s.name}", F.sum(F.when(inside, value(s))).over(part))
    # both branches read the same columns, so scan and shuffle of the input are shared
    columns = [c for c in local.columns if c not in (*keys, ck)]
    row = F.struct(*columns, *[e.alias(f"_raw_{n}") for n, e in lags.items()])
    totals = local.groupBy(*keys, ck).agg(F.min_by(row, F.col(rn)).alias("_first"), F.max_by(row, F.col(rn)).alias("_last"))

    wc = Window.partitionBy(*keys).orderBy(ck)
    upto = wc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a chunk's first row as a row again, its previous row's values from the chunk before
    carry = totals.select(
        *keys, ck, "_last", *[F.col(f"_first.{c}").alias(c) for c in df.columns if c not in keys],
        *[F.lag(F.col(f"_last._raw_{n}"), 1).over(wc).alias(n) for n in lags])
    for s in segments:
        first_v, first_r = value(s), reset(s)
        rest_v, rest_r = F.coalesce(F.col(f"_last._loc_{s.name}"), F.lit(0)), F.col(f"_last._seg_{s.name}") > 0
        carry = carry.withColumns({
            f"_fv_{s.name}": first_v, f"_fr_{s.name}": first_r,
            f"_tv_{s.name}": F.when(rest_r, rest_v).otherwise(first_v + rest_v),
            f"_grp_{s.name}": F.sum(F.when(first_r | rest_r, 1).otherwise(0)).over(upto)})
    for s in segments:
        group = Window.partitionBy(*keys, f"_grp_{s.name}").orderBy(ck)
        group = group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        carry = carry.withColumn(f"_inc_{s.name}", F.sum(f"_tv_{s.name}").over(group))
    carry = carry.select(
        *keys, ck, *[F.col(n).alias(f"_lag_{n}") for n in lags],
        *[F.when(F.col(f"_fr_{s.name}"), F.col(f"_fv_{s.name}"))
          .otherwise(F.coalesce(F.lag(f"_inc_{s.name}", 1).over(wc), F.lit(0)) + F.col(f"_fv_{s.name}")).alias(f"_base_{s.name}")
          for s in segments])
    out = local.join(carry, [*keys, ck], "left")
    out = out.withColumns({
        **{n: F.when(inside, F.col(n)).otherwise(F.col(f"_lag_{n}")) for n in lags},
        **{s.name: F.when(F.col(f"_seg_{s.name}") > 0, F.col(f"_loc_{s.name}"))
           .otherwise(F.col(f"_base_{s.name}") + F.coalesce(F.col(f"_loc_{s.name}"), F.lit(0))) for s in segments}})
    return out.drop(ck, rn, *[f"_lag_{n}" for n in lags],
                    *[f"_{kind}_{s.name}" for s in segments for kind in ("seg", "loc", "base")])
