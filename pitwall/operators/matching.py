"""Map matching and distance-aligned lap traces.

Map matching is an exact nearest-neighbour search done as equi-joins on grid
cells.  For cell size ``c`` every track point is listed under the 3x3 cells around
its own, grouped per cell into a candidate array; a sample looks up its cell and
takes ``array_min`` of ``(d^2, idx)`` over the candidates.  Any point within ``c``
of the sample is in that neighbourhood, so a best distance ``<= c`` is the global
nearest (ties: lowest idx).  Samples farther out fall through to coarser grids
(``c * growth``).  Samples beyond all grids (farther off than the track is wide) search a
two-level tree of the track: stretches of about sqrt(N) consecutive points with their
bounding boxes.  The least upper bound over the boxes rules out every stretch whose lower bound
exceeds it, and only the points of the others are measured.  The answer is always exact.

All levels are broadcast hash joins against tables whose size depends on the track
resolution only; that size is checked before broadcasting, and beyond the limit the
same joins run as shuffle joins.  No stage shuffles the samples when broadcasting.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.functions import channels as ch
from pitwall.functions.ordered import SCAN_CHUNK, Scan, Segment, ordered_scan, segmented_scan
from pitwall.operators.laps import lap_boundaries
from pitwall.operators.track import speed_profile, track_geometry

CELL_M = 10.0
GROWTH = 8.0
# Broadcast the candidate tables only while their total entries stay below this.
MAX_BROADCAST_ENTRIES = 1_000_000
# Copies of a track's tree that far samples are dealt to where it is too large to broadcast.
TREE_SALTS = 32
GAP_LIMIT = 500
# Track points of a lap that are painted at a time, and samples of a batch.
TRACE_BLOCK = 512
TRACE_ROWS = 10_000
ROUND = 6


def _track_stats(points: DataFrame) -> tuple[float, int]:
    """Largest bounding-box side over tracks and the total point count (one row)."""
    r = points.groupBy("track_id").agg(
        F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("ext"),
        F.count(F.lit(1)).alias("n"),
    ).agg(F.max("ext").alias("ext"), F.sum("n").alias("n")).first()
    return float(r["ext"] or 0.0), int(r["n"] or 0)


def cell_levels(extent: float, cell_m: float = CELL_M, growth: float = GROWTH) -> list[float]:
    levels = [cell_m]
    while levels[-1] < extent:
        levels.append(levels[-1] * growth)
    return levels


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / F.lit(size)).cast("long")


def candidate_table(points: DataFrame, size: float) -> DataFrame:
    """Candidate lists ``track_id, cx, cy, cands`` for one grid level.

    Every point is listed under the 3x3 cells around its own.  Bounded by the track
    resolution: 9 entries per point.
    """
    offs = F.expr("array(" + ", ".join(
        f"named_struct('dx', {dx}, 'dy', {dy})" for dx in (-1, 0, 1) for dy in (-1, 0, 1)) + ")")
    p = points.select(
        "track_id", _cell(F.col("x"), size).alias("_cx"), _cell(F.col("y"), size).alias("_cy"),
        F.struct("idx", "x", "y").alias("pt"), F.explode(offs).alias("o"),
    )
    return p.groupBy(
        "track_id", (F.col("_cx") + F.col("o.dx")).alias("cx"), (F.col("_cy") + F.col("o.dy")).alias("cy")
    ).agg(F.collect_list("pt").alias("cands"))


def stretch_tree(points: DataFrame) -> DataFrame:
    """``track_id, stretches``: a track's points in stretches of about sqrt(N) consecutive ones, each with its
    bounding box ``x0, x1, y0, y1`` and its points ``pts``."""
    n = points.groupBy("track_id").agg(F.greatest(F.ceil(F.sqrt(F.count(F.lit(1)))), F.lit(1)).alias("_b"))
    boxes = points.join(n, "track_id").groupBy("track_id", F.floor(F.col("idx") / F.col("_b")).alias("_s")).agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"),
        F.collect_list(F.struct("idx", "x", "y")).alias("pts"))
    return boxes.groupBy("track_id").agg(F.collect_list(F.struct("x0", "x1", "y0", "y1", "pts")).alias("stretches"))


def candidates_by_bounds(stretches: Column, x: Column, y: Column) -> Column:
    """Points of the stretches whose box can hold the nearest one."""
    zero = F.lit(0.0)

    def lower(b):
        dx = F.greatest(b["x0"] - x, x - b["x1"], zero)
        dy = F.greatest(b["y0"] - y, y - b["y1"], zero)
        return dx * dx + dy * dy

    def upper(b):
        dx = F.greatest(F.abs(b["x0"] - x), F.abs(b["x1"] - x))
        dy = F.greatest(F.abs(b["y0"] - y), F.abs(b["y1"] - y))
        return dx * dx + dy * dy

    def open_(least):  # a bound is rounded like a distance: a hair more keeps the nearest in
        return F.flatten(F.transform(F.filter(stretches, lambda b: lower(b) <= least * (1 + 1e-12)), lambda b: b["pts"]))

    return F.element_at(F.transform(F.array(F.array_min(F.transform(stretches, upper))), open_), 1)


def _nearest(cands: Column, x: Column, y: Column) -> Column:
    def d(p):
        ddx, ddy = p["x"] - x, p["y"] - y
        return F.struct((ddx * ddx + ddy * ddy).alias("d2"), p["idx"].alias("idx"))

    return F.array_min(F.transform(cands, d))


def map_match(samples: DataFrame, points: DataFrame, cell_m: float = CELL_M, growth: float = GROWTH,
              max_broadcast_entries: int = MAX_BROADCAST_ENTRIES, missing_as_zero: bool = False) -> DataFrame:
    """Nearest track point for every sample with a position.

    Adds ``idx`` and ``match_dist_m`` to ``samples`` (which need ``track_id, x, y``).
    Samples without a position (missing or NaN) have no place on the track and are dropped;
    with ``missing_as_zero`` a missing coordinate counts as 0 instead, as on a display that
    shows what it has, and only NaN is dropped.
    """
    if missing_as_zero:
        samples = samples.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("x", "y")})
    pts = points.select("track_id", "idx", "x", "y")
    extent, n_points = _track_stats(pts)
    levels = cell_levels(extent, cell_m, growth)
    entries = n_points * (9 * len(levels) + 1)
    bc = (lambda df: F.broadcast(df)) if entries <= max_broadcast_entries else (lambda df: df)

    placed = [F.col(c).isNotNull() & ~F.isnan(c) for c in ("x", "y")]
    d = samples.filter(placed[0] & placed[1]).withColumn(
        "_best", F.lit(None).cast("struct<d2:double,idx:int>")
    )
    x, y = F.col("x"), F.col("y")
    # One pipeline of left joins.  A level's join key is NULL once a sample is
    # matched, so coarser (larger) candidate lists are only fetched for the few
    # samples still unmatched, and each list is reduced to one struct at once.
    for size in levels:
        need = F.col("_best").isNull()
        kx, ky = _cell(x, size), _cell(y, size)
        t = candidate_table(pts, size).select(
            F.col("track_id").alias("_rt"), F.col("cx").alias("_rx"), F.col("cy").alias("_ry"),
            F.col("cands").alias("_c"),
        )
        d = d.withColumns({"_lt": F.when(need, F.col("track_id")), "_lx": F.when(need, kx),
                           "_ly": F.when(need, ky)})
        cond = (F.col("_lt") == F.col("_rt")) & (F.col("_lx") == F.col("_rx")) & (F.col("_ly") == F.col("_ry"))
        d = d.join(bc(t), cond, "left")
        d = d.withColumn("_b", _nearest(F.col("_c"), x, y))
        ok = F.col("_b").isNotNull() & (F.col("_b.d2") <= F.lit(size * size))
        d = d.withColumn("_best", F.when(need & ok, F.col("_b")).otherwise(F.col("_best")))
        d = d.drop("_b", "_c", "_lt", "_lx", "_ly", "_rt", "_rx", "_ry")
    salts = 1 if entries <= max_broadcast_entries else TREE_SALTS
    tree = stretch_tree(pts).select(F.col("track_id").alias("_rt"), "stretches",
                                    F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_rs"))
    need = F.col("_best").isNull()
    d = d.withColumns({"_lt": F.when(need, F.col("track_id")),
                       "_ls": F.when(need, F.lit(0) if salts == 1 else F.floor(F.rand(7) * salts).cast("int"))})
    d = d.join(bc(tree), (F.col("_lt") == F.col("_rt")) & (F.col("_ls") == F.col("_rs")), "left")
    far = _nearest(candidates_by_bounds(F.col("stretches"), x, y), x, y)
    d = d.withColumn("_best", F.coalesce("_best", F.when(F.col("stretches").isNotNull(), far)))
    d = d.drop("_lt", "_ls", "_rt", "_rs", "stretches")
    return d.filter(F.col("_best").isNotNull()).withColumn("idx", F.col("_best.idx")).withColumn(
        "match_dist_m", F.sqrt(F.col("_best.d2"))
    ).drop("_best")


def bounded(dimension: DataFrame, limit: int = MAX_BROADCAST_ENTRIES) -> DataFrame:
    """A per-point or per-track table with a broadcast hint if a count finds it small enough;
    a larger one joins by shuffle."""
    return F.broadcast(dimension) if dimension.count() <= limit else dimension


def with_track_distance(matched: DataFrame, geometry: DataFrame) -> DataFrame:
    """Join track attributes by (track_id, idx)."""
    g = geometry.select("track_id", "idx", "s", "curvature", F.col("sector_name").alias("track_sector"))
    return matched.join(bounded(g), ["track_id", "idx"], "left")


def centreline(matched: DataFrame, bucket: int = 10) -> DataFrame:
    """Track reference rebuilt from logged laps: mean position per bucket of matched points.

    Output ``track_id, pos, x, y, samples`` (one waypoint per non-empty bucket, in
    track order); a mergeable aggregate, so a hot track is combined map-side.  Sums
    are taken in fixed point (integer micrometres), so the mean does not depend on
    the order in which partial sums are combined.
    """
    um = lambda c: F.round(F.col(c) * F.lit(1e6)).cast("long")
    return matched.groupBy("track_id", F.floor(F.col("idx") / bucket).cast("int").alias("pos")).agg(
        (F.sum(um("x")) / F.count(F.lit(1)) / F.lit(1e6)).alias("x"),
        (F.sum(um("y")) / F.count(F.lit(1)) / F.lit(1e6)).alias("y"),
        F.count(F.lit(1)).alias("samples"),
    )


def laps_from_position(matched: DataFrame, n_points: DataFrame, max_dt: float = 0.1,
                       chunk_width: int = SCAN_CHUNK) -> DataFrame:
    """A lap ends when the track index wraps (drops by more than half the track).

    ``n_points`` is a per-track table ``track_id, n_points``.  ``pos_lap`` counts
    wraps; ``pos_lap_time`` restarts at each wrap with that sample's ``dt``.  Wrap, lap and lap
    time come from one segmented scan.
    """
    d = matched.join(bounded(n_points), "track_id").withColumn("_us", F.unix_micros("event_time"))
    dt = F.when(F.col("_prev_us").isNull(), F.lit(0.0)).otherwise(
        F.least((F.col("_us") - F.col("_prev_us")) / F.lit(1e6), F.lit(max_dt))
    )
    wrap = F.coalesce(F.col("idx") < F.col("_prev_idx") - F.col("n_points") / 2, F.lit(False))
    out = segmented_scan(
        d.select("car_id", "seq", "idx", "_us", "n_points"), ["car_id"], ["seq"],
        {"_prev_idx": F.col("idx"), "_prev_us": F.col("_us")},
        [Segment("pos_lap", wrap.cast("long")), Segment("_lap_time", dt, wrap)],
        chunk_by="seq", chunk_width=chunk_width)
    return out.select("car_id", "seq", "idx", "pos_lap", F.round("_lap_time", ROUND).alias("pos_lap_time"))


def drs_channels(matched: DataFrame, geometry: DataFrame) -> DataFrame:
    """C5 + C4 + C6 after J3: DRS flag, drag with the matching Cd, lateral g."""
    d = with_track_distance(matched, geometry)
    v = ch.kmh_to_ms("speed_kmh")
    drs = F.coalesce(ch.drs_active("lap_count", "curvature", "speed_kmh"), F.lit(False))
    return d.select(
        "car_id", "seq", "idx",
        F.round("curvature", 9).alias("curvature"),
        drs.alias("drs_active"),
        F.round(ch.aero_force(v, ch.drag_coefficient(drs)), ROUND).alias("drag_n"),
        F.round(ch.lateral_g(v, F.col("curvature")), ROUND).alias("lateral_g"),
    )


def pace(matched: DataFrame, profile: DataFrame) -> DataFrame:
    """Driver state against the braking-limited target speed at the matched point."""
    p = profile.select("track_id", "idx", "target_speed_ms")
    d = matched.join(bounded(p), ["track_id", "idx"], "left")
    return d.select(
        "car_id", "seq", "idx",
        F.round(ch.ms_to_kmh("target_speed_ms"), ROUND).alias("target_speed_kmh"),
        ch.pace_state(ch.kmh_to_ms("speed_kmh"), F.col("target_speed_ms")).alias("pace_state"),
    )


def matched_laps(samples: DataFrame, points: DataFrame, chunk_width: int = SCAN_CHUNK, **kw) -> DataFrame:
    """Matched samples with the effective lap of H1 from *all* packets: one without a position
    has no place on the track but may be the one that begins a lap."""
    return map_match(lap_boundaries(samples, chunk_width), points, **kw)


def _trace_cells(matched: DataFrame, gap_limit: int, chunk_width: int) -> DataFrame:
    """Cells painted by each sample of ``matched_laps``: ``car_id, lap_count (effective), seq,
    lo, hi`` + values.  The effective lap never falls within a car, so one scan by car gives
    the sample before and tells whether it is of the same lap."""
    if "effective_lap" not in matched.columns:  # every packet has a position, as far as the caller knows
        matched = lap_boundaries(matched, chunk_width)
    b = matched.select("car_id", "seq", "effective_lap", "idx", "speed_kmh", "throttle", "brake")
    d = ordered_scan(b, ["car_id"], ["seq"], [Scan("_prev_idx", "lag", F.col("idx")),
                                              Scan("_prev_lap", "lag", F.col("effective_lap"))],
                     chunk_by="seq", chunk_width=chunk_width)
    near = F.coalesce((F.col("_prev_lap") == F.col("effective_lap"))
                      & (F.abs(F.col("idx") - F.col("_prev_idx")) < gap_limit), F.lit(False))
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))  # missing values paint 0
    return d.select(
        "car_id", F.col("effective_lap").alias("lap_count"), "seq",
        F.when(near, F.least("idx", "_prev_idx")).otherwise(F.col("idx")).alias("lo"),
        F.when(near, F.greatest("idx", "_prev_idx")).otherwise(F.col("idx")).alias("hi"),
        z("speed_kmh").alias("speed_kmh"), z("throttle").alias("throttle"), z("brake").alias("brake"),
    )


def _ship_by_value() -> None:
    """Pickle this module's functions by value, so Python workers need not import pitwall."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _painted(keys: list[str], block: int, batch_rows: int):
    """For ``mapInArrow`` over rows sorted by ``keys`` and sequence: paints each row's points ``lo..hi`` of
    its block, a later row over earlier ones, and gives the runs of points that show one row.

    ``role`` 0 is the lap itself, 1 its ghost; ``ghost_speed_kmh`` of a run is that of the ghost's
    row there.  A group that goes on in the next batch is carried as its runs, at most ``block`` a role.
    """

    def paint(rows: pa.Table, role: int, group: np.ndarray, groups: int) -> np.ndarray:
        mine = np.flatnonzero(rows["role"].to_numpy() == role)
        lo, hi = rows["lo"].to_numpy()[mine], rows["hi"].to_numpy()[mine]
        size = hi - lo + 1
        ends = np.cumsum(size)
        at = np.repeat(group[mine] * block + lo % block - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        shown = np.full(groups * block, -1, np.int64)
        shown[at] = np.repeat(mine, size)
        return shown

    def runs(*sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last cell of each run in which no side changes."""
        new = np.zeros(len(sides[0]), bool)
        new[::block] = True
        for s in sides:
            new[1:] |= s[1:] != s[:-1]
        first = np.flatnonzero(new)
        return first, np.r_[first[1:], len(new)] - 1

    def cut(rows: pa.Table, shown: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.Table:
        """The rows shown in the runs, with the runs' points."""
        keep = shown[first] >= 0
        first, last = first[keep], last[keep]
        found = rows.take(pa.array(shown[first]))
        start = found["_block"].to_numpy() * block
        for name, cell in (("lo", first), ("hi", last)):
            at = found.schema.get_field_index(name)
            found = found.set_column(at, found.schema.field(at), pa.array(start + cell % block))
        return found

    def closed(rows: pa.Table, own: np.ndarray, ghost: np.ndarray) -> list[pa.RecordBatch]:
        first, last = runs(own, ghost)
        keep = own[first] >= 0
        beside = ghost[first[keep]]
        speed = rows["speed_kmh"].combine_chunks().take(pa.array(beside, mask=beside < 0))
        out = cut(rows, own, first, last)
        at = out.schema.get_field_index("ghost_speed_kmh")
        return out.set_column(at, out.schema.field(at), speed).to_batches()

    def run(batches):
        held = None
        for whole in batches:
            for at in range(0, whole.num_rows, batch_rows):
                rows = pa.Table.from_batches([whole.slice(at, batch_rows)])
                if held is not None:
                    rows = pa.concat_tables([held, rows])
                new = np.zeros(rows.num_rows, bool)
                for k in keys:
                    codes = rows[k].combine_chunks().dictionary_encode("encode").indices.to_numpy()
                    new[1:] |= codes[1:] != codes[:-1]
                group = np.cumsum(new)
                n = int(group[-1]) + 1
                own, ghost = paint(rows, 0, group, n), paint(rows, 1, group, n)
                done = (n - 1) * block
                if done:
                    yield from closed(rows, own[:done], ghost[:done])
                held = pa.concat_tables([cut(rows, s[done:], *runs(s[done:])) for s in (own, ghost)])
        if held is not None and held.num_rows:
            own, ghost = (paint(held, role, np.zeros(held.num_rows, np.int64), 1) for role in (0, 1))
            yield from closed(held, own, ghost)

    return run


def _trace_runs(cells: DataFrame, block: int, batch_rows: int) -> DataFrame:
    """Disjoint runs ``lo..hi`` of each (car, lap) with the values that show there.

    ``cells`` are shuffled as they are, one row for each block of track points that a sample paints in; the
    points themselves never are.  A task holds a batch and one block of a lap, whatever a lap's samples.
    """
    _ship_by_value()
    keys = ["car_id", "lap_count", "_block"]
    d = cells.withColumns({"lo": F.col("lo").cast("long"), "hi": F.col("hi").cast("long")}).withColumn(
        "_block", F.explode(F.sequence(F.floor(F.col("lo") / block), F.floor(F.col("hi") / block))))
    d = d.withColumns({"lo": F.greatest("lo", F.col("_block") * block),
                       "hi": F.least("hi", F.col("_block") * block + (block - 1)),
                       "ghost_speed_kmh": F.lit(None).cast("double")})
    # a row's lap is found in the shuffle, its place in the lap by the sort
    d = d.repartition(*keys).sortWithinPartitions(*keys, "seq")
    return d.mapInArrow(_painted(keys, block, batch_rows), d.schema)


def _points_of_runs(runs: DataFrame) -> DataFrame:
    return runs.withColumn("idx", F.explode(F.sequence(F.col("lo").cast("int"), F.col("hi").cast("int"))))


def lap_trace(matched: DataFrame, gap_limit: int = GAP_LIMIT, chunk_width: int = SCAN_CHUNK,
              block: int = TRACE_BLOCK, batch_rows: int = TRACE_ROWS) -> DataFrame:
    """Distance-aligned trace per (car, lap): idx -> speed, throttle, brake.

    Within a lap (effective lap of H1), a sample less than ``gap_limit`` points from
    the previous one paints every index between them with its values, otherwise only
    its own; a later sample overwrites an earlier one.  Samples are shuffled, not the points that they
    paint: those are listed last, where they leave the task.
    """
    c = _trace_cells(matched, gap_limit, chunk_width).withColumn("role", F.lit(0))
    return _points_of_runs(_trace_runs(c, block, batch_rows)).select(
        "car_id", "lap_count", "idx", "speed_kmh", "throttle", "brake")


def lap_trace_vs_ghost(matched: DataFrame, gap_limit: int = GAP_LIMIT, chunk_width: int = SCAN_CHUNK,
                       lap_chunk: int = 4096, block: int = TRACE_BLOCK, batch_rows: int = TRACE_ROWS) -> DataFrame:
    """H5 + J5: each lap's trace next to the previous lap's (the ghost), by idx.

    One pass: every sample goes to its own lap and, as ghost, to the car's next lap; both are painted
    side by side, block by block of the track.  No self-join of traces, no shuffle of points.
    """
    cells = _trace_cells(matched, gap_limit, chunk_width).drop("throttle", "brake")
    laps = cells.select("car_id", "lap_count").distinct()
    # lap-level (one row per car and lap): previous lap of every lap
    prev = ordered_scan(laps, ["car_id"], ["lap_count"], [Scan("ghost_lap", "lag", F.col("lap_count"))],
                        chunk_by="lap_count", chunk_width=lap_chunk)
    feeds = prev.filter(F.col("ghost_lap").isNotNull()).select(
        "car_id", F.col("ghost_lap").alias("lap_count"), F.col("lap_count").alias("_to"))
    roles = cells.join(prev, ["car_id", "lap_count"], "left").join(feeds, ["car_id", "lap_count"], "left")
    tagged = roles.select(
        "car_id", "seq", "lo", "hi", "speed_kmh",
        F.explode(F.array(
            F.struct(F.col("lap_count").alias("lap"), F.lit(0).alias("role"), F.col("ghost_lap").alias("ghost_lap")),
            F.struct(F.col("_to").alias("lap"), F.lit(1).alias("role"), F.col("lap_count").alias("ghost_lap")),
        )).alias("t"),
    ).filter(F.col("t.lap").isNotNull()).select(
        "car_id", F.col("t.lap").alias("lap_count"), "seq", "lo", "hi", F.col("t.role").alias("role"),
        F.col("t.ghost_lap").alias("ghost_lap"), "speed_kmh")
    return _points_of_runs(_trace_runs(tagged, block, batch_rows)).select(
        "car_id", "lap_count", "idx", "speed_kmh", "ghost_lap", "ghost_speed_kmh",
        (F.col("speed_kmh") - F.col("ghost_speed_kmh")).alias("speed_delta"),
    )


def fixture_profile(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    geo = track_geometry(points)
    return geo, speed_profile(geo)
