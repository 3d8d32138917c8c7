"""Track reference tables: projection, resampling, geometry, target-speed profile.

A track is a bounded dimension (its point count is a resolution parameter, not a
function of the data), so windows here are partitioned by ``track_id`` alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.functions import channels as ch

ROUND = 6
EARTH_RADIUS_M = 6378137.0


def _fixed_mean(c: str, w) -> Column:
    """Mean in fixed point (1e-9 units): exact and independent of summation order.

    A projection multiplies ``lat - mean(lat)`` by ~111 km per degree, so a float
    mean's rounding noise (~1e-10 degrees) would show up as ~1e-5 m in the output.
    """
    q = F.round(F.col(c) * F.lit(1e9)).cast("long")
    return F.sum(q).over(w) / F.count(F.lit(1)).over(w) / F.lit(1e9)


def project_lonlat(waypoints: DataFrame) -> DataFrame:
    """G1: equirectangular projection of ``lon, lat`` about each track's mean position."""
    w = Window.partitionBy("track_id")
    clon, clat = _fixed_mean("lon", w), _fixed_mean("lat", w)
    k = F.lit(math.pi / 180.0 * EARTH_RADIUS_M)
    return waypoints.withColumn("_clon", clon).withColumn("_clat", clat).select(
        "track_id",
        "pos",
        "lon",
        "lat",
        ((F.col("lon") - F.col("_clon")) * k * F.cos(F.radians("_clat"))).alias("x"),
        ((F.col("lat") - F.col("_clat")) * k).alias("y"),
    )


def unproject_xy(points: DataFrame, lon0: float, lat0: float) -> DataFrame:
    """Inverse equirectangular about a fixed origin: ``x, y`` metres to ``lon, lat`` degrees."""
    k = math.pi / 180.0 * EARTH_RADIUS_M
    return points.withColumn("lon", F.lit(lon0) + F.col("x") / F.lit(k * math.cos(math.radians(lat0)))).withColumn(
        "lat", F.lit(lat0) + F.col("y") / F.lit(k)
    )


def resample_closed(waypoints: DataFrame, per_segment: int) -> DataFrame:
    """Closed Catmull-Rom spline through ordered waypoints, ``per_segment`` points each.

    Passes through every waypoint (C1, not the C2 of an interpolating cubic spline).
    Point ``idx = pos * per_segment + j`` at parameter ``t = j / per_segment``.
    """
    w = Window.partitionBy("track_id").orderBy("pos")
    full = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = waypoints.withColumn("_r", F.row_number().over(w) - 1).withColumn("_m", F.count(F.lit(1)).over(full))

    def around(c):
        first, second, last = F.first(c).over(full), F.nth_value(c, 2).over(full), F.last(c).over(full)
        p0 = F.coalesce(F.lag(c, 1).over(w), last)
        p2 = F.coalesce(F.lead(c, 1).over(w), first)
        p3 = F.coalesce(F.lead(c, 2).over(w), F.when(F.col("_r") == F.col("_m") - 2, first).otherwise(second))
        return p0, p2, p3

    for c in ("x", "y"):
        p0, p2, p3 = around(c)
        d = d.withColumn(f"_{c}0", p0).withColumn(f"_{c}2", p2).withColumn(f"_{c}3", p3)
    d = d.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(per_segment - 1))))
    t = F.col("j") / F.lit(float(per_segment))

    def spline(c):
        p0, p1, p2, p3 = F.col(f"_{c}0"), F.col(c), F.col(f"_{c}2"), F.col(f"_{c}3")
        return F.lit(0.5) * (
            F.lit(2.0) * p1
            + (p2 - p0) * t
            + (F.lit(2.0) * p0 - F.lit(5.0) * p1 + F.lit(4.0) * p2 - p3) * t * t
            + (F.lit(3.0) * p1 - p0 - F.lit(3.0) * p2 + p3) * t * t * t
        )

    return d.select(
        "track_id",
        (F.col("_r") * per_segment + F.col("j")).cast("int").alias("idx"),
        spline("x").alias("x"),
        spline("y").alias("y"),
    )


#: Rounds of the cyclic reduction: neighbours' weights fall from 1/2 of the diagonal to below 1e-18.
REDUCTIONS = 6


def spline_closed(waypoints: DataFrame, n_points: int) -> DataFrame:
    """The closed cubic spline (C2) through the waypoints ``track_id, pos, x, y``, parameterised by chord
    length, at ``n_points`` equal steps of the parameter from the first waypoint round to it again.

    Its second derivatives solve a cyclic tridiagonal system, whose diagonal is twice the sum of its neighbours.
    Cyclic reduction eliminates each unknown's neighbours at distance 1, 2, 4, ... for all unknowns of all
    tracks at once; the weights of what is left are squared by each round, so a fixed number of rounds solves
    tracks of any length to double precision.  (A prefix product of the system's transfer matrices would
    overflow: they grow by 3.7 a waypoint.)  A track is one row of arrays meanwhile, bounded by its resolution.

    A waypoint without a position, equal to the one before it, or (the last) equal to the first counts
    for nothing; a track of fewer than three waypoints after that has no curve.  Output ``track_id, idx, x, y, curvature``.
    """
    w = Window.partitionBy("track_id").orderBy("pos")
    full = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = waypoints.select("track_id", "pos", "x", "y").where("x IS NOT NULL AND y IS NOT NULL")
    same = (F.col("x") == F.lag("x").over(w)) & (F.col("y") == F.lag("y").over(w))
    closing = ((F.col("x") == F.first("x").over(full)) & (F.col("y") == F.first("y").over(full))
               & F.lead("pos").over(w).isNull() & F.lag("pos").over(w).isNotNull())
    d = d.withColumn("_out", F.coalesce(same, F.lit(False)) | closing).where("NOT _out")
    g = (d.groupBy("track_id").agg(F.array_sort(F.collect_list(F.struct("pos", "x", "y"))).alias("p"))
         .where(F.size("p") >= 3))

    def each(values, body) -> Column:
        """An array over the waypoints; ``body(at)`` reads the values ``k`` waypoints on by ``at(k)``."""
        n = F.size("p")
        return F.transform(F.sequence(F.lit(0), n - 1), lambda i: body(lambda k: F.get(values, F.pmod(i + k, n))))

    def chord(a, b):
        return F.sqrt((b["x"] - a["x"]) * (b["x"] - a["x"]) + (b["y"] - a["y"]) * (b["y"] - a["y"]))

    def equation(at):
        before, here, after = at(F.lit(-1)), at(F.lit(0)), at(F.lit(1))
        hb, ha = chord(before, here), chord(here, after)
        slope = {c: (after[c] - here[c]) / ha - (here[c] - before[c]) / hb for c in ("x", "y")}
        return F.struct(hb.alias("a"), (F.lit(2.0) * (hb + ha)).alias("b"), ha.alias("c"),
                        *[(F.lit(6.0) * slope[c]).alias(c) for c in ("x", "y")])

    def reduced(at, k):
        low, mid, high = at(-k), at(F.lit(0)), at(k)
        p, q = -mid["a"] / low["b"], -mid["c"] / high["b"]
        return F.struct((p * low["a"]).alias("a"), (mid["b"] + p * low["c"] + q * high["a"]).alias("b"),
                        (q * high["c"]).alias("c"), *[(mid[c] + p * low[c] + q * high[c]).alias(c) for c in ("x", "y")])

    # one-row generators keep each stage's arrays from being worked out again wherever they are read
    g = g.select("track_id", "p", F.explode(F.array(F.aggregate(
        F.array(*[F.lit(1 << r) for r in range(REDUCTIONS)]), each(F.col("p"), equation),
        lambda eq, k: each(eq, lambda at: reduced(at, k))))).alias("m"))

    def segment(at):
        here, after = at(F.lit(0)), at(F.lit(1))
        return F.struct(chord(here["p"], after["p"]).alias("h"),
                        *[z["p"][c].alias(f"{n}{c}") for n, z in (("a", here), ("b", after)) for c in ("x", "y")],
                        *[(z["m"][c] / z["m"]["b"]).alias(f"m{n}{c}") for n, z in (("a", here), ("b", after)) for c in ("x", "y")])

    g = g.select("track_id", "p", F.explode(F.array(F.arrays_zip("p", "m"))).alias("z"))
    g = g.select("track_id", F.posexplode(each(F.col("z"), segment)).alias("i", "s")).select("track_id", "i", "s.*")
    w = Window.partitionBy("track_id").orderBy("i")
    g = g.withColumns({"to": F.sum("h").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
                       "length": F.sum("h").over(Window.partitionBy("track_id")),
                       "end": F.lead("i").over(w).isNull()}).withColumn("u", F.lag("to", 1, 0.0).over(w))
    step = F.col("length") / F.lit(float(n_points - 1))
    first = F.ceil(F.col("u") / step).cast("int")
    # a point on the border belongs to the segment that it begins, the last one to the last segment
    last = F.when(F.col("end"), F.lit(n_points - 1)).otherwise(F.ceil(F.col("to") / step).cast("int") - 1)
    g = g.where(first <= last).withColumn("idx", F.explode(F.sequence(first, last)))
    h, t = F.col("h"), F.col("idx") * step - F.col("u")

    def at(c):
        """Position, first and second derivative."""
        a, b, ma, mb, s = F.col(f"a{c}"), F.col(f"b{c}"), F.col(f"ma{c}"), F.col(f"mb{c}"), h - t
        place = (ma * s * s * s + mb * t * t * t) / (F.lit(6.0) * h) + (a / h - ma * h / 6) * s + (b / h - mb * h / 6) * t
        slope = (mb * t * t - ma * s * s) / (F.lit(2.0) * h) + (b - a) / h - (mb - ma) * h / 6
        return place, slope, (ma * s + mb * t) / h

    (x, dx, ddx), (y, dy, ddy) = at("x"), at("y")
    speed = dx * dx + dy * dy
    return g.select("track_id", F.col("idx").cast("int").alias("idx"), x.alias("x"), y.alias("y"),
                    F.when(speed > 0, F.abs(dx * ddy - dy * ddx) / (speed * F.sqrt(speed))).alias("curvature"))


def resample_even(points: DataFrame, n_points: int) -> DataFrame:
    """``n_points`` points at equal distances along each track's polyline ``track_id, idx, x, y``.

    Distance runs from the first point to the last; point ``k`` lies at ``k * L / (n - 1)``, on
    the segment that reaches it.  On its output ``s = idx * L / (N - 1)`` (J2) is the distance
    travelled, however uneven the input.  Output ``track_id, idx, x, y, s``.
    """
    w = Window.partitionBy("track_id").orderBy("idx")
    d = points.select("track_id", "idx", "x", "y", F.lead("x").over(w).alias("_x2"), F.lead("y").over(w).alias("_y2"))
    dx, dy = F.col("_x2") - F.col("x"), F.col("_y2") - F.col("y")
    d = d.withColumn("_len", F.coalesce(F.sqrt(dx * dx + dy * dy), F.lit(0.0)))
    d = d.withColumns({
        "_to": F.sum("_len").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_step": F.sum("_len").over(Window.partitionBy("track_id")) / F.lit(float(n_points - 1)),
        "_last": F.lead("idx", 2).over(w).isNull(),
    })
    d = d.filter(F.col("_x2").isNotNull() & (F.col("_len") > 0)).withColumn("_from", F.col("_to") - F.col("_len"))
    first = F.ceil(F.col("_from") / F.col("_step")).cast("int")
    # a point on the border belongs to the segment that it begins, the last one to the last segment
    end = F.when(F.col("_last"), F.lit(n_points - 1)).otherwise(F.ceil(F.col("_to") / F.col("_step")).cast("int") - 1)
    d = d.filter(first <= end).withColumn("_k", F.explode(F.sequence(first, end)))
    s = F.col("_k") * F.col("_step")
    part = F.least(F.greatest((s - F.col("_from")) / F.col("_len"), F.lit(0.0)), F.lit(1.0))
    return d.select("track_id", F.col("_k").cast("int").alias("idx"),
                    (F.col("x") + part * (F.col("_x2") - F.col("x"))).alias("x"),
                    (F.col("y") + part * (F.col("_y2") - F.col("y"))).alias("y"), s.alias("s"))


def _gradient(c: str, w) -> Column:
    """Numpy-style gradient: central inside, one-sided at both ends."""
    prev, nxt, cur = F.lag(c, 1).over(w), F.lead(c, 1).over(w), F.col(c)
    return F.when(prev.isNull(), nxt - cur).when(nxt.isNull(), cur - prev).otherwise((nxt - prev) / F.lit(2.0))


def track_geometry(points: DataFrame) -> DataFrame:
    """G3-G5 + H12 + J2: curvature, segment length, tangent, distance along, sector.

    Output: ``track_id, idx, x, y, dx, dy, curvature, seg_len, tan_x, tan_y, s,
    total_length, n_points, sector_name``; ``s = idx * L / (N - 1)``.
    """
    w = Window.partitionBy("track_id").orderBy("idx")
    allw = Window.partitionBy("track_id")
    d = points.select("track_id", "idx", "x", "y")
    d = d.withColumn("dx", _gradient("x", w)).withColumn("dy", _gradient("y", w))
    d = d.withColumn("_ddx", _gradient("dx", w)).withColumn("_ddy", _gradient("dy", w))
    sq = F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")
    num = F.abs(F.col("dx") * F.col("_ddy") - F.col("dy") * F.col("_ddx"))
    den = sq * F.sqrt(sq)
    d = (
        d.withColumn("curvature", F.when(den == 0, F.lit(0.0)).otherwise(num / den))
        .withColumn("seg_len", F.sqrt(sq))
        .withColumn("tan_x", F.when(F.col("seg_len") > 0, F.col("dx") / F.col("seg_len")))
        .withColumn("tan_y", F.when(F.col("seg_len") > 0, F.col("dy") / F.col("seg_len")))
        .withColumn("total_length", F.sum("seg_len").over(allw))
        .withColumn("n_points", F.count(F.lit(1)).over(allw))
    )
    return d.withColumn(
        "s",
        F.when(F.col("n_points") > 1, F.col("idx") * F.col("total_length") / (F.col("n_points") - 1)).otherwise(0.0),
    ).withColumn("sector_name", ch.sector_name(F.col("idx"), F.col("n_points"))).drop("_ddx", "_ddy")


def speed_profile(geometry: DataFrame, mu: float = ch.MU_BASE,
                  mass_kg: float = ch.BASE_MASS_KG + ch.FUEL_START_KG / 2) -> DataFrame:
    """H13 + C3: cornering limit, then the braking-limited target speed of a closed lap.

    The backward recurrence ``v[i] = min(v[i], sqrt(v[i+1]^2 + 2 a d[i]))`` (two
    passes, last point linked to the first after each) has a closed form with the
    prefix distance ``S[i] = sum(d[k], k < i)``:

        v1[i]^2 = min_{j >= i}(vmax[j]^2 + 2a S[j]) - 2a S[i]
        v[i]^2  = min(v1[i]^2, v1[0]^2 + 2a (S[n-1] - S[i]))      for i < n-1
        v[n-1]  = min(vmax[n-1], v1[0])

    so it needs a suffix-min window instead of a sequential loop.
    """
    a2 = F.lit(2.0 * ch.BRAKE_DECEL)
    w = Window.partitionBy("track_id").orderBy("idx")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    full = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = geometry.select("track_id", "idx", "curvature", "seg_len", "n_points")
    d = d.withColumn("v_max_ms", ch.max_corner_speed(F.col("curvature"), mu, mass_kg))
    d = d.withColumn("_S", F.coalesce(F.sum("seg_len").over(before), F.lit(0.0)))
    d = d.withColumn("_v1sq", F.min(F.col("v_max_ms") * F.col("v_max_ms") + a2 * F.col("_S")).over(after) - a2 * F.col("_S"))
    d = d.withColumn("_v1sq0", F.first("_v1sq").over(full)).withColumn("_Sn", F.last("_S").over(full))
    d = d.withColumn("_vmax_last", F.last("v_max_ms").over(full))
    inner = F.sqrt(F.least(F.col("_v1sq"), F.col("_v1sq0") + a2 * (F.col("_Sn") - F.col("_S"))))
    last = F.least(F.col("v_max_ms"), F.sqrt(F.col("_v1sq0")))
    target = F.when(F.col("idx") == F.col("n_points") - 1, last).otherwise(inner)
    return d.select("track_id", "idx", "curvature", "v_max_ms", target.alias("target_speed_ms"))
