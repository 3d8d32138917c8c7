"""DuckDB twins of the track and spatial operators.

The oracle matches positions by brute force (every sample against every track
point), which is what the grid matcher must reproduce exactly.
"""

from __future__ import annotations

from pitwall.functions import channels as ch

A2 = repr(2.0 * ch.BRAKE_DECEL)
AERO_K = repr(ch.RHO * ch.CL * ch.AREA_M2)
MASS2 = repr(2 * (ch.BASE_MASS_KG + ch.FUEL_START_KG / 2))
STRAIGHT = repr(ch.STRAIGHT_SPEED_MS)


def dbl(v) -> str:
    return f"CAST({v!r} AS DOUBLE)"


MATCHED_CTE = """nearest AS (
SELECT t.car_id, t.seq, min({'d2': (p.x - t.x) * (p.x - t.x) + (p.y - t.y) * (p.y - t.y), 'idx': p.idx}) AS b
FROM telemetry t JOIN track_points p ON p.track_id = t.track_id
WHERE t.x IS NOT NULL AND t.y IS NOT NULL
GROUP BY t.car_id, t.seq
),
matched AS (
SELECT t.*, n.b.idx AS idx, sqrt(n.b.d2) AS match_dist_m FROM telemetry t JOIN nearest n USING (car_id, seq)
)"""


def _grad(c: str) -> str:
    w = "OVER (PARTITION BY track_id ORDER BY idx)"
    return (
        f"CASE WHEN lag({c}) {w} IS NULL THEN lead({c}) {w} - {c} "
        f"WHEN lead({c}) {w} IS NULL THEN {c} - lag({c}) {w} "
        f"ELSE (lead({c}) {w} - lag({c}) {w}) / CAST(2 AS DOUBLE) END"
    )


def geometry_cte(name: str, src: str) -> str:
    return f"""{name} AS (
SELECT track_id, idx, x, y, dx, dy,
  CASE WHEN sq * sqrt(sq) = 0 THEN CAST(0 AS DOUBLE) ELSE abs(dx * ddy - dy * ddx) / (sq * sqrt(sq)) END AS curvature,
  sqrt(sq) AS seg_len,
  CASE WHEN sqrt(sq) > 0 THEN dx / sqrt(sq) END AS tan_x,
  CASE WHEN sqrt(sq) > 0 THEN dy / sqrt(sq) END AS tan_y,
  total_length, n_points,
  CASE WHEN n_points > 1 THEN idx * total_length / (n_points - 1) ELSE CAST(0 AS DOUBLE) END AS s,
  CASE WHEN idx < floor(n_points * CAST(0.33 AS DOUBLE)) THEN 'Sector 1'
       WHEN idx < floor(n_points * CAST(0.66 AS DOUBLE)) THEN 'Sector 2' ELSE 'Sector 3' END AS sector_name
FROM (SELECT *, sum(sqrt(sq)) OVER (PARTITION BY track_id) AS total_length,
        count(*) OVER (PARTITION BY track_id) AS n_points
      FROM (SELECT *, dx * dx + dy * dy AS sq FROM (
        SELECT *, {_grad('dx')} AS ddx, {_grad('dy')} AS ddy FROM (
          SELECT track_id, idx, x, y, {_grad('x')} AS dx, {_grad('y')} AS dy FROM {src}) g1) g2) g3) g4
)"""


def profile_cte(name: str, geo: str) -> str:
    full = "OVER (PARTITION BY track_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    return f"""{name} AS (
SELECT track_id, idx, curvature, v_max_ms,
  CASE WHEN idx = n_points - 1 THEN least(v_max_ms, sqrt(v1sq0))
       ELSE sqrt(least(v1sq, v1sq0 + {A2} * (sn - s_before))) END AS target_speed_ms
FROM (SELECT *, first_value(v1sq) {full} AS v1sq0, last_value(s_before) {full} AS sn FROM (
  SELECT *, min(v_max_ms * v_max_ms + {A2} * s_before) OVER (PARTITION BY track_id ORDER BY idx
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - {A2} * s_before AS v1sq FROM (
    SELECT *, coalesce(sum(seg_len) OVER (PARTITION BY track_id ORDER BY idx
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), CAST(0 AS DOUBLE)) AS s_before,
      CASE WHEN curvature < {dbl(ch.STRAIGHT_CURVATURE)} THEN {STRAIGHT}
           WHEN curvature - {dbl(ch.MU_BASE)} * {AERO_K} / {MASS2} <= 0 THEN {STRAIGHT}
           ELSE sqrt({dbl(ch.MU_BASE)} * {dbl(ch.G)} / (curvature - {dbl(ch.MU_BASE)} * {AERO_K} / {MASS2})) END
        AS v_max_ms
    FROM {geo}) p1) p2) p3
)"""


def centreline_cte(name: str = "centre", src: str = "matched", bucket: int = 10) -> str:
    return f"""{name} AS (
SELECT track_id, CAST(floor(idx / {bucket}) AS INTEGER) AS pos,
  sum(CAST(round(x * CAST(1000000 AS DOUBLE)) AS BIGINT)) / count(*) / CAST(1000000 AS DOUBLE) AS x,
  sum(CAST(round(y * CAST(1000000 AS DOUBLE)) AS BIGINT)) / count(*) / CAST(1000000 AS DOUBLE) AS y,
  count(*) AS samples
FROM {src} GROUP BY track_id, CAST(floor(idx / {bucket}) AS INTEGER)
)"""


def spline_ctes(src: str, rounds: int = 80) -> tuple[str, ...]:
    """The periodic cubic spline's second derivatives ``mx, my`` by Jacobi iteration, which halves its
    error every round (the operator eliminates instead)."""
    full = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
    w = "OVER (PARTITION BY track_id ORDER BY i)"
    wf = f"OVER (PARTITION BY track_id ORDER BY i {full})"

    def before(c):
        return f"coalesce(lag({c}) {w}, last_value({c}) {wf})"

    def after(c):
        return f"coalesce(lead({c}) {w}, first_value({c}) {wf})"

    six, two = dbl(6.0), dbl(2.0)
    return (
        f"""sp_points AS (
SELECT *, {after('x')} AS nx, {after('y')} AS ny, {before('x')} AS px, {before('y')} AS py,
  count(*) OVER (PARTITION BY track_id) AS n
FROM (SELECT track_id, x, y, row_number() OVER (PARTITION BY track_id ORDER BY pos) - 1 AS i FROM {src}) w
)""",
        f"""sp_system AS (
SELECT *, {six} * ((nx - x) / ha - (x - px) / hb) AS dx, {six} * ((ny - y) / ha - (y - py) / hb) AS dy
FROM (SELECT *, sqrt((nx - x) * (nx - x) + (ny - y) * (ny - y)) AS ha,
        sqrt((px - x) * (px - x) + (py - y) * (py - y)) AS hb FROM sp_points) h
)""",
        f"""sp_it(round_no, track_id, i, mx, my) AS (
SELECT 0, track_id, i, {dbl(0.0)}, {dbl(0.0)} FROM sp_system
UNION ALL
SELECT round_no + 1, track_id, i, (dx - hb * bx - ha * ax) / ({two} * (hb + ha)), (dy - hb * b_y - ha * ay) / ({two} * (hb + ha))
FROM (SELECT t.round_no, s.*, {before('mx').replace('track_id', 's.track_id').replace('ORDER BY i', 'ORDER BY s.i')} AS bx,
        {after('mx').replace('track_id', 's.track_id').replace('ORDER BY i', 'ORDER BY s.i')} AS ax,
        {before('my').replace('track_id', 's.track_id').replace('ORDER BY i', 'ORDER BY s.i')} AS b_y,
        {after('my').replace('track_id', 's.track_id').replace('ORDER BY i', 'ORDER BY s.i')} AS ay
      FROM sp_it t JOIN sp_system s ON s.track_id = t.track_id AND s.i = t.i WHERE t.round_no < {rounds}) r
)""",
        f"""solved AS (
SELECT *, {after('mx')} AS nmx, {after('my')} AS nmy, sum(ha) {w} AS to_u
FROM (SELECT s.*, t.mx, t.my FROM sp_system s JOIN sp_it t ON t.track_id = s.track_id AND t.i = s.i AND t.round_no = {rounds}) m
)""",
    )


def spline_at(c: str) -> str:
    """Position on segment ``i`` (``solved``) at parameter ``k * step``."""
    t, s = "(k * step - u)", "(ha - (k * step - u))"
    return (f"round((m{c} * {s} * {s} * {s} + nm{c} * {t} * {t} * {t}) / ({dbl(6.0)} * ha)"
            f" + ({c} / ha - m{c} * ha / {dbl(6.0)}) * {s} + (n{c} / ha - nm{c} * ha / {dbl(6.0)}) * {t}, 6)")


def resample_cte(name: str, src: str, k: int) -> str:
    full = "OVER (PARTITION BY track_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    w = "OVER (PARTITION BY track_id ORDER BY pos)"

    def nb(c):
        return (
            f"coalesce(lag({c}) {w}, last_value({c}) {full}) AS {c}0, "
            f"coalesce(lead({c}) {w}, first_value({c}) {full}) AS {c}2, "
            f"coalesce(lead({c}, 2) {w}, CASE WHEN row_number() {w} - 1 = count(*) {full} - 2 "
            f"THEN first_value({c}) {full} ELSE nth_value({c}, 2) {full} END) AS {c}3"
        )

    def spline(c):
        two, five, four, three = (f"CAST({v} AS DOUBLE)" for v in (2, 5, 4, 3))
        return (
            f"CAST(0.5 AS DOUBLE) * ({two} * {c} + ({c}2 - {c}0) * t"
            f" + ({two} * {c}0 - {five} * {c} + {four} * {c}2 - {c}3) * t * t"
            f" + ({three} * {c} - {c}0 - {three} * {c}2 + {c}3) * t * t * t)"
        )

    return f"""{name} AS (
SELECT track_id, CAST(r * {k} + j AS INTEGER) AS idx, {spline('x')} AS x, {spline('y')} AS y
FROM (SELECT *, j / CAST({k} AS DOUBLE) AS t FROM (
  SELECT *, unnest(range({k})) AS j FROM (
    SELECT track_id, pos, x, y, row_number() {w} - 1 AS r, {nb('x')}, {nb('y')} FROM {src}) n0) n1) n2
)"""


def boundary_cte(name: str, src: str) -> str:
    return f"""{name} AS (
SELECT *, greatest(coalesce(lap_count, 0), previous_lap) AS effective_lap,
  (previous_lap IS NULL OR coalesce(lap_count, 0) > previous_lap) AS is_lap_start
FROM (SELECT *, max(coalesce(lap_count, 0)) OVER (PARTITION BY car_id ORDER BY seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_lap
      FROM {src}) b
)"""


TRACE_CTES = (
    boundary_cte("mb", "matched"),
    """lagged_idx AS (
SELECT *, lag(idx) OVER (PARTITION BY car_id, effective_lap ORDER BY seq) AS prev_idx FROM mb
)""",
    """cells AS (
SELECT car_id, effective_lap AS lap_count, seq, CAST(unnest(range(lo, hi + 1)) AS INTEGER) AS idx,
  coalesce(speed_kmh, 0) AS speed_kmh, coalesce(throttle, 0) AS throttle, coalesce(brake, 0) AS brake
FROM (SELECT *,
  CASE WHEN prev_idx IS NOT NULL AND abs(idx - prev_idx) < 500 THEN least(idx, prev_idx) ELSE idx END AS lo,
  CASE WHEN prev_idx IS NOT NULL AND abs(idx - prev_idx) < 500 THEN greatest(idx, prev_idx) ELSE idx END AS hi
  FROM lagged_idx) c
)""",
    """trace AS (
SELECT car_id, lap_count, idx, arg_max(speed_kmh, seq) AS speed_kmh, arg_max(throttle, seq) AS throttle,
  arg_max(brake, seq) AS brake
FROM cells GROUP BY car_id, lap_count, idx
)""",
)
