"""Derived-channel expressions (a registry of named Column builders).

Every function returns a JVM-side Column, so the channels stay inside whole-stage
codegen; none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Vehicle and physics constants of the modelled car.
BASE_MASS_KG = 798.0  # car + driver without fuel
FUEL_START_KG = 110.0
RHO = 1.225  # air density
CD_BASE = 0.9
CD_DRS = 0.7
CL = 1.2
AREA_M2 = 1.6
MU_BASE = 1.1
TIRE_WEAR_PER_M = 1e-6
MU_MIN = 0.5
G = 9.81
BRAKE_DECEL = 4.0 * G
STRAIGHT_SPEED_MS = 360.0 / 3.6
STRAIGHT_CURVATURE = 1e-5
DRS_CURVATURE = 0.0005
DRS_MIN_SPEED_KMH = 100.0
FUEL_BURN_KG_PER_S = 0.002
PACE_LOW, PACE_HIGH = 0.98, 1.02
# Upper speed bound (km/h) of gears 1..8; faster than the last is gear 1.
GEAR_UPPER_KMH = [80, 120, 160, 200, 240, 270, 310, 1000]
# Sector starts as fractions of the track's point count.
SECTOR_2_FRAC, SECTOR_3_FRAC = 0.33, 0.66


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clamp_min(c, lo: float = 0.0) -> Column:
    """``max(lo, c)``; NULL stays NULL."""
    c = _c(c)
    return F.when(c.isNull(), c).otherwise(F.greatest(F.lit(lo), c))


def kmh_to_ms(c) -> Column:
    """D11."""
    return _c(c) / F.lit(3.6)


def ms_to_kmh(c) -> Column:
    return _c(c) * F.lit(3.6)


def gear_band(speed_kmh) -> Column:
    """Gear implied by speed bands, 1..8, anything faster than the last band is 1."""
    s = _c(speed_kmh)
    e = None
    for gear, upper in enumerate(GEAR_UPPER_KMH, start=1):
        e = F.when(s < upper, F.lit(gear)) if e is None else e.when(s < upper, F.lit(gear))
    return e.otherwise(F.lit(1))


def total_mass(fuel_kg) -> Column:
    """C1."""
    return F.lit(BASE_MASS_KG) + _c(fuel_kg)


def grip(distance_m) -> Column:
    """Friction after ``distance_m`` on one set of tyres: a fixed loss a metre, never below ``MU_MIN``."""
    return F.greatest(F.lit(MU_MIN), F.lit(MU_BASE) - _c(distance_m) * F.lit(TIRE_WEAR_PER_M))


def wear_pct(grip_col) -> Column:
    """Wear in percent from grip."""
    return (F.lit(1.0) - _c(grip_col) / F.lit(MU_BASE)) * F.lit(100.0)


def aero_force(speed_ms, coeff) -> Column:
    """C4: ``0.5 rho v^2 C A`` (drag with Cd, downforce with CL)."""
    v = _c(speed_ms)
    return F.lit(0.5 * RHO) * v * v * _c(coeff) * F.lit(AREA_M2)


def drs_active(lap_count, curvature, speed_kmh) -> Column:
    """DRS allowed after the first lap on a straight above 100 km/h."""
    return (
        (_c(lap_count) > 0)
        & (_c(curvature) < F.lit(DRS_CURVATURE))
        & (_c(speed_kmh) > F.lit(DRS_MIN_SPEED_KMH))
    )


def drag_coefficient(drs) -> Column:
    return F.when(_c(drs), F.lit(CD_DRS)).otherwise(F.lit(CD_BASE))


def lateral_g(speed_ms, curvature) -> Column:
    """``v^2 kappa / g``."""
    v = _c(speed_ms)
    return v * v * _c(curvature) / F.lit(G)


def max_corner_speed(curvature, mu=MU_BASE, mass_kg: float = BASE_MASS_KG + FUEL_START_KG / 2) -> Column:
    """Cornering limit in m/s; straights (and no real solution) give 100 m/s."""
    k = _c(curvature)
    mu_c = F.lit(mu) if not isinstance(mu, Column) else mu
    denom = k - mu_c * F.lit(RHO * CL * AREA_M2) / F.lit(2 * mass_kg)
    return (
        F.when(k < F.lit(STRAIGHT_CURVATURE), F.lit(STRAIGHT_SPEED_MS))
        .when(denom <= 0, F.lit(STRAIGHT_SPEED_MS))
        .otherwise(F.sqrt(mu_c * F.lit(G) / denom))
    )


def pace_state(speed_ms, target_ms) -> Column:
    """Driver state against the target speed."""
    v, t = _c(speed_ms), _c(target_ms)
    return (
        F.when(v < t * F.lit(PACE_LOW), F.lit("accelerating"))
        .when(v > t * F.lit(PACE_HIGH), F.lit("braking"))
        .otherwise(F.lit("hold"))
    )


def sector_name(idx, n_points) -> Column:
    """Three sectors split at int(0.33 N) and int(0.66 N)."""
    i = _c(idx)
    n = F.lit(n_points) if not isinstance(n_points, Column) else n_points
    s2 = F.floor(n * F.lit(SECTOR_2_FRAC))
    s3 = F.floor(n * F.lit(SECTOR_3_FRAC))
    return F.when(i < s2, F.lit("Sector 1")).when(i < s3, F.lit("Sector 2")).otherwise(F.lit("Sector 3"))


def fuel_burn(throttle, dt_s, speed_ms) -> Column:
    """H11 step: ``0.002 * throttle * dt * (v/100 + 1)`` kg."""
    return F.lit(FUEL_BURN_KG_PER_S) * _c(throttle) * _c(dt_s) * (_c(speed_ms) / F.lit(100.0) + F.lit(1.0))
