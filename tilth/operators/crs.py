"""Coordinate reference systems in closed form: 4326, 3857, 6933 and UTM.

The source may be a column, so rows of different systems and zones go through one plan.

Formulas: Snyder 1987 (cylindrical equal area), Karney 2011 (Krueger series).
Other pairs raise.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tilth.operators.geometry import area, map_points, point

A, INV_F = 6378137.0, 298.257223563
FLAT = 1 / INV_F
E2 = FLAT * (2 - FLAT)
ECC = math.sqrt(E2)
_PHI1 = math.radians(30)
K0_6933 = math.cos(_PHI1) / math.sqrt(1 - E2 * math.sin(_PHI1) ** 2)
_N = FLAT / (2 - FLAT)
#: Coefficients of the Krueger series to the fourth order in n.
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
_RECT = A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)


def _to_6933(p: Column) -> Column:
    s = F.sin(F.radians(p["y"]))
    q = (1 - E2) * (s / (1 - E2 * s * s) - F.log((1 - ECC * s) / (1 + ECC * s)) / (2 * ECC))
    return point(F.radians(p["x"]) * (A * K0_6933), q * (A / (2 * K0_6933)))


def _to_3857(p: Column) -> Column:
    return point(F.radians(p["x"]) * A, F.log(F.tan(F.radians(p["y"]) / 2 + math.pi / 4)) * A)


def _from_3857(p: Column) -> Column:
    return point(F.degrees(p["x"] / A), F.degrees(F.atan(F.exp(p["y"] / A)) * 2 - math.pi / 2))


def _zone(srid: int | Column) -> tuple[float | Column, float | Column]:
    """Central meridian in radians and false northing; columns of a column."""
    if isinstance(srid, Column):
        return F.radians((srid % 100) * 6 - 183), F.when(srid >= 32700, 1e7).otherwise(0.0)
    return math.radians((srid % 100) * 6 - 183), 1e7 if srid // 100 == 327 else 0.0


Step = Callable[[Column], Column]


def _to_utm(srid: int | Column) -> list[Step]:
    """Steps from 4326.  Each step's point is computed once, and the next one names it as often as it likes."""
    lon0, north = _zone(srid)

    def conformal(p: Column) -> Column:
        s = F.sin(F.radians(p["y"]))
        return point(F.radians(p["x"]) - lon0, F.sinh(F.atanh(s) - ECC * F.atanh(ECC * s)))

    def sphere(p: Column) -> Column:
        lam, t = p["x"], p["y"]
        return point(F.asinh(F.sin(lam) / F.sqrt(t * t + F.cos(lam) * F.cos(lam))), F.atan2(t, F.cos(lam)))

    def series(p: Column) -> Column:
        eta, xi = p["x"], p["y"]
        x = eta + sum((a * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, a in enumerate(_ALPHA, 1)), F.lit(0.0))
        y = xi + sum((a * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, a in enumerate(_ALPHA, 1)), F.lit(0.0))
        return point(x * (0.9996 * _RECT) + 500000.0, y * (0.9996 * _RECT) + north)

    return [conformal, sphere, series]


def _from_utm(srid: int | Column) -> list[Step]:
    lon0, north = _zone(srid)

    def unit(p: Column) -> Column:
        return point((p["x"] - 500000.0) / (0.9996 * _RECT), (p["y"] - north) / (0.9996 * _RECT))

    def series(p: Column) -> Column:
        eta, xi = p["x"], p["y"]
        x = eta - sum((b * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, b in enumerate(_BETA, 1)), F.lit(0.0))
        y = xi - sum((b * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, b in enumerate(_BETA, 1)), F.lit(0.0))
        return point(x, y)

    def conformal(p: Column) -> Column:
        return point(F.atan2(F.sinh(p["x"]), F.cos(p["y"])) + lon0, F.asin(F.sin(p["y"]) / F.cosh(p["x"])))

    def geodetic(p: Column) -> Column:
        # conformal to geodetic latitude, to the fourth order in n
        chi = p["y"]
        phi = chi + sum((d * F.sin(2 * j * chi) for j, d in enumerate((2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45, 7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45, 56 * _N**3 / 15 - 136 * _N**4 / 35, 4279 * _N**4 / 630), 1)), F.lit(0.0))
        return point(F.degrees(p["x"]), F.degrees(phi))

    return [unit, series, conformal, geodetic]


def _is_utm(srid: int) -> bool:
    return srid // 100 in (326, 327) and 1 <= srid % 100 <= 60


def _steps(source: int, target: int) -> list[Step]:
    """Raises ValueError for a pair without a formula."""
    if source == target:
        return []
    out: list[Step] = []
    if source == 3857:
        out = [_from_3857]
    elif _is_utm(source):
        out = _from_utm(source)
    elif source != 4326:
        raise ValueError(f"no transformation from EPSG:{source}")
    if target == 6933:
        return [*out, _to_6933]
    if target == 3857:
        return [*out, _to_3857]
    if _is_utm(target):
        return [*out, *_to_utm(target)]
    if target != 4326:
        raise ValueError(f"no transformation to EPSG:{target}")
    return out


def point_to_crs(p: Column, source: int, target: int) -> Column:
    """One (x, y) point; raises ValueError for a pair without a formula."""
    steps = _steps(source, target)
    return F.get(reduce(F.transform, steps, F.array(p)), F.lit(0)) if steps else p


def _moved(geom: Column, steps: Sequence[Step]) -> Column:
    return reduce(map_points, steps, geom)


def to_crs(geom: Column, source: int, target: int) -> Column:
    """Vertices only: edges stay straight between them."""
    return _moved(geom, _steps(source, target))


def known(srid: Column) -> Column:
    """Whether there are formulas for a row's system; false for null."""
    return F.coalesce(srid.isin(4326, 3857) | srid.between(32601, 32660) | srid.between(32701, 32760), F.lit(False))


def to_crs_by_row(geom: Column, srid: Column, target: int) -> Column:
    """From each row's own system; null where it is null or has no formula.

    The zone of a UTM row is a pair of numbers computed from its code, so all zones share one expression.
    """
    utm = srid.between(32601, 32660) | srid.between(32701, 32760)
    out = F.when(srid == target, geom)
    for own in (4326, 3857):
        if own != target:
            out = out.when(srid == own, to_crs(geom, own, target))
    return out.when(utm, _moved(geom, [*_from_utm(srid), *_steps(4326, target)]))


def to_utm_by_row(geom: Column, srid: Column) -> Column:
    """From 4326 to the UTM zone of each row."""
    return _moved(geom, _to_utm(srid))


def area_m2(geom: Column, srid: int | Column = 4326) -> Column:
    """Area in the equal-area projection; null for a row without a formula."""
    return area(to_crs_by_row(geom, srid, 6933) if isinstance(srid, Column) else to_crs(geom, srid, 6933))


def srid_or(srid: Column, default: int) -> Column:
    return F.coalesce(srid, F.lit(default))
