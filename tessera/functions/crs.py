"""Coordinate systems: geographic ones, and Transverse Mercator grids on them,
with the shift between their datums, as column expressions.

The projection is the Krüger n-series to fourth order for any ellipsoid,
meridian, scale and false origin (Krüger 1912; Karney 2011, J. Geodesy 85).
Datums meet through geocentric coordinates and a seven-parameter similarity
transformation (position-vector rotation), heights taken as 0 on the source's
ellipsoid; WGS 84 and ETRS89 count as one datum, as usual for these grids.
Each step is a few columns of its own, so no expression is copied into many.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Ellipsoid:
    a: float
    inv_f: float

    @property
    def e2(self) -> float:
        f = 1.0 / self.inv_f
        return f * (2.0 - f)

    @property
    def n(self) -> float:
        return 1.0 / (2.0 * self.inv_f - 1.0)

    @property
    def rectifying_radius(self) -> float:
        n = self.n
        return self.a / (1.0 + n) * (1.0 + n**2 / 4.0 + n**4 / 64.0)

    def forward_series(self) -> tuple[float, ...]:
        n = self.n
        return (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
                61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280)

    def inverse_series(self) -> tuple[float, ...]:
        n = self.n
        return (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
                17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280)


@dataclass(frozen=True)
class Grid:
    """A Transverse Mercator grid."""
    meridian: float  # degrees
    scale: float
    false_easting: float
    false_northing: float = 0.0


#: metres, arc seconds, parts per million
Shift = tuple[float, float, float, float, float, float, float]


@dataclass(frozen=True)
class Crs:
    ellipsoid: Ellipsoid
    shift: Shift | None = None  # to WGS 84; None: the same datum
    grid: Grid | None = None    # None: geographic


# Ellipsoids, the datum shift of the old Finnish system
# (KKJ to WGS 84, position vector), and the grids by EPSG code.
GRS80 = Ellipsoid(6378137.0, 298.257222101)
WGS84 = Ellipsoid(6378137.0, 298.257223563)
INTERNATIONAL_1924 = Ellipsoid(6378388.0, 297.0)
KKJ_TO_WGS84: Shift = (-96.062, -82.428, -121.753, 4.801, 0.345, -1.376, 1.496)
CRS: dict[int, Crs] = {
    4326: Crs(WGS84),
    4258: Crs(GRS80),
    4123: Crs(INTERNATIONAL_1924, KKJ_TO_WGS84),
    3067: Crs(GRS80, None, Grid(27.0, 0.9996, 500000.0)),
    25834: Crs(GRS80, None, Grid(21.0, 0.9996, 500000.0)),
    25835: Crs(GRS80, None, Grid(27.0, 0.9996, 500000.0)),
    25836: Crs(GRS80, None, Grid(33.0, 0.9996, 500000.0)),
    32634: Crs(WGS84, None, Grid(21.0, 0.9996, 500000.0)),
    32635: Crs(WGS84, None, Grid(27.0, 0.9996, 500000.0)),
    32636: Crs(WGS84, None, Grid(33.0, 0.9996, 500000.0)),
    3386: Crs(INTERNATIONAL_1924, KKJ_TO_WGS84, Grid(18.0, 1.0, 500000.0)),
    2391: Crs(INTERNATIONAL_1924, KKJ_TO_WGS84, Grid(21.0, 1.0, 1500000.0)),
    2392: Crs(INTERNATIONAL_1924, KKJ_TO_WGS84, Grid(24.0, 1.0, 2500000.0)),
    2393: Crs(INTERNATIONAL_1924, KKJ_TO_WGS84, Grid(27.0, 1.0, 3500000.0)),
    2394: Crs(INTERNATIONAL_1924, KKJ_TO_WGS84, Grid(30.0, 1.0, 4500000.0)),
    3387: Crs(INTERNATIONAL_1924, KKJ_TO_WGS84, Grid(33.0, 1.0, 5500000.0)),
}

LATITUDE_STEPS = 5  # fixed-point steps conformal -> geodetic latitude


def crs_of(code: int | str | Crs) -> Crs:
    """A system by EPSG number, by "epsg:<number>" in any case, or itself."""
    if isinstance(code, Crs):
        return code
    number = str(code).strip().lower().removeprefix("epsg:")
    if not number.isdigit() or int(number) not in CRS:
        raise ValueError(f"unknown coordinate system {code!r}; known: {', '.join(f'epsg:{k}' for k in sorted(CRS))}")
    return CRS[int(number)]


def _steps(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns(columns)


def _project(df: DataFrame, crs: Crs) -> DataFrame:
    """_p, _l (radians) -> _a (easting), _b (northing)."""
    ell, grid = crs.ellipsoid, crs.grid
    e = math.sqrt(ell.e2)
    df = _steps(df, _s=F.sin("_p"), _d=F.col("_l") - math.radians(grid.meridian))
    df = _steps(df, _t=F.sinh(F.atanh("_s") - e * F.atanh(e * F.col("_s"))))
    df = _steps(df, _xi=F.atan2("_t", F.cos("_d")), _eta=F.atanh(F.sin("_d") / F.sqrt(1.0 + F.col("_t") * F.col("_t"))))
    north, east = F.col("_xi"), F.col("_eta")
    for j, h in enumerate(ell.forward_series(), 1):
        north = north + h * F.sin(2.0 * j * F.col("_xi")) * F.cosh(2.0 * j * F.col("_eta"))
        east = east + h * F.cos(2.0 * j * F.col("_xi")) * F.sinh(2.0 * j * F.col("_eta"))
    k = grid.scale * ell.rectifying_radius
    return _steps(df, _a=grid.false_easting + k * east, _b=grid.false_northing + k * north)


def _unproject(df: DataFrame, crs: Crs) -> DataFrame:
    """_a (easting), _b (northing) -> _p, _l (radians)."""
    ell, grid = crs.ellipsoid, crs.grid
    k, e = grid.scale * ell.rectifying_radius, math.sqrt(ell.e2)
    df = _steps(df, _xi=(F.col("_b") - grid.false_northing) / k, _eta=(F.col("_a") - grid.false_easting) / k)
    north, east = F.col("_xi"), F.col("_eta")
    for j, b in enumerate(ell.inverse_series(), 1):
        north = north - b * F.sin(2.0 * j * F.col("_xi")) * F.cosh(2.0 * j * F.col("_eta"))
        east = east - b * F.cos(2.0 * j * F.col("_xi")) * F.sinh(2.0 * j * F.col("_eta"))
    df = _steps(df, _s=north, _t=east)
    flat = F.sqrt(F.sinh("_t") * F.sinh("_t") + F.cos("_s") * F.cos("_s"))
    df = _steps(df, _d=F.asinh(F.sin("_s") / flat), _l=F.atan2(F.sinh("_t"), F.cos("_s")) + math.radians(grid.meridian))
    df = _steps(df, _q=F.col("_d"))
    for _ in range(LATITUDE_STEPS):
        df = _steps(df, _q=F.col("_d") + e * F.atanh(e * F.tanh("_q")))
    return _steps(df, _p=F.atan(F.sinh("_q")))


def similarity(shift: Shift) -> tuple[np.ndarray, np.ndarray]:
    """Translation (metres) and matrix of a seven-parameter transformation."""
    rx, ry, rz = (math.radians(r / 3600.0) for r in shift[3:6])
    turn = np.array([[1.0, -rz, ry], [rz, 1.0, -rx], [-ry, rx, 1.0]])
    return np.array(shift[:3]), (1.0 + shift[6] * 1e-6) * turn


def _shifted(df: DataFrame, src: Crs, dst: Crs) -> DataFrame:
    """_p, _l on ``src``'s datum -> on ``dst``'s, through WGS 84."""
    if src.shift == dst.shift:
        return df
    move, turn = np.zeros(3), np.eye(3)
    if src.shift:
        move, turn = similarity(src.shift)
    if dst.shift:  # the inverse, exactly
        back_move, back_turn = similarity(dst.shift)
        back_turn = np.linalg.inv(back_turn)
        move, turn = back_turn @ (move - back_move), back_turn @ turn
    a, e2 = src.ellipsoid.a, src.ellipsoid.e2
    df = _steps(df, _s=a / F.sqrt(1.0 - e2 * F.sin("_p") * F.sin("_p")))
    df = _steps(df, _x=F.col("_s") * F.cos("_p") * F.cos("_l"), _y=F.col("_s") * F.cos("_p") * F.sin("_l"), _z=(1.0 - e2) * F.col("_s") * F.sin("_p"))
    axis = [F.col(c) for c in ("_x", "_y", "_z")]
    turned = {f"_{n}2": float(move[i]) + sum((float(turn[i, j]) * axis[j] for j in range(3)), F.lit(0.0)) for i, n in enumerate("xyz")}
    df = _steps(df, **turned)
    a, e2 = dst.ellipsoid.a, dst.ellipsoid.e2
    b = a * math.sqrt(1.0 - e2)
    df = _steps(df, _d=F.sqrt(F.col("_x2") * F.col("_x2") + F.col("_y2") * F.col("_y2")))
    df = _steps(df, _t=F.atan2(F.col("_z2") * a, F.col("_d") * b))
    up = F.col("_z2") + (a * a - b * b) / b * F.pow(F.sin("_t"), 3)
    out = F.col("_d") - e2 * a * F.pow(F.cos("_t"), 3)
    return _steps(df, _p=F.atan2(up, out), _l=F.atan2("_y2", "_x2"))


def transform(df: DataFrame, src: int | str | Crs, dst: int | str | Crs, first: str, second: str, out: tuple[str, str]) -> DataFrame:
    """``df`` with ``out``, the coordinates (first, second) of ``src`` in
    ``dst``. Geographic systems have (latitude, longitude) in degrees, grids
    (easting, northing) in metres. A null coordinate gives null."""
    src, dst = crs_of(src), crs_of(dst)
    held = [c for c in df.columns if c not in out]
    work = df.select(F.struct(*held).alias("_row") if held else F.lit(None).alias("_row"), F.col(first).cast("double").alias("_a"), F.col(second).cast("double").alias("_b"))
    work = _unproject(work, src) if src.grid else _steps(work, _p=F.radians("_a"), _l=F.radians("_b"))
    work = _shifted(work, src, dst)
    work = _project(work, dst) if dst.grid else _steps(work, _a=F.degrees("_p"), _b=F.degrees("_l"))
    # a generator: filters on the new coordinates stay above it, as pushing one
    # down would copy the steps' expressions into each other
    made = F.inline(F.array(F.struct(F.col("_a").alias(out[0]), F.col("_b").alias(out[1]))))
    return work.select(*[F.col(f"_row.`{c}`").alias(c) for c in held], made)
