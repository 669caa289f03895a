"""Map projections as Spark column expressions (formulas of J. P. Snyder,
"Map Projections: A Working Manual", 1987).

Used to bring polygon vertices and cell corners into one plane before
clipping: the grid's Lambert conformal conic on a sphere, the polygons'
Albers equal-area conic on GRS 80, and the north-polar Lambert azimuthal
equal-area on WGS 84 for areas.  Angles are degrees in, metres out.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Projection parameters.
@dataclass(frozen=True)
class LambertConformalSphere:
    """Grid projection: +proj=lcc +a=b=6370000 +lat_1=30 +lat_2=60 +lat_0=40 +lon_0=-97."""
    radius: float = 6370000.0
    lat1: float = 30.0
    lat2: float = 60.0
    lat0: float = 40.0
    lon0: float = -97.0
    x0: float = 0.0
    y0: float = 0.0

    def _consts(self):
        p1, p2, p0 = (math.radians(v) for v in (self.lat1, self.lat2, self.lat0))
        if abs(p1 - p2) < 1e-12:
            n = math.sin(p1)
        else:
            n = math.log(math.cos(p1) / math.cos(p2)) / math.log(
                math.tan(math.pi / 4 + p2 / 2) / math.tan(math.pi / 4 + p1 / 2))
        f = math.cos(p1) * math.tan(math.pi / 4 + p1 / 2) ** n / n
        rho0 = self.radius * f / math.tan(math.pi / 4 + p0 / 2) ** n
        return n, f, rho0

    def forward(self, lon, lat) -> tuple[Column, Column]:
        n, f, rho0 = self._consts()
        phi = F.radians(_c(lat))
        rho = F.lit(self.radius * f) / F.pow(F.tan(F.lit(math.pi / 4) + phi / 2), F.lit(n))
        theta = F.lit(n) * F.radians(_c(lon) - F.lit(self.lon0))
        return rho * F.sin(theta) + F.lit(self.x0), F.lit(rho0) - rho * F.cos(theta) + F.lit(self.y0)

    def inverse(self, x, y) -> tuple[Column, Column]:
        n, f, rho0 = self._consts()
        s = 1.0 if n > 0 else -1.0
        dx = _c(x) - F.lit(self.x0)
        dy = F.lit(rho0) - (_c(y) - F.lit(self.y0))
        rho = F.lit(s) * F.sqrt(dx * dx + dy * dy)
        theta = F.atan2(F.lit(s) * dx, F.lit(s) * dy)
        phi = 2 * F.atan(F.pow(F.lit(self.radius * f) / rho, F.lit(1.0 / n))) - F.lit(math.pi / 2)
        return F.degrees(theta / F.lit(n)) + F.lit(self.lon0), F.degrees(phi)


@dataclass(frozen=True)
class Ellipsoid:
    a: float
    inv_f: float

    @property
    def e2(self) -> float:
        f = 1.0 / self.inv_f
        return 2 * f - f * f

    @property
    def e(self) -> float:
        return math.sqrt(self.e2)

    def q_py(self, phi: float) -> float:
        e, e2, s = self.e, self.e2, math.sin(phi)
        return (1 - e2) * (s / (1 - e2 * s * s) - 1 / (2 * e) * math.log((1 - e * s) / (1 + e * s)))

    def q(self, phi: Column) -> Column:
        e, e2 = self.e, self.e2
        s = F.sin(phi)
        return F.lit(1 - e2) * (s / (F.lit(1.0) - F.lit(e2) * s * s)
                                - F.lit(1 / (2 * e)) * F.ln((F.lit(1.0) - F.lit(e) * s) / (F.lit(1.0) + F.lit(e) * s)))

    def m_py(self, phi: float) -> float:
        return math.cos(phi) / math.sqrt(1 - self.e2 * math.sin(phi) ** 2)

    def authalic_to_geodetic(self, beta: Column) -> Column:
        e2 = self.e2
        e4, e6 = e2 * e2, e2 * e2 * e2
        return (beta + F.lit(e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta)
                + F.lit(23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta)
                + F.lit(761 * e6 / 45360) * F.sin(6 * beta))


    def conformal_to_geodetic(self, chi: Column) -> Column:
        """Geodetic from conformal latitude, by its series in e (exact to about 1e-10 degrees on the earth)."""
        e2 = self.e2
        e4, e6, e8 = e2 ** 2, e2 ** 3, e2 ** 4
        return (chi + F.lit(e2 / 2 + 5 * e4 / 24 + e6 / 12 + 13 * e8 / 360) * F.sin(2 * chi)
                + F.lit(7 * e4 / 48 + 29 * e6 / 240 + 811 * e8 / 11520) * F.sin(4 * chi)
                + F.lit(7 * e6 / 120 + 81 * e8 / 1120) * F.sin(6 * chi)
                + F.lit(4279 * e8 / 161280) * F.sin(8 * chi))


# Ellipsoid constants.
GRS80 = Ellipsoid(6378137.0, 298.257222101)
WGS84 = Ellipsoid(6378137.0, 298.257223563)


@dataclass(frozen=True)
class LambertConformal:
    """Lambert conformal conic on an ellipsoid, one or two standard parallels."""
    ellipsoid: Ellipsoid
    lat1: float
    lat2: float
    lat0: float
    lon0: float
    x0: float = 0.0
    y0: float = 0.0

    def _t_py(self, phi: float) -> float:
        es = self.ellipsoid.e * math.sin(phi)
        return math.tan(math.pi / 4 - phi / 2) / ((1 - es) / (1 + es)) ** (self.ellipsoid.e / 2)

    def _consts(self):
        p1, p2, p0 = (math.radians(v) for v in (self.lat1, self.lat2, self.lat0))
        m1, m2 = self.ellipsoid.m_py(p1), self.ellipsoid.m_py(p2)
        n = math.sin(p1) if abs(p1 - p2) < 1e-12 else math.log(m1 / m2) / math.log(self._t_py(p1) / self._t_py(p2))
        f = m1 / (n * self._t_py(p1) ** n)
        return n, f, self.ellipsoid.a * f * self._t_py(p0) ** n

    def forward(self, lon, lat) -> tuple[Column, Column]:
        n, f, rho0 = self._consts()
        phi = F.radians(_c(lat))
        es = F.lit(self.ellipsoid.e) * F.sin(phi)
        t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((F.lit(1.0) - es) / (F.lit(1.0) + es), F.lit(self.ellipsoid.e / 2))
        rho = F.lit(self.ellipsoid.a * f) * F.pow(t, F.lit(n))
        theta = F.lit(n) * F.radians(_c(lon) - F.lit(self.lon0))
        return rho * F.sin(theta) + F.lit(self.x0), F.lit(rho0) - rho * F.cos(theta) + F.lit(self.y0)

    def inverse(self, x, y) -> tuple[Column, Column]:
        n, f, rho0 = self._consts()
        s = 1.0 if n > 0 else -1.0
        dx, dy = _c(x) - F.lit(self.x0), F.lit(rho0) - (_c(y) - F.lit(self.y0))
        t = F.pow(F.lit(s) * F.sqrt(dx * dx + dy * dy) / F.lit(self.ellipsoid.a * f), F.lit(1.0 / n))
        theta = F.atan2(F.lit(s) * dx, F.lit(s) * dy)
        chi = F.lit(math.pi / 2) - 2 * F.atan(t)
        return F.degrees(theta / F.lit(n)) + F.lit(self.lon0), F.degrees(self.ellipsoid.conformal_to_geodetic(chi))


@dataclass(frozen=True)
class AlbersEqualArea:
    """Polygon projection: Albers conic equal-area, lat_1=29.5, lat_2=45.5, lat_0=23, lon_0=-96, GRS 80."""
    ellipsoid: Ellipsoid = GRS80
    lat1: float = 29.5
    lat2: float = 45.5
    lat0: float = 23.0
    lon0: float = -96.0
    x0: float = 0.0
    y0: float = 0.0

    def _consts(self):
        el = self.ellipsoid
        p1, p2, p0 = (math.radians(v) for v in (self.lat1, self.lat2, self.lat0))
        m1, m2 = el.m_py(p1), el.m_py(p2)
        q1, q2, q0 = el.q_py(p1), el.q_py(p2), el.q_py(p0)
        n = (m1 * m1 - m2 * m2) / (q2 - q1)
        c = m1 * m1 + n * q1
        rho0 = el.a * math.sqrt(c - n * q0) / n
        return n, c, rho0

    def forward(self, lon, lat) -> tuple[Column, Column]:
        el = self.ellipsoid
        n, c, rho0 = self._consts()
        rho = F.lit(el.a / n) * F.sqrt(F.lit(c) - F.lit(n) * el.q(F.radians(_c(lat))))
        theta = F.lit(n) * F.radians(_c(lon) - F.lit(self.lon0))
        x, y = rho * F.sin(theta), F.lit(rho0) - rho * F.cos(theta)
        return (x + F.lit(self.x0), y + F.lit(self.y0)) if self.x0 or self.y0 else (x, y)

    def inverse(self, x, y) -> tuple[Column, Column]:
        el = self.ellipsoid
        n, c, rho0 = self._consts()
        dx = _c(x) - F.lit(self.x0) if self.x0 else _c(x)
        dy = F.lit(rho0) - (_c(y) - F.lit(self.y0) if self.y0 else _c(y))
        rho = F.sqrt(dx * dx + dy * dy)
        theta = F.atan2(dx, dy)
        q = (F.lit(c) - rho * rho * F.lit(n * n / (el.a * el.a))) / F.lit(n)
        qp = el.q_py(math.pi / 2)
        beta = F.asin(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), q / F.lit(qp))))
        return F.degrees(theta / F.lit(n)) + F.lit(self.lon0), F.degrees(el.authalic_to_geodetic(beta))


@dataclass(frozen=True)
class PolarLambertAzimuthal:
    """Area projection: Lambert azimuthal equal-area, north polar aspect, WGS 84, lon_0=0."""
    ellipsoid: Ellipsoid = WGS84
    lon0: float = 0.0

    def forward(self, lon, lat) -> tuple[Column, Column]:
        el = self.ellipsoid
        qp = el.q_py(math.pi / 2)
        rho = F.lit(el.a) * F.sqrt(F.greatest(F.lit(0.0), F.lit(qp) - el.q(F.radians(_c(lat)))))
        lam = F.radians(_c(lon) - F.lit(self.lon0))
        return rho * F.sin(lam), -rho * F.cos(lam)


# --- projections from metadata ------------------------------------------------
def _numbers(text: str) -> list[float]:
    return [float(x) for x in re.findall(r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?", text)]


def from_attributes(attrs: dict[str, str]):
    """The projection that CF grid-mapping attributes describe.

    Conformal and equal-area cones with one or two standard parallels, on a sphere
    (``earth_radius``, or equal axes) or an ellipsoid (``semi_major_axis`` with
    ``inverse_flattening`` or ``semi_minor_axis``; WGS 84 where none is given), and the
    polar azimuthal equal-area one.  What can't be read is an error, not a default."""
    def one(*names: str, default: float | None = None) -> float:
        for n in names:
            if attrs.get(n) not in (None, ""):
                found = _numbers(attrs[n])
                if len(found) != 1:
                    raise ValueError(f"{n} must be one number: {attrs[n]!r}")
                return found[0]
        if default is None:
            raise ValueError(f"the grid mapping lacks {' or '.join(names)}")
        return default

    kind = attrs.get("grid_mapping_name")
    if kind not in ("lambert_conformal_conic", "albers_conical_equal_area", "lambert_azimuthal_equal_area"):
        raise ValueError(f"unknown grid mapping {kind!r}")
    a = one("semi_major_axis", "earth_radius", default=WGS84.a)
    given = [n for n in ("inverse_flattening", "semi_minor_axis") if attrs.get(n) not in (None, "")]
    inv_f = 0.0
    if given == ["semi_minor_axis"]:
        b = one("semi_minor_axis")
        inv_f = 0.0 if a == b else a / (a - b)
    elif given:
        inv_f = one("inverse_flattening")
    elif "earth_radius" not in attrs and "semi_major_axis" not in attrs:
        inv_f = WGS84.inv_f
    x0, y0 = one("false_easting", default=0.0), one("false_northing", default=0.0)
    lon0 = one("longitude_of_central_meridian", "longitude_of_projection_origin")
    lat0 = one("latitude_of_projection_origin")
    if kind == "lambert_azimuthal_equal_area":
        if lat0 != 90 or not inv_f or x0 or y0:
            raise ValueError("the azimuthal projection is read for the north pole of an ellipsoid only")
        return PolarLambertAzimuthal(Ellipsoid(a, inv_f), lon0)
    parallels = _numbers(attrs.get("standard_parallel") or "")
    if len(parallels) not in (1, 2):
        raise ValueError(f"one or two standard parallels: {attrs.get('standard_parallel')!r}")
    lat1, lat2 = parallels[0], parallels[-1]
    if kind == "albers_conical_equal_area":
        if not inv_f or lat1 == lat2:
            raise ValueError("the equal-area cone is read for two parallels of an ellipsoid only")
        return AlbersEqualArea(Ellipsoid(a, inv_f), lat1, lat2, lat0, lon0, x0, y0)
    if not inv_f:
        return LambertConformalSphere(a, lat1, lat2, lat0, lon0, x0, y0)
    return LambertConformal(Ellipsoid(a, inv_f), lat1, lat2, lat0, lon0, x0, y0)


def of_catalog(catalog, varname: str = "crs"):
    """The projection of a store, from the attributes of its catalog's ``crs`` row (one small row)."""
    rows = catalog.where(F.col("varname") == varname).select("attrs").limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"the catalog has {len(rows) or 'no'} {varname} row")
    return from_attributes(dict(rows[0]["attrs"] or {}))


def ring_between(source, target):
    """A ring -> ring function from one projection's plane to another's (``to_grid`` or ``area_ring`` of JB10)."""
    return lambda ring: reproject_ring(ring, source.inverse, target.forward)


GRID_LCC = LambertConformalSphere()
POLY_ALBERS = AlbersEqualArea()
AREA_LAEA = PolarLambertAzimuthal()


def reproject_ring(ring, to_lonlat, from_lonlat) -> Column:
    """Apply ``from_lonlat(to_lonlat(vertex))`` to every vertex of a ring, where
    each argument is a function ``(a, b) -> (a', b')`` of columns."""
    def move(p):
        lon, lat = to_lonlat(p["x"], p["y"])
        x, y = from_lonlat(lon, lat)
        return F.struct(x.alias("x"), y.alias("y"))
    return F.transform(_c(ring), move)


def albers_to_grid(ring) -> Column:
    """SC17: polygon ring from the polygons' Albers plane to the grid's LCC plane."""
    return reproject_ring(ring, POLY_ALBERS.inverse, GRID_LCC.forward)


def grid_to_equal_area(ring) -> Column:
    """Ring from the grid's LCC plane to the equal-area (polar LAEA) plane,
    where areas are measured."""
    return reproject_ring(ring, GRID_LCC.inverse, AREA_LAEA.forward)
