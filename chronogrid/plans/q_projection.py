"""Registered query: SC17 reprojection of points derived from ``supplier``."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import projection as pj
from ..sources import fixtures as fx
from ..sources.gridstore import catalog_frame
from .registry import register

L, A, Z = pj.GRID_LCC, pj.POLY_ALBERS, pj.AREA_LAEA
LN, LF, LRHO0 = L._consts()
AN, AC, ARHO0 = A._consts()
E = A.ellipsoid
W = Z.ellipsoid


def _q_sql(phi: str, el: pj.Ellipsoid) -> str:
    e, e2 = el.e, el.e2
    s = f"sin({phi})"
    return (f"({1 - e2!r} * ({s} / (1.0 - {e2!r} * {s} * {s}) - {1 / (2 * e)!r} * "
            f"ln((1.0 - {e!r} * {s}) / (1.0 + {e!r} * {s}))))")


LON = "(-124.0 + 57.0 * ((s_suppkey * 37) % 1000) / 1000.0)"
LAT = "(25.0 + 24.0 * ((s_suppkey * 91) % 1000) / 1000.0)"
_RHO_L = f"({L.radius * LF!r} / pow(tan({math.pi / 4!r} + radians(lat) / 2), {LN!r}))"
_TH_L = f"({LN!r} * radians(lon - ({L.lon0!r})))"
_RHO_A = f"({E.a / AN!r} * sqrt({AC!r} - {AN!r} * {_q_sql('radians(lat)', E)}))"
_TH_A = f"({AN!r} * radians(lon - ({A.lon0!r})))"
_RHO_Z = f"({W.a!r} * sqrt(greatest(0.0, {W.q_py(math.pi / 2)!r} - {_q_sql('radians(lat)', W)})))"

SC17_SQL = f"""WITH p AS (SELECT s_suppkey, CAST({LON} AS DOUBLE) AS lon, CAST({LAT} AS DOUBLE) AS lat FROM supplier),
f AS (SELECT s_suppkey, lon, lat,
  {_RHO_L} * sin({_TH_L}) AS x_lcc, {LRHO0!r} - {_RHO_L} * cos({_TH_L}) AS y_lcc,
  {_RHO_A} * sin({_TH_A}) AS x_aea, {ARHO0!r} - {_RHO_A} * cos({_TH_A}) AS y_aea,
  {_RHO_Z} * sin(radians(lon)) AS x_laea, -{_RHO_Z} * cos(radians(lon)) AS y_laea FROM p)
SELECT s_suppkey, lon, lat, round(x_lcc, 3) AS x_lcc, round(y_lcc, 3) AS y_lcc, round(x_aea, 3) AS x_aea,
  round(y_aea, 3) AS y_aea, round(x_laea, 3) AS x_laea, round(y_laea, 3) AS y_laea,
  round(degrees(atan2(x_lcc, {LRHO0!r} - y_lcc) / {LN!r}) + ({L.lon0!r}), 9) AS lon_back,
  round(degrees(2 * atan(pow({L.radius * LF!r} / sqrt(x_lcc * x_lcc + ({LRHO0!r} - y_lcc) * ({LRHO0!r} - y_lcc)), {1.0 / LN!r})) - {math.pi / 2!r}), 9) AS lat_back
FROM f"""


@register("SC17_reproject", SC17_SQL)
def q_sc17(spark, sf_dir):
    s = fx.table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    p = s.select("s_suppkey",
                 (F.lit(-124.0) + F.lit(57.0) * ((k * 37) % 1000) / 1000.0).cast("double").alias("lon"),
                 (F.lit(25.0) + F.lit(24.0) * ((k * 91) % 1000) / 1000.0).cast("double").alias("lat"))
    lx, ly = L.forward("lon", "lat")
    ax, ay = A.forward("lon", "lat")
    zx, zy = Z.forward("lon", "lat")
    f = p.select("s_suppkey", "lon", "lat", lx.alias("x_lcc"), ly.alias("y_lcc"), ax.alias("x_aea"),
                 ay.alias("y_aea"), zx.alias("x_laea"), zy.alias("y_laea"))
    blon, blat = L.inverse("x_lcc", "y_lcc")
    r = lambda c, d=3: F.round(c, d)  # noqa: E731  (millimetres)
    return f.select("s_suppkey", "lon", "lat", *[r(c).alias(c) for c in
                                                 ("x_lcc", "y_lcc", "x_aea", "y_aea", "x_laea", "y_laea")],
                    r(blon, 9).alias("lon_back"), r(blat, 9).alias("lat_back"))


# --- projections built from the catalog's crs row ---------------------------------
# Two grid mappings, a sphere with two parallels and an ellipsoid with one.
CRS_ROWS = {
    "sphere": {"grid_mapping_name": "lambert_conformal_conic", "standard_parallel": "30.0, 60.0", "latitude_of_projection_origin": "40.0000076294",
               "longitude_of_central_meridian": "-97.0", "earth_radius": "6370000.0", "false_easting": "1000", "false_northing": "-2000"},
    "ellipsoid": {"grid_mapping_name": "lambert_conformal_conic", "standard_parallel": "38.5", "latitude_of_projection_origin": "38.5",
                  "longitude_of_central_meridian": "-97.5", "semi_major_axis": "6378137.0", "inverse_flattening": "298.257222101"}}


def _metadata_sql() -> str:
    """The formulas of the two mappings with their numbers put in by hand: nothing is parsed."""
    e2 = 2 / 298.257222101 - (1 / 298.257222101) ** 2
    e, out = math.sqrt(e2), []
    p1, p2, p0 = (math.radians(v) for v in (30.0, 60.0, 40.0000076294))
    tan = lambda p: math.tan(math.pi / 4 + p / 2)
    n = math.log(math.cos(p1) / math.cos(p2)) / math.log(tan(p2) / tan(p1))
    f = 6370000.0 * math.cos(p1) * tan(p1) ** n / n
    rho = f"({f!r} / pow(tan({math.pi / 4!r} + radians(lat) / 2), {n!r}))"
    out.append(f"SELECT s_suppkey, 'sphere' AS crs, {rho} * sin({n!r} * radians(lon + 97.0)) + 1000.0 AS x, "
               f"{f / tan(p0) ** n!r} - {rho} * cos({n!r} * radians(lon + 97.0)) - 2000.0 AS y FROM p")
    p0 = math.radians(38.5)
    t = lambda p: math.tan(math.pi / 4 - p / 2) / ((1 - e * math.sin(p)) / (1 + e * math.sin(p))) ** (e / 2)
    n = math.sin(p0)
    f = 6378137.0 * math.cos(p0) / math.sqrt(1 - e2 * n * n) / (n * t(p0) ** n)
    es = f"({e!r} * sin(radians(lat)))"
    rho = f"({f!r} * pow(tan({math.pi / 4!r} - radians(lat) / 2) / pow((1.0 - {es}) / (1.0 + {es}), {e / 2!r}), {n!r}))"
    out.append(f"SELECT s_suppkey, 'ellipsoid', {rho} * sin({n!r} * radians(lon + 97.5)), {f * t(p0) ** n!r} - {rho} * cos({n!r} * radians(lon + 97.5)) FROM p")
    return (f"WITH p AS (SELECT s_suppkey, CAST({LON} AS DOUBLE) AS lon, CAST({LAT} AS DOUBLE) AS lat FROM supplier) "
            f"SELECT s_suppkey, crs, round(x, 3) AS x, round(y, 3) AS y, round(lon, 6) AS lon_back, round(lat, 6) AS lat_back "
            f"FROM ({' UNION ALL '.join(out)}) JOIN p USING (s_suppkey)")


@register("SC17_reproject_from_metadata", _metadata_sql())
def q_sc17_metadata(spark, sf_dir):
    """Points of the suppliers in the planes of two catalogs' ``crs`` rows, and back."""
    k = F.col("s_suppkey")
    p = fx.table(spark, sf_dir, "supplier").select(
        "s_suppkey", (F.lit(-124.0) + F.lit(57.0) * ((k * 37) % 1000) / 1000.0).cast("double").alias("lon"),
        (F.lit(25.0) + F.lit(24.0) * ((k * 91) % 1000) / 1000.0).cast("double").alias("lat"))
    frames = []
    for name, attrs in CRS_ROWS.items():
        plane = pj.of_catalog(catalog_frame(spark, [("crs", [], attrs, {}), ("T2D", ["time", "y", "x"], {}, {})]))
        x, y = plane.forward("lon", "lat")
        f = p.select("s_suppkey", F.lit(name).alias("crs"), x.alias("x"), y.alias("y"))
        lon, lat = plane.inverse("x", "y")
        frames.append(f.select("s_suppkey", "crs", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"),
                               F.round(lon, 6).alias("lon_back"), F.round(lat, 6).alias("lat_back")))
    return frames[0].unionByName(frames[1])
