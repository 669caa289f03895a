"""Regions, quality checks, manifests, projections and plan shape."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronogrid.config import ChunkPlan, GridSpec
from chronogrid.functions import projection as pj
from chronogrid.operators import daily, quality as qa, regions
from chronogrid.sources import fixtures as fx
from chronogrid.sources import manifest

from .conftest import SF001


# --- independent brute-force clip (numpy), used only to check SC16 ------------
def _clip(poly, x0, y0, x1, y1):
    def half(pts, inside, inter):
        out = []
        for i, cur in enumerate(pts):
            prev = pts[i - 1]
            if inside(cur):
                if not inside(prev):
                    out.append(inter(prev, cur))
                out.append(cur)
            elif inside(prev):
                out.append(inter(prev, cur))
        return out

    def ix(c):
        return lambda p, q: (c, p[1] + (c - p[0]) * (q[1] - p[1]) / (q[0] - p[0]))

    def iy(c):
        return lambda p, q: (p[0] + (c - p[1]) * (q[0] - p[0]) / (q[1] - p[1]), c)

    pts = list(poly)
    for inside, inter in ((lambda p: p[0] >= x0, ix(x0)), (lambda p: p[0] <= x1, ix(x1)),
                          (lambda p: p[1] >= y0, iy(y0)), (lambda p: p[1] <= y1, iy(y1))):
        pts = half(pts, inside, inter) if pts else pts
    if len(pts) < 3:
        return 0.0
    a = np.array(pts)
    return abs(np.dot(a[:, 0], np.roll(a[:, 1], -1)) - np.dot(np.roll(a[:, 0], -1), a[:, 1])) / 2


def test_ring_clip_matches_brute_force(spark):
    polys = fx.nation_triangles(spark, SF001)
    from chronogrid.operators import grid as gops
    got = {(r["poly_id"], r["y"], r["x"]): r["area"] for r in
           regions.overlay(polys, gops.make_cells(spark, 3, 4), regions.CellGrid()).collect()}
    want = {}
    for p in polys.collect():
        ring = [(v["x"], v["y"]) for v in p["ring"]]
        for y in range(3):
            for x in range(4):
                a = _clip(ring, x, y, x + 1, y + 1)
                if a > 0:
                    want[(p["poly_id"], y, x)] = a
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_rectangle_weights_and_general_clip_agree(spark):
    polys = fx.region_rectangles(spark, SF001)
    cells = fx.hourly_grid(spark, SF001).select("y", "x").distinct()
    cg = regions.CellGrid(0, 0, 1, 1, 2, 2)
    rect = regions.weights(polys, regions.overlay(polys, cells, cg, rectangles=True))
    ring = regions.weights(polys, regions.overlay(polys, cells, cg, rectangles=False))
    a = {(r[0], r[1], r[2]): r[3] for r in rect.collect()}
    b = {(r[0], r[1], r[2]): r[3] for r in ring.collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-12) for k in a)
    sums = {r[0]: r[1] for r in rect.groupBy("poly_id").agg(F.sum("w")).collect()}
    assert sums[0] == pytest.approx(1) and sums[1] == pytest.approx(1) and sums[2] == pytest.approx(1)
    assert sums[3] == pytest.approx(0.5 / 0.7) and 4 not in sums


def test_weights_join_is_broadcast(spark):
    polys = fx.region_rectangles(spark, SF001)
    cells = fx.hourly_grid(spark, SF001).select("y", "x").distinct()
    w = regions.weights(polys, regions.overlay(polys, cells, regions.CellGrid(0, 0, 1, 1, 2, 2), True))
    d = daily.daily_reduce(fx.hourly_grid(spark, SF001), fx.F1_SPEC.base_date)
    plan = regions.join_weights(d, w)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_head_per_group_limits_before_shuffle(spark):
    df = regions.head_per_group(fx.daily_grid(spark, SF001), "y", ["time"], 5)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_daily_plan_has_no_python(spark):
    d = daily.daily_reduce(fx.hourly_grid(spark, SF001), fx.F1_SPEC.base_date)
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "HashAggregate" in plan


def test_cell_absent_all_year_counts_fully_missing(spark):
    axis = spark.createDataFrame([(dt.datetime(2023, 12, 31) + dt.timedelta(days=i),) for i in range(3)], "time timestamp_ntz")
    g = spark.createDataFrame([(dt.datetime(2023, 12, 31), 0, 0, 1.0), (dt.datetime(2024, 1, 1), 0, 0, 1.0),
                               (dt.datetime(2024, 1, 2), 0, 0, None), (dt.datetime(2023, 12, 31), 0, 1, 2.0)],
                              "time timestamp_ntz, y int, x int, v double")
    got = {(r["year"]): r["max_missing"] for r in qa.max_missing(g, axis, 2, ["v"]).collect()}
    assert got == {2024: 2}                       # cell (0,1) has no row in 2024
    yr = {r["year"]: r for r in qa.yearly_range(g, axis, 2, ["v"]).collect()}
    assert yr[2023]["min_value"] == 1.0 and yr[2024]["min_value"] is None


def test_oct1_fallback_and_rest_of_day_dropped(spark):
    spec = GridSpec("1979-10-01 00:00:00", "hour", ChunkPlan(24))        # one day per chunk
    chunks = spark.createDataFrame([(0,), (1,)], "chunk int")
    m = manifest.hourly_manifest(chunks, spec, "/w")
    listing = spark.createDataFrame(
        [("/w/WY1979/197910010000.LDASIN_DOMAIN1",), ("/w/WY1980/197910010500.LDASIN_DOMAIN1",),
         ("/w/WY1980/197910020000.LDASIN_DOMAIN1",), ("/w/WY1980/197910020300.LDASIN_DOMAIN1",)], "path string")
    got = sorted(r["path"] for r in manifest.verified_manifest(m, listing, "/w").collect())
    assert got == ["/w/WY1979/197910010000.LDASIN_DOMAIN1", "/w/WY1980/197910020000.LDASIN_DOMAIN1",
                   "/w/WY1980/197910020300.LDASIN_DOMAIN1"]


def test_projection_worked_examples_and_limits(spark):
    df = spark.createDataFrame([(-75.0, 35.0)], "lon double, lat double")
    lx, ly = pj.LambertConformalSphere(1.0, 33, 45, 23, -96).forward("lon", "lat")
    ax, ay = pj.AlbersEqualArea(pj.Ellipsoid(6378206.4, 294.9786982), 29.5, 45.5, 23, -96).forward("lon", "lat")
    r = df.select(lx, ly, ax, ay).first()
    assert r[0] == pytest.approx(0.2966785, abs=5e-7) and r[1] == pytest.approx(0.2462112, abs=5e-7)
    assert r[2] == pytest.approx(1885472.7, abs=0.1) and r[3] == pytest.approx(1535925.0, abs=0.1)
    # polar azimuthal equal-area tends to rho = 2 a sin(colatitude / 2) on a sphere
    zx, zy = pj.PolarLambertAzimuthal(pj.Ellipsoid(6378137.0, 1e9), 0.0).forward("lon", "lat")
    z = df.select(F.sqrt(zx * zx + zy * zy)).first()[0]
    assert z == pytest.approx(2 * 6378137.0 * math.sin(math.radians(55) / 2), rel=1e-6)
    blon, blat = pj.POLY_ALBERS.inverse(*pj.POLY_ALBERS.forward("lon", "lat"))
    b = df.select(blon, blat).first()
    assert b[0] == pytest.approx(-75.0, abs=1e-9) and b[1] == pytest.approx(35.0, abs=1e-7)


def test_weights_from_albers_polygons_with_equal_area(spark):
    """A square polygon given in the Albers plane, reprojected to the grid's
    LCC plane, clipped against 4 km cells, areas measured in the polar
    equal-area plane: a polygon inside the grid has weights summing to 1."""
    from chronogrid.functions.geometry import point
    from chronogrid.operators import grid as gops
    from chronogrid.plans import regions as region_jobs
    from chronogrid.session import scratch_path
    # Albers coordinates of a 20 km square near (-100E, 40N)
    lon, lat = pj.POLY_ALBERS.forward(F.lit(-100.0), F.lit(40.0))
    c = spark.range(1).select(lon.alias("cx"), lat.alias("cy"))
    polys = c.select(F.lit(7).cast("long").alias("poly_id"), F.array(
        point(F.col("cx") - 10000, F.col("cy") - 10000), point(F.col("cx") + 10000, F.col("cy") - 10000),
        point(F.col("cx") + 10000, F.col("cy") + 10000), point(F.col("cx") - 10000, F.col("cy") + 10000)).alias("ring"))
    # grid of 4 km cells whose origin is 40 km west/south of the polygon centre (in LCC)
    gx, gy = pj.GRID_LCC.forward(F.lit(-100.0), F.lit(40.0))
    x0, y0 = spark.range(1).select(gx, gy).first()
    cg = regions.CellGrid(x0 - 40000.0, y0 - 40000.0, 4000.0, 4000.0, 20, 20)
    cells = gops.make_cells(spark, 20, 20)
    path = scratch_path(spark, "t-weights")
    region_jobs.build_weights(polys, cells, cg, path, to_grid=pj.albers_to_grid, area_ring=pj.grid_to_equal_area)
    w = region_jobs.read_weights(spark, path)
    assert 25 <= w.count() <= 49
    assert w.agg(F.sum("w")).first()[0] == pytest.approx(1.0, abs=1e-6)


def test_decode_packed_from_catalog(spark):
    from chronogrid.functions.values import decode_packed
    from chronogrid.sources.gridstore import catalog_frame
    cat = catalog_frame(spark, [("T", ["time", "y", "x"], {}, {"_FillValue": "-32768", "scale_factor": "0.01",
                                                                "add_offset": "273.15"}),
                                ("P", ["time", "y", "x"], {}, {"dtype": "float64"})])
    df = spark.createDataFrame([(1000, 5.0), (-32768, 6.0)], "T int, P double")
    got = decode_packed(df, cat).collect()
    assert got[0]["T"] == pytest.approx(283.15) and got[1]["T"] is None and got[1]["P"] == 6.0
