"""Scan-line coverage of cells against clipping, analytic areas and its plan."""

import random

import pytest

from chronogrid.operators import coverage, regions
from chronogrid.operators import grid as gops

SCHEMA = "poly_id long, ring array<struct<x: double, y: double>>, hole boolean"


def compare(spark, rows, ny, nx, cg):
    polys = spark.createDataFrame(rows, SCHEMA)
    cells = gops.make_cells(spark, ny, nx)
    want = {(r.poly_id, r.y, r.x): r.area for r in regions.clipped_overlay(polys, cells, cg).collect()}
    found = regions.overlay(polys, cells, cg).collect()
    got = {(r.poly_id, r.y, r.x): r.area for r in found}
    assert len(found) == len(got)
    for k in want.keys() | got.keys():
        assert got.get(k, 0.0) == pytest.approx(want.get(k, 0.0), abs=1e-8 * cg.dx * cg.dy), k
    return got


def star(rng, cx, cy, n, least, most):
    """A ring around a centre: simple, often concave (turns of less than half a circle)."""
    import math
    angles = [2 * math.pi * (k + rng.uniform(0.1, 0.5)) / n for k in range(n)]
    return [(cx + r * math.cos(a), cy + r * math.sin(a)) for a in angles for r in [rng.uniform(least, most)]]


@pytest.mark.parametrize("seed", range(3))
def test_random_rings(spark, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(40):
        ring = star(rng, rng.uniform(-2, 14), rng.uniform(-2, 10), rng.randint(3, 12), 0.2, 5)
        if k % 2:
            ring.reverse()
        if k % 4 == 0:   # vertices and edges on grid lines
            a, b, w, h = rng.randint(-2, 10), rng.randint(-2, 6), rng.randint(1, 6), rng.randint(1, 4)
            ring = [(float(a), float(b)), (float(a + w), float(b)), (float(a + w), b + h + 0.5), (a + 0.5, b + h + 0.5), (float(a), b + h - 0.5)]
        rows.append((k % 30, ring, False))          # some polygons have two parts
        if k % 5 == 0:
            rows.append((k % 30, [(sum(p[0] for p in ring) / len(ring) * 0.5 + x * 0.5, sum(p[1] for p in ring) / len(ring) * 0.5 + y * 0.5)
                                  for x, y in ring[:3]], True))
    cg = regions.CellGrid(0.0, 0.0, 1.0, 1.0, 12, 8) if seed else regions.CellGrid(-1.0, 0.5, 0.75, 1.25, 12, 8)
    clip = regions.CellGrid(cg.x0, cg.y0, cg.dx, cg.dy, 12, 8)
    # holes beyond the ring make negative covers that neither way returns
    compare(spark, rows, 8, 12, clip)


def test_awkward_rings(spark):
    rows = [(1, [(0.0, 0.0), (3.0, 0.0), (3.0, 2.0), (0.0, 2.0)], False),           # exactly cells
            (2, [(-5.0, -5.0), (50.0, -5.0), (50.0, 50.0), (-5.0, 50.0)], False),   # around the whole grid
            (3, [(1.5, 1.5), (1.5, 1.5), (1.5, 1.5)], False), (4, [(0.0, 0.0), (1.0, 1.0)], False), (5, [], False), (6, None, False),
            (7, [(-3.0, 0.25), (-1.0, 0.25), (-1.0, 0.75)], False),                 # left of the grid
            (8, [(20.0, 0.0), (30.0, 0.0), (30.0, 1.0)], False),                    # right of it
            (9, [(0.0, 0.0), (4.0, 0.001), (4.0, 0.0)], False),                     # almost level
            (10, [(0.5, 0.5), (3.5, 0.5), (3.5, 3.5), (0.5, 3.5)], None), (10, [(1.0, 1.0), (1.0, 3.0), (3.0, 3.0), (3.0, 1.0)], True)]
    got = compare(spark, rows, 4, 4, regions.CellGrid(nx=4, ny=4))
    assert {k for k in got if k[0] == 1} == {(1, y, x) for y in range(2) for x in range(3)}
    assert all(got[2, y, x] == 1.0 for y in range(4) for x in range(4))
    assert not {k[0] for k in got} & {3, 4, 5, 6, 7, 8}
    assert (10, 1, 1) not in got and got[10, 0, 0] == 0.25


def test_rows_follow_the_perimeter(spark):
    """A ring over 1000 x 1000 cells makes runs in proportion to its sides, and rings don't travel."""
    ring = [(0.5, 0.5), (999.5, 0.5), (999.5, 999.5), (0.5, 999.5)]
    polys = spark.createDataFrame([(1, ring, False)], SCHEMA)
    cg = regions.CellGrid(nx=1000, ny=1000)
    spans = coverage.cover_spans(polys, cg)
    assert spans.count() <= 3 * 1000 + 2000
    assert spans.selectExpr("sum(n * cover)").first()[0] == pytest.approx(999.0 ** 2)
    plan = spans._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("Generate explode")]          # rings end where they are taken apart into edges
    assert "ring#" not in above
    assert coverage.cell_cover(polys, cg).count() == 1_000_000


def test_other_plane(spark):
    """Areas in a plane twice as wide: whole cells are not clipped, crossed ones are."""
    from pyspark.sql import functions as F
    wide = lambda r: F.transform(r, lambda p: F.struct((p["x"] * 2).alias("x"), p["y"].alias("y")))
    rng = random.Random(5)
    rows = [(k, star(rng, 6, 4, 9, 1, 4), False) for k in range(5)] + [(0, star(rng, 6, 4, 5, 0.2, 0.9), True)]
    polys, cells, cg = spark.createDataFrame(rows, SCHEMA), gops.make_cells(spark, 8, 12), regions.CellGrid(nx=12, ny=8)
    got = {(r.poly_id, r.y, r.x): r.area for r in regions.overlay(polys, cells, cg, area_ring=wide).collect()}
    plain = {(r.poly_id, r.y, r.x): r.area for r in regions.overlay(polys, cells, cg).collect()}
    assert got.keys() == plain.keys()
    assert all(got[k] == pytest.approx(2 * plain[k], abs=1e-9) for k in got)
