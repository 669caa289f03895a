"""Polygon overlay, area weights and area-weighted averages over a grid.

Polygons: ``(poly_id BIGINT, ring ARRAY<STRUCT<x,y>>)`` in grid coordinates
(after any reprojection).  A polygon of several parts has a row for each; with a
column ``hole BOOLEAN`` the rings so marked are taken away.  Grid cells are regular: cell (y, x) covers
``[x0 + x*dx, x0 + (x+1)*dx] x [y0 + y*dy, y0 + (y+1)*dy]``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..session import materialise
from . import coverage
from .joins import size_checked_broadcast

# Estimated bytes per weight row (poly_id, y, x, w, n_cells) for the broadcast check.
WEIGHT_ROW_BYTES = 40

# Sums of weights and weighted values: order-independent, to 18 decimals.
SUM_TYPE = "decimal(38,18)"


@dataclass(frozen=True)
class CellGrid:
    x0: float = 0.0
    y0: float = 0.0
    dx: float = 1.0
    dy: float = 1.0
    nx: int | None = None
    ny: int | None = None


# --- JN07 polygon_cell_overlay + SC16 clip_area -------------------------------
def _cell_ranges(polys: DataFrame, cg: CellGrid, *columns) -> DataFrame:
    """``poly_id, columns, y, x`` of every cell in each ring's bounding box (two exploded
    sequences: an equi-join key instead of a range join)."""
    bx0, by0, bx1, by1 = geo.ring_bounds("ring")
    ix0 = F.floor((bx0 - cg.x0) / cg.dx).cast("int")
    ix1 = (F.ceil((bx1 - cg.x0) / cg.dx) - 1).cast("int")
    iy0 = F.floor((by0 - cg.y0) / cg.dy).cast("int")
    iy1 = (F.ceil((by1 - cg.y0) / cg.dy) - 1).cast("int")
    if cg.nx is not None:
        ix0, ix1 = F.greatest(ix0, F.lit(0)), F.least(ix1, F.lit(cg.nx - 1))
    if cg.ny is not None:
        iy0, iy1 = F.greatest(iy0, F.lit(0)), F.least(iy1, F.lit(cg.ny - 1))
    p = polys.select("poly_id", *columns, _sign(polys).alias("sign"), ix0.alias("ix0"), ix1.alias("ix1"), iy0.alias("iy0"), iy1.alias("iy1"))
    p = p.where((F.col("ix0") <= F.col("ix1")) & (F.col("iy0") <= F.col("iy1"))).withColumn("y", F.explode(F.sequence("iy0", "iy1")))
    return p.withColumn("x", F.explode(F.sequence("ix0", "ix1"))).drop("ix0", "ix1", "iy0", "iy1")


def _sign(polys: DataFrame):
    return F.when(F.col("hole"), F.lit(-1.0)).otherwise(F.lit(1.0)) if "hole" in polys.columns else F.lit(1.0)


def _cell_box(cg: CellGrid):
    cx0, cy0 = F.lit(cg.x0) + F.col("x") * cg.dx, F.lit(cg.y0) + F.col("y") * cg.dy
    return cx0, cy0, cx0 + cg.dx, cy0 + cg.dy


def _summed(pieces: DataFrame) -> DataFrame:
    """Parts of a polygon in one cell together."""
    pieces = pieces.select("poly_id", "y", "x", (F.col("sign") * F.col("area")).alias("area")).where(F.col("area") != 0)
    return pieces.groupBy("poly_id", "y", "x").agg(F.sum("area").alias("area")).where(F.col("area") > 0)


def overlay(polys: DataFrame, cells: DataFrame, cg: CellGrid, rectangles: bool = False,
            area_ring=None) -> DataFrame:
    """``(poly_id, y, x, area)`` for every cell meeting a polygon with area > 0; cells
    absent from ``cells`` drop out.

    Rings are followed along scan lines (``coverage``): work is in proportion to their
    perimeter and the cells they cover, and no ring is copied to a cell.  ``rectangles``
    (axis-aligned ones) need only their bounds.  With ``area_ring`` (a ring -> ring
    column function, e.g. into an equal-area plane) areas are measured after that
    transformation: whole cells as such, and only crossed cells are clipped."""
    if rectangles and area_ring is None:
        bounds = F.struct(*[b.alias(n) for b, n in zip(geo.ring_bounds("ring"), ("x0", "y0", "x1", "y1"))]).alias("b")
        cand = _cell_ranges(polys, cg, bounds).join(cells.select("y", "x"), ["y", "x"], "inner")
        return _summed(cand.withColumn("area", geo.box_overlap_area("b.x0", "b.y0", "b.x1", "b.y1", *_cell_box(cg))))
    cover = coverage.cell_cover(polys, cg).join(cells.select("y", "x"), ["y", "x"], "inner")
    if area_ring is None:
        return cover.select("poly_id", "y", "x", (F.col("cover") * (cg.dx * cg.dy)).alias("area"))
    cover = materialise(cover, "cover")
    whole = cover.where("cover = 1").select("poly_id", "y", "x", geo.ring_area(area_ring(coverage.cell_ring(cg))).alias("area"))
    crossed = cover.where("cover <> 1").join(polys.withColumn("sign", _sign(polys)).select("poly_id", "sign", "ring"), "poly_id")
    return whole.unionByName(_summed(crossed.withColumn("area", geo.ring_area(area_ring(geo.clip_ring_to_box("ring", *_cell_box(cg)))))))


def clipped_overlay(polys: DataFrame, cells: DataFrame, cg: CellGrid) -> DataFrame:
    """The same as ``overlay`` by clipping every cell of the bounding box (Sutherland-Hodgman):
    for few small rings, and to check the scan lines."""
    cand = _cell_ranges(polys, cg, "ring").join(cells.select("y", "x"), ["y", "x"], "inner")
    return _summed(cand.withColumn("area", geo.ring_box_area("ring", *_cell_box(cg))))


# --- AG11 weight_normalise ----------------------------------------------------
def weights(polys: DataFrame, overlap: DataFrame, area_ring=None) -> DataFrame:
    """Weight = overlap area / polygon area, both summed over the polygon's parts;
    areas in the plane given by ``area_ring`` if any."""
    ring = area_ring(F.col("ring")) if area_ring is not None else F.col("ring")
    pa = (coverage.spread(polys).select("poly_id", (_sign(polys) * geo.ring_area(ring)).alias("a"))
          .groupBy("poly_id").agg(F.sum("a").alias("poly_area")))
    return (overlap.join(pa, "poly_id", "inner")
            .select("poly_id", "y", "x", (F.col("area") / F.col("poly_area")).alias("w")))


# --- JN06 grid_weights_join ---------------------------------------------------
def with_cell_count(w: DataFrame) -> DataFrame:
    """Weights plus ``n_cells``, the number of the polygon's cells; ``w`` is written once first."""
    if "n_cells" in w.columns:
        return w
    w = materialise(w, "weights")
    return w.join(w.groupBy("poly_id").agg(F.count("*").alias("n_cells")), "poly_id")


def join_weights(grid: DataFrame, w: DataFrame, checked: bool = True) -> DataFrame:
    """Each polygon's cells with their values: grid x weights on (y, x), and
    ``n_cells``, the number of the polygon's cells.  The weight table (polygons x
    their cells, independent of the time length) is broadcast when its counted size
    fits; otherwise both sides shuffle: a store whose weights are larger is bucketed
    by tile and joined by ``plans.regions.tile_product``."""
    w = with_cell_count(w)
    side = size_checked_broadcast(w, WEIGHT_ROW_BYTES) if checked else w
    return grid.join(side, ["y", "x"], "inner")


# --- AG10 weighted_mean -------------------------------------------------------
def weighted_mean(joined: DataFrame, variables, keys=("poly_id", "time"), strict: bool = True) -> DataFrame:
    """``sum(w*v) / sum(w)`` per polygon and time for every variable at once.

    Strict: NULL when any weighted cell of the polygon is missing, be its value NULL
    or its row absent.  Otherwise the missing cells are left out of both sums.  Sums accumulate in a fixed
    decimal so results do not depend on row order."""
    aggs = []
    for v in variables:
        wv = F.sum((F.col("w") * F.col(v)).cast(SUM_TYPE)).cast("double")
        w_present = F.sum(F.when(F.col(v).isNotNull(), F.col("w")).cast(SUM_TYPE)).cast("double")
        mean = wv / w_present
        if strict:
            mean = F.when(F.count(v) == F.max("n_cells"), mean)
        aggs.append(mean.alias(v))
    return joined.groupBy(*keys).agg(*aggs)


# --- AG14 polygon_count -------------------------------------------------------
def polygon_count(polys: DataFrame) -> DataFrame:
    return polys.agg(F.count("*").alias("n_polygons"))


# --- WN02 head_per_group / SL03 head ------------------------------------------
def head_per_group(df: DataFrame, key: str, order, n: int = 5) -> DataFrame:
    """First ``n`` rows of every group.  ``row_number() <= n`` is planned with a
    partial group limit before the shuffle, so a hot key ships at most ``n``
    rows per map task."""
    from pyspark.sql import Window
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def head(df: DataFrame, order, n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)
