"""Exact cover of grid cells by polygons, along scan lines.

Every edge of a ring is cut at the rows and columns of the grid.  A piece of an edge
that lies in one cell adds two numbers there: how far it rises, and the area between it
and the cell's right side.  Along a row, the running sum of the rises left of a cell is
the cover that all further pieces start from, so the cover of a crossed cell is that sum
plus its own areas, and the cells between two crossed ones are a span of one cover:
nothing is clipped and rings are never copied to cells.  Rows are in proportion to the
polygons' perimeters until the spans expand.

Rises are differences of fixed-point cuts, so they cancel exactly around a closed ring:
outside it the running sum is exactly zero, and results don't depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as geo

#: Fixed-point units of a cell's side; a row of a polygon may be crossed 2 ** 15 times one way.
UNIT = float(1 << 48)
#: Covers below this share of a cell are rounding, not overlap.
SLIVER = 1e-9


def spread(polys: DataFrame) -> DataFrame:
    """``polys`` dealt over all tasks: a table of rings is small as a file, the work on a ring isn't."""
    return polys.repartition(int(polys.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _fixed(c: Column) -> Column:
    return F.round(c * UNIT).cast("long")


def _pick(at: Column, edge: dict[str, Column]) -> Column:
    """Column position of an edge where its row position is ``at``; exact at its ends."""
    u0, v0, u1, v1 = (edge[k] for k in ("u0", "v0", "u1", "v1"))
    return (F.when(at == v0, u0).when(at == v1, u1)
            .otherwise(u0 + (at - v0) / (v1 - v0) * (u1 - u0)))


def ring_edges(polys: DataFrame, cg) -> DataFrame:
    """``poly_id, turn, u0, v0, u1, v1``: the edges of every ring in cell units that aren't level.

    ``turn`` makes the cover of the ring positive, whichever way it runs, and that of a
    hole negative.  Rings of fewer than three vertices cover nothing."""
    hole = F.when(F.col("hole"), F.lit(-1)).otherwise(F.lit(1)) if "hole" in polys.columns else F.lit(1)
    r = F.col("ring")
    n = F.size(r)
    nxt = lambda i: F.get(r, F.pmod(i + 1, n))
    at = F.sequence(F.lit(0), n - 1)
    turn = F.aggregate(F.transform(at, lambda i: F.get(r, i)["x"] * nxt(i)["y"] - nxt(i)["x"] * F.get(r, i)["y"]),
                       F.lit(0.0), lambda a, t: a + t)
    u, v = (lambda p: (p["x"] - cg.x0) / cg.dx), (lambda p: (p["y"] - cg.y0) / cg.dy)
    edges = F.transform(at, lambda i: F.struct(u(F.get(r, i)).alias("u0"), v(F.get(r, i)).alias("v0"), u(nxt(i)).alias("u1"), v(nxt(i)).alias("v1")))
    return (polys.where(n >= 3).select("poly_id", (F.signum(turn).cast("int") * hole).alias("turn"), F.explode(edges).alias("e"))
            .select("poly_id", "turn", "e.*").where("turn <> 0 AND v0 <> v1"))


def crossed_cells(polys: DataFrame, cg) -> DataFrame:
    """``poly_id, y, x, rise, area``: what the edges' pieces add to each crossed cell, in fixed-point units.

    Parts of an edge left of the grid count as its left side; those right, above and
    below of it don't reach any cell."""
    e = ring_edges(spread(polys), cg)
    low, high = F.least("v0", "v1"), F.greatest("v0", "v1")
    first, last = F.floor(low).cast("int"), (F.ceil(high) - 1).cast("int")
    first = F.greatest(first, F.lit(0))
    if cg.ny is not None:
        last = F.least(last, F.lit(cg.ny - 1))
    e = e.where(first <= last).select("*", F.explode(F.sequence(first, last)).alias("y"))
    edge = {k: F.col(k) for k in ("u0", "v0", "u1", "v1")}
    va, vb = F.greatest(low, F.col("y").cast("double")), F.least(high, (F.col("y") + 1).cast("double"))
    e = e.select("poly_id", "y", "u0", "v0", "u1", "v1", (va - F.col("y")).alias("va"), (vb - F.col("y")).alias("vb"),
                 _pick(va, edge).alias("ua"), _pick(vb, edge).alias("ub"),
                 (F.col("turn") * F.when(F.col("v1") < F.col("v0"), 1).otherwise(-1)).alias("way"))
    # a ring that turns left goes down on its left side: cover begins there
    # u and v (from the row's foot) at the piece's left and right end
    rising = F.col("ua") <= F.col("ub")
    e = e.select("poly_id", "y", "way", F.least("ua", "ub").alias("ul"), F.greatest("ua", "ub").alias("ur"),
                 F.when(rising, F.col("va")).otherwise(F.col("vb")).alias("vl"),
                 F.when(rising, F.col("vb")).otherwise(F.col("va")).alias("vr"))
    flat = F.col("ul") == F.col("ur")
    cut = lambda u: F.when(u <= F.col("ul"), F.col("vl")).when(u >= F.col("ur"), F.col("vr")).otherwise(
        F.col("vl") + (u - F.col("ul")) / (F.col("ur") - F.col("ul")) * (F.col("vr") - F.col("vl")))
    rise = lambda a, b: F.abs(_fixed(b) - _fixed(a)) * F.col("way")
    c0 = F.floor("ul").cast("int")
    c1 = F.greatest(c0, (F.ceil("ur") - 1).cast("int"))
    c0 = F.greatest(c0, F.lit(0))
    if cg.nx is not None:
        c1 = F.least(c1, F.lit(cg.nx - 1))

    def piece(c: Column) -> Column:
        a, b = F.greatest(c.cast("double"), F.col("ul")), F.least((c + 1).cast("double"), F.col("ur"))
        dy = F.when(flat, rise(F.col("vl"), F.col("vr"))).otherwise(rise(cut(a), cut(b)))
        middle = F.when(flat, F.col("ul")).otherwise((a + b) / 2)
        return F.struct(c.alias("x"), dy.alias("rise"), F.round(dy * ((c + 1) - middle)).cast("long").alias("area"))
    none = F.expr("cast(array() as array<struct<x:int,rise:bigint,area:bigint>>)")
    inside = F.when(c0 <= c1, F.transform(F.sequence(c0, c1), piece)).otherwise(none)
    out = F.when(flat, rise(F.col("vl"), F.col("vr"))).otherwise(rise(F.col("vl"), cut(F.lit(0.0))))
    left = F.when(F.col("ul") < 0, F.array(F.struct(F.lit(0).alias("x"), out.alias("rise"), out.alias("area")))).otherwise(none)
    pieces = e.select("poly_id", "y", F.explode(F.concat(left, inside)).alias("p"))
    return (pieces.select("poly_id", "y", "p.*").groupBy("poly_id", "y", "x")
            .agg(F.sum("rise").alias("rise"), F.sum("area").alias("area")))


def cover_spans(polys: DataFrame, cg) -> DataFrame:
    """``poly_id, y, x, n, cover``: runs of ``n`` cells from column ``x`` on of one cover, in cells.

    Crossed cells are runs of one.  A row of a polygon has as many runs as crossed cells
    twice at most; runs of no cover are left out."""
    row = Window.partitionBy("poly_id", "y").orderBy("x")
    before = F.coalesce(F.sum("rise").over(row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    following = F.lead("x").over(row)
    if cg.nx is not None:
        following = F.coalesce(following, F.lit(cg.nx))
    c = crossed_cells(polys, cg).select("poly_id", "y", "x", "rise", "area", before.alias("before"), following.alias("next"))
    n = F.coalesce(F.col("next") - F.col("x") - 1, F.lit(0))
    runs = F.array(F.struct(F.col("x"), F.lit(1).alias("n"), ((F.col("before") + F.col("area")) / UNIT).alias("cover")),
                   F.struct((F.col("x") + 1).alias("x"), n.alias("n"), ((F.col("before") + F.col("rise")) / UNIT).alias("cover")))
    return (c.select("poly_id", "y", F.explode(runs).alias("r")).select("poly_id", "y", "r.*")
            .where((F.col("n") > 0) & (F.col("cover") > SLIVER)))


def cell_cover(polys: DataFrame, cg) -> DataFrame:
    """``poly_id, y, x, cover``: the share of every cell that its polygon covers (parts add up, holes take away).

    ``polys`` are ``poly_id, ring`` and optionally ``hole``; null rings cover nothing."""
    spans = cover_spans(polys, cg)
    return spans.select("poly_id", "y", F.explode(F.sequence(F.col("x"), F.col("x") + F.col("n") - 1)).alias("x"), "cover")


def cell_ring(cg) -> Column:
    """The rectangle of the cell (y, x)."""
    x0, y0 = F.lit(cg.x0) + F.col("x") * cg.dx, F.lit(cg.y0) + F.col("y") * cg.dy
    return geo.rectangle_ring(x0, y0, x0 + F.lit(cg.dx), y0 + F.lit(cg.dy))
