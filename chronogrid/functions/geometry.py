"""Planar geometry as Spark column expressions.

A ring is ``ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>`` (closing vertex not
repeated).  Clipping a ring by an axis-aligned cell uses the
Sutherland-Hodgman algorithm, one half-plane at a time, written with array
higher-order functions (``transform``/``flatten``/``aggregate``) so it runs in
the JVM; area is the shoelace formula.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<x: double, y: double>"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _let(value: Column, body) -> Column:
    """Evaluate ``body`` with ``value`` bound to a lambda variable, so a
    complex value referenced many times is computed once (no expression
    blow-up when clip steps are chained)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def point(x, y) -> Column:
    return F.struct(_c(x).cast("double").alias("x"), _c(y).cast("double").alias("y"))


def rectangle_ring(x0, y0, x1, y1) -> Column:
    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1))


def ring_area(ring) -> Column:
    """Absolute shoelace area of a ring."""
    return _let(_c(ring), _ring_area)


def _ring_area(r: Column) -> Column:
    n = F.size(r)
    terms = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: (
        F.element_at(r, i + 1)["x"] * F.element_at(r, F.pmod(i + 1, n) + 1)["y"]
        - F.element_at(r, F.pmod(i + 1, n) + 1)["x"] * F.element_at(r, i + 1)["y"]))
    s = F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
    return F.when(n >= 3, F.abs(s) / 2.0).otherwise(F.lit(0.0))


def ring_bounds(ring) -> tuple[Column, Column, Column, Column]:
    r = _c(ring)
    xs = F.transform(r, lambda p: p["x"])
    ys = F.transform(r, lambda p: p["y"])
    return F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)


def _clip_half_plane(ring: Column, axis: str, bound: Column, keep_greater: bool) -> Column:
    """Vertices of ``ring`` clipped to ``axis >= bound`` (or ``<=``)."""
    return _let(ring, lambda r: _clip_step(r, axis, bound, keep_greater))


def _clip_step(ring: Column, axis: str, bound: Column, keep_greater: bool) -> Column:
    other = "y" if axis == "x" else "x"
    n = F.size(ring)

    def inside(p):
        return p[axis] >= bound if keep_greater else p[axis] <= bound

    def cross(p, q):
        t = (bound - p[axis]) / (q[axis] - p[axis])
        o = p[other] + t * (q[other] - p[other])
        return F.struct(bound.alias("x"), o.alias("y")) if axis == "x" else F.struct(o.alias("x"), bound.alias("y"))

    def step(i):
        cur = F.element_at(ring, i + 1)
        prev = F.element_at(ring, F.pmod(i - 1, n) + 1)
        return (F.when(inside(cur) & inside(prev), F.array(cur))
                .when(inside(cur), F.array(cross(prev, cur), cur))
                .when(inside(prev), F.array(cross(prev, cur)))
                .otherwise(F.array().cast(f"array<{POINT}>")))

    pieces = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), step)
    return F.when(n > 0, F.flatten(pieces)).otherwise(F.array().cast(f"array<{POINT}>"))


def clip_ring_to_box(ring, x0, y0, x1, y1) -> Column:
    box = F.struct(_c(x0).cast("double").alias("x0"), _c(y0).cast("double").alias("y0"),
                   _c(x1).cast("double").alias("x1"), _c(y1).cast("double").alias("y1"))

    def body(b):
        r = _c(ring).cast(f"array<{POINT}>")
        r = _clip_half_plane(r, "x", b["x0"], True)
        r = _clip_half_plane(r, "x", b["x1"], False)
        r = _clip_half_plane(r, "y", b["y0"], True)
        return _clip_half_plane(r, "y", b["y1"], False)
    return _let(box, body)


# --- SC16 clip_area -----------------------------------------------------------
def box_overlap_area(ax0, ay0, ax1, ay1, bx0, by0, bx1, by1) -> Column:
    """Area of the intersection of two axis-aligned rectangles."""
    w = F.greatest(F.lit(0.0), F.least(_c(ax1), _c(bx1)) - F.greatest(_c(ax0), _c(bx0)))
    h = F.greatest(F.lit(0.0), F.least(_c(ay1), _c(by1)) - F.greatest(_c(ay0), _c(by0)))
    return w * h


def ring_box_area(ring, x0, y0, x1, y1) -> Column:
    """Area of (ring polygon) intersected with the box [x0,x1] x [y0,y1]."""
    return ring_area(clip_ring_to_box(ring, x0, y0, x1, y1))
