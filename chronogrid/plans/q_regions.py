"""Registered queries: polygon overlay, weights and polygon averages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import values as fv
from ..operators import daily, grid as gops, regions
from ..session import scratch_path
from ..sources import fixtures as fx
from . import regions as region_jobs
from .registry import F1_SQL, F2_SQL, daily_sql, f1, register

CG = regions.CellGrid(0.0, 0.0, 1.0, 1.0, 2, 2)
RING_CG = regions.CellGrid(0.0, 0.0, 1.0, 1.0)


def cells(spark, sf_dir):
    return f1(spark, sf_dir).select("y", "x").distinct()


def rect_weights(spark, sf_dir):
    polys = fx.region_rectangles(spark, sf_dir)
    return regions.weights(polys, regions.overlay(polys, cells(spark, sf_dir), CG, rectangles=True))


def daily_f1(spark, sf_dir):
    return daily.daily_reduce(f1(spark, sf_dir), fx.F1_SPEC.base_date, unique=True)


RECT_SQL = f"""p AS (SELECT CAST(r_regionkey AS BIGINT) AS poly_id, 0.5::DOUBLE * r_regionkey AS x0, 0.1::DOUBLE * r_regionkey AS y0,
                 0.5::DOUBLE * r_regionkey + 0.7::DOUBLE AS x1, 0.1::DOUBLE * r_regionkey + 1.0::DOUBLE AS y1 FROM region),
pa AS (SELECT poly_id, abs(((((0.0 + (x0 * y0 - x1 * y0)) + (x1 * y1 - x1 * y0)) + (x1 * y1 - x0 * y1)) + (x0 * y0 - x0 * y1))) / 2.0 AS poly_area FROM p),
c AS (SELECT DISTINCT y, x FROM ({F1_SQL})),
o AS (SELECT poly_id, y, x, greatest(0.0, least(x1, x + 1.0) - greatest(x0, x * 1.0)) * greatest(0.0, least(y1, y + 1.0) - greatest(y0, y * 1.0)) AS area
      FROM p, c WHERE x BETWEEN floor(x0) AND ceil(x1) - 1 AND y BETWEEN floor(y0) AND ceil(y1) - 1),
wt AS (SELECT poly_id, y, x, area / poly_area AS w FROM o JOIN pa USING (poly_id) WHERE area > 0)"""

# DECIMAL -> DOUBLE through text: DuckDB's direct cast is not always correctly
# rounded, Spark's (BigDecimal) is.
MEAN_SQL = f"""WITH {RECT_SQL}, d AS ({daily_sql(F1_SQL)}), nc AS (SELECT poly_id, count(*) AS n_cells FROM wt GROUP BY 1), j AS (SELECT * FROM d JOIN wt USING (y, x) JOIN nc USING (poly_id))
SELECT poly_id, time,
  CASE WHEN count(RAIN) = max(n_cells) THEN CAST(CAST(sum(CAST(w * RAIN AS DECIMAL(38,18))) AS VARCHAR) AS DOUBLE) / CAST(CAST(sum(CAST(CASE WHEN RAIN IS NOT NULL THEN w END AS DECIMAL(38,18))) AS VARCHAR) AS DOUBLE) END AS RAIN,
  CASE WHEN count(T2MAX) = max(n_cells) THEN CAST(CAST(sum(CAST(w * T2MAX AS DECIMAL(38,18))) AS VARCHAR) AS DOUBLE) / CAST(CAST(sum(CAST(CASE WHEN T2MAX IS NOT NULL THEN w END AS DECIMAL(38,18))) AS VARCHAR) AS DOUBLE) END AS T2MAX,
  CASE WHEN count(T2MIN) = max(n_cells) THEN CAST(CAST(sum(CAST(w * T2MIN AS DECIMAL(38,18))) AS VARCHAR) AS DOUBLE) / CAST(CAST(sum(CAST(CASE WHEN T2MIN IS NOT NULL THEN w END AS DECIMAL(38,18))) AS VARCHAR) AS DOUBLE) END AS T2MIN
FROM j GROUP BY poly_id, time"""

# Reported precision of polygon averages (the library keeps full precision).
REPORT_DIGITS = 6
MEAN_OUT_SQL = f"SELECT poly_id, time, round(RAIN, {REPORT_DIGITS}) AS RAIN, round(T2MAX, {REPORT_DIGITS}) AS T2MAX, round(T2MIN, {REPORT_DIGITS}) AS T2MIN FROM ({MEAN_SQL})"

CONV_SQL = f"""SELECT poly_id, time, round(RAIN / 25.4::DOUBLE, {REPORT_DIGITS}) AS prcp,
  round((T2MAX - 273.15::DOUBLE) * 1.8::DOUBLE + 32.0::DOUBLE, {REPORT_DIGITS}) AS tmax,
  round((T2MIN - 273.15::DOUBLE) * 1.8::DOUBLE + 32.0::DOUBLE, {REPORT_DIGITS}) AS tmin FROM ({MEAN_SQL})"""


def reported(df, cols):
    return df.select(*[F.round(c, REPORT_DIGITS).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("JN07_polygon_cell_overlay", f"WITH {RECT_SQL} SELECT poly_id, y, x, area FROM o WHERE area > 0")
def q_jn07(spark, sf_dir):
    return regions.overlay(fx.region_rectangles(spark, sf_dir), cells(spark, sf_dir), CG, rectangles=True)


@register("AG11_weight_normalise", f"WITH {RECT_SQL} SELECT poly_id, y, x, w FROM wt")
def q_ag11(spark, sf_dir):
    return rect_weights(spark, sf_dir)


@register("JN06_grid_weights_join", f"WITH {RECT_SQL}, d AS ({daily_sql(F1_SQL)}) SELECT d.time, y, x, poly_id, w, d.T2MAX FROM d JOIN wt USING (y, x)")
def q_jn06(spark, sf_dir):
    j = regions.join_weights(daily_f1(spark, sf_dir), rect_weights(spark, sf_dir))
    return j.select("time", "y", "x", "poly_id", "w", "T2MAX")


@register("AG10_weighted_mean", MEAN_OUT_SQL)
def q_ag10(spark, sf_dir):
    j = regions.join_weights(daily_f1(spark, sf_dir), rect_weights(spark, sf_dir))
    return reported(regions.weighted_mean(j, ["RAIN", "T2MAX", "T2MIN"]), ("RAIN", "T2MAX", "T2MIN"))


@register("SC15_convert_units", CONV_SQL)
def q_sc15(spark, sf_dir):
    j = regions.join_weights(daily_f1(spark, sf_dir), rect_weights(spark, sf_dir))
    return reported(fv.convert_units(regions.weighted_mean(j, ["RAIN", "T2MAX", "T2MIN"]), keep=("poly_id", "time")),
                    ("prcp", "tmax", "tmin"))


@register("SR19_yearly_region_write", f"SELECT *, CAST(year(time) AS INTEGER) AS year FROM ({CONV_SQL})")
def q_sr19(spark, sf_dir):
    j = regions.join_weights(daily_f1(spark, sf_dir), rect_weights(spark, sf_dir))
    out = fv.convert_units(regions.weighted_mean(j, ["RAIN", "T2MAX", "T2MIN"]), keep=("poly_id", "time"))
    path = scratch_path(spark, "yearly")
    region_jobs.write_yearly(out, path)
    return reported(region_jobs.read_yearly(spark, path), ("prcp", "tmax", "tmin"))


@register("JB11_region_daily", f"SELECT *, CAST(year(time) AS INTEGER) AS year FROM ({CONV_SQL})")
def q_jb11(spark, sf_dir):
    w_path = scratch_path(spark, "weights")
    region_jobs.build_weights(fx.region_rectangles(spark, sf_dir), cells(spark, sf_dir), CG, w_path, rectangles=True)
    out = scratch_path(spark, "region-daily")
    years = f1(spark, sf_dir).agg(F.min(F.year("time")).alias("first"), F.max(F.year("time")).alias("last")).first()   # two scalars
    region_jobs.region_daily(spark, daily_f1(spark, sf_dir), w_path, out, first_year=years["first"], last_year=years["last"])
    return reported(region_jobs.read_yearly(spark, out), ("prcp", "tmax", "tmin"))


@register("JB10_build_weights", f"WITH {RECT_SQL} SELECT poly_id, y, x, w FROM wt")
def q_jb10(spark, sf_dir):
    path = scratch_path(spark, "weights")
    region_jobs.build_weights(fx.region_rectangles(spark, sf_dir), cells(spark, sf_dir), CG, path, rectangles=True)
    return region_jobs.read_weights(spark, path)


@register("SR14_weights_write_read", f"WITH {RECT_SQL} SELECT poly_id, y, x, w FROM wt")
def q_sr14(spark, sf_dir):
    path = scratch_path(spark, "weights-csv")
    region_jobs.write_weights(rect_weights(spark, sf_dir), path)
    return region_jobs.read_weights(spark, path)


TRI_SQL = """t AS (SELECT CAST(n_nationkey AS BIGINT) AS poly_id, 0.08::DOUBLE * n_nationkey AS x0, 0.05::DOUBLE * n_nationkey AS y0 FROM nation),
v AS (SELECT poly_id, 0 AS i, x0 AS x, y0 AS y FROM t UNION ALL SELECT poly_id, 1, x0 + 1.1::DOUBLE, y0 + 0.3::DOUBLE FROM t
      UNION ALL SELECT poly_id, 2, x0 + 0.4::DOUBLE, y0 + 1.2::DOUBLE FROM t)"""


@register("SR13_polygon_scan", f"WITH {TRI_SQL} SELECT poly_id, CAST(i AS INTEGER) AS i, x, y FROM v")
def q_sr13(spark, sf_dir):
    path = scratch_path(spark, "polygons")
    fx.nation_triangles(spark, sf_dir).write.parquet(path)
    polys = region_jobs.read_polygons(spark, path)
    return polys.select("poly_id", F.posexplode("ring").alias("i", "p")).select(
        "poly_id", F.col("i").cast("int").alias("i"), "p.x", "p.y")


@register("AG14_polygon_count", "SELECT count(*) AS n_polygons FROM nation")
def q_ag14(spark, sf_dir):
    return regions.polygon_count(fx.nation_triangles(spark, sf_dir))


@register("SL03_head", "SELECT CAST(n_nationkey AS BIGINT) AS poly_id, 3 AS n_vertices FROM nation ORDER BY n_nationkey LIMIT 5")
def q_sl03(spark, sf_dir):
    polys = fx.nation_triangles(spark, sf_dir).select("poly_id", F.size("ring").alias("n_vertices"))
    return regions.head(polys, ["poly_id"], 5)


@register("WN02_head_per_group", """SELECT time, y, x, qty, price FROM (
  SELECT *, row_number() OVER (PARTITION BY y ORDER BY time, x) AS rn FROM (
    SELECT l_shipdate AS time, CAST(l_linenumber AS INTEGER) AS y, CAST(l_partkey % 64 AS INTEGER) AS x, max(l_quantity) AS qty,
           max(l_extendedprice) AS price FROM lineitem GROUP BY 1, 2, 3)) WHERE rn <= 5""")
def q_wn02(spark, sf_dir):
    return regions.head_per_group(fx.daily_grid(spark, sf_dir), "y", ["time", "x"], 5)


PT = "STRUCT(x DOUBLE, y DOUBLE)"


def _clip_sql(src: str, axis: str, bound: str, keep_greater: bool) -> str:
    """One Sutherland-Hodgman half-plane step over list column ``src`` (DuckDB)."""
    other = "y" if axis == "x" else "x"
    op = ">=" if keep_greater else "<="
    cur = f"{src}[i + 1]"
    prev = f"{src}[((i - 1 + len({src})) % len({src})) + 1]"
    t = f"(({bound} - {prev}.{axis}) / ({cur}.{axis} - {prev}.{axis}))"
    o = f"({prev}.{other} + {t} * ({cur}.{other} - {prev}.{other}))"
    cross = f"{{'x': {bound}, 'y': {o}}}" if axis == "x" else f"{{'x': {o}, 'y': {bound}}}"
    return (f"CASE WHEN len({src}) > 0 THEN flatten(list_transform(range(len({src})), lambda i: CASE "
            f"WHEN {cur}.{axis} {op} {bound} AND {prev}.{axis} {op} {bound} THEN [{cur}] "
            f"WHEN {cur}.{axis} {op} {bound} THEN [{cross}::{PT}, {cur}] "
            f"WHEN {prev}.{axis} {op} {bound} THEN [{cross}::{PT}] "
            f"ELSE []::{PT}[] END)) ELSE []::{PT}[] END")


def _area_sql(r: str) -> str:
    nxt = f"{r}[((i + 1) % len({r})) + 1]"
    terms = f"list_transform(range(len({r})), lambda i: {r}[i + 1].x * {nxt}.y - {nxt}.x * {r}[i + 1].y)"
    return f"CASE WHEN len({r}) >= 3 THEN abs(list_reduce({terms}, lambda a, b: a + b)) / 2.0 ELSE 0.0 END"


SC16_SQL = f"""WITH {TRI_SQL},
p AS (SELECT poly_id, list(struct_pack(x := x, y := y) ORDER BY i) AS ring FROM v GROUP BY poly_id),
b AS (SELECT poly_id, ring, list_min(list_transform(ring, lambda q: q.x)) AS bx0, list_max(list_transform(ring, lambda q: q.x)) AS bx1,
             list_min(list_transform(ring, lambda q: q.y)) AS by0, list_max(list_transform(ring, lambda q: q.y)) AS by1 FROM p),
c AS (SELECT CAST(a.y AS INTEGER) AS y, CAST(b.x AS INTEGER) AS x FROM range(3) a(y), range(4) b(x)),
k AS (SELECT poly_id, ring, c.y, c.x, 0.0 + c.x * 1.0 AS cx0, 0.0 + c.y * 1.0 AS cy0, (0.0 + c.x * 1.0) + 1.0 AS cx1,
             (0.0 + c.y * 1.0) + 1.0 AS cy1 FROM b JOIN c ON c.x BETWEEN floor(bx0) AND ceil(bx1) - 1 AND c.y BETWEEN floor(by0) AND ceil(by1) - 1),
s1 AS (SELECT *, {_clip_sql('ring', 'x', 'cx0', True)} AS r1 FROM k),
s2 AS (SELECT *, {_clip_sql('r1', 'x', 'cx1', False)} AS r2 FROM s1),
s3 AS (SELECT *, {_clip_sql('r2', 'y', 'cy0', True)} AS r3 FROM s2),
s4 AS (SELECT *, {_clip_sql('r3', 'y', 'cy1', False)} AS r4 FROM s3),
ar AS (SELECT poly_id, y, x, {_area_sql('r4')} AS area FROM s4)
SELECT poly_id, y, x, area FROM ar WHERE area > 0"""


@register("SC16_clip_area_rings", SC16_SQL)
def q_sc16(spark, sf_dir):
    """General rings (triangles) clipped to the cells of a 4 x 3 grid; also
    checked against an independent brute-force clip in the tests."""
    c = gops.make_cells(spark, 3, 4)
    return regions.clipped_overlay(fx.nation_triangles(spark, sf_dir), c, RING_CG)


def _ring_sql(vertices) -> str:
    return "[" + ", ".join(f"struct_pack(x := cx + {a}::DOUBLE, y := cy + {b}::DOUBLE)" for a, b in vertices) + "]"


# The rings of the suppliers clipped cell by cell: nothing in common with the scan lines.
COVER_SQL = f"""k AS (SELECT CAST(s_suppkey AS BIGINT) AS poly_id, (s_suppkey::DOUBLE * 37) % 680.0 / 10.0::DOUBLE - 2.0 AS cx,
  (s_suppkey::DOUBLE * 13) % 96.0 / 10.0::DOUBLE - 0.5::DOUBLE AS cy FROM supplier),
p AS (SELECT poly_id, 1.0 AS sign, {_ring_sql(fx.SUPPLIER_RING)} AS ring FROM k
  UNION ALL SELECT poly_id, -1.0, {_ring_sql(fx.SUPPLIER_HOLE)} FROM k WHERE poly_id % 3 = 0),
b AS MATERIALIZED (SELECT *, list_min(list_transform(ring, lambda q: q.x)) AS bx0, list_max(list_transform(ring, lambda q: q.x)) AS bx1,
             list_min(list_transform(ring, lambda q: q.y)) AS by0, list_max(list_transform(ring, lambda q: q.y)) AS by1 FROM p),
c AS MATERIALIZED (SELECT DISTINCT y, x FROM ({F2_SQL})),
s0 AS MATERIALIZED (SELECT b.poly_id, b.sign, b.ring, c.y, c.x, c.x::DOUBLE AS cx0, c.y::DOUBLE AS cy0, c.x + 1.0::DOUBLE AS cx1, c.y + 1.0::DOUBLE AS cy1
       FROM b JOIN c ON c.x BETWEEN floor(bx0) AND ceil(bx1) - 1 AND c.y BETWEEN floor(by0) AND ceil(by1) - 1),
s1 AS MATERIALIZED (SELECT *, {_clip_sql('ring', 'x', 'cx0', True)} AS r1 FROM s0),
s2 AS MATERIALIZED (SELECT *, {_clip_sql('r1', 'x', 'cx1', False)} AS r2 FROM s1),
s3 AS MATERIALIZED (SELECT *, {_clip_sql('r2', 'y', 'cy0', True)} AS r3 FROM s2),
s4 AS MATERIALIZED (SELECT *, {_clip_sql('r3', 'y', 'cy1', False)} AS r4 FROM s3),
ar AS MATERIALIZED (SELECT poly_id, y, x, sign * {_area_sql('r4')} AS a FROM s4),
cov AS (SELECT poly_id, y, x, sum(a) AS area FROM ar GROUP BY 1, 2, 3 HAVING sum(a) > 1e-9)"""


def supplier_overlay(spark, sf_dir):
    cells = fx.daily_grid(spark, sf_dir).select("y", "x").distinct()
    return regions.overlay(fx.supplier_rings(spark, sf_dir), cells, regions.CellGrid(nx=64, ny=8))


@register("JN07_scanline_coverage", f"WITH {COVER_SQL} SELECT poly_id, y, x, round(area, {REPORT_DIGITS}) AS area FROM cov")
def q_jn07_scanline(spark, sf_dir):
    """Concave rings with holes, many of them partly outside the grid."""
    return reported(supplier_overlay(spark, sf_dir), ("area",))


# --- the product of a stored grid and large weights, tile by tile ---------------
POLY_SQL = f"""pa AS (SELECT poly_id, sum(sign * {_area_sql('ring')}) AS poly_area FROM p GROUP BY poly_id),
wt AS MATERIALIZED (SELECT poly_id, y, x, round(area / poly_area, {REPORT_DIGITS}) AS w FROM cov JOIN pa USING (poly_id) WHERE round(area / poly_area, {REPORT_DIGITS}) > 0),
g AS MATERIALIZED ({F2_SQL})"""


# The engines round halves of the last digit differently, the more so the larger a value:
# three digits, and a shift far below the step and far above rounding errors on both sides.
MEAN_DIGITS, MEAN_SHIFT = 3, 1.7e-5


def mean_sql(e: str) -> str:
    return f"round({e} + {MEAN_SHIFT}::DOUBLE, {MEAN_DIGITS})"


def mean_out(c: str):
    return F.round(F.col(c) + F.lit(MEAN_SHIFT), MEAN_DIGITS).alias(c)


def _lenient_sql(v: str) -> str:
    return (f"CAST(CAST(sum(CAST(w * {v} AS DECIMAL(38,18))) AS VARCHAR) AS DOUBLE) / "
            f"CAST(CAST(sum(CAST(w AS DECIMAL(38,18))) AS VARCHAR) AS DOUBLE)")


def supplier_weights(spark, sf_dir):
    """Weights of six digits, so that both engines average with the same ones."""
    w = regions.weights(fx.supplier_rings(spark, sf_dir), supplier_overlay(spark, sf_dir))
    return reported(w, ("w",)).where("w > 0")


@register("JN06_grid_weights_by_tile", f"""WITH {COVER_SQL}, {POLY_SQL}
SELECT time, y, x, poly_id, w, n_cells, qty FROM g JOIN wt USING (y, x)
JOIN (SELECT poly_id, count(*) AS n_cells FROM wt GROUP BY 1) USING (poly_id)""")
def q_jn06_tiles(spark, sf_dir):
    """The stored daily grid joined with the suppliers' weights as a table bucketed alike: no exchange of the grid."""
    store = fx.daily_store(spark, sf_dir)
    path = scratch_path(spark, "tile-weights")
    region_jobs.write_tile_weights(store, supplier_weights(spark, sf_dir), path)
    j = region_jobs.tile_product(store, path, ["qty"])
    return j.select("time", "y", "x", "poly_id", "w", "n_cells", "qty")


@register("AG10_weighted_mean_by_tile", f"""WITH {COVER_SQL}, {POLY_SQL}
SELECT poly_id, time, {mean_sql(_lenient_sql('qty'))} AS qty, {mean_sql(_lenient_sql('price'))} AS price
FROM g JOIN wt USING (y, x) GROUP BY poly_id, time""")
def q_ag10_tiles(spark, sf_dir):
    means = region_jobs.store_means(fx.daily_store(spark, sf_dir), supplier_weights(spark, sf_dir), ["qty", "price"], strict=False, limit=0)
    return means.select("poly_id", "time", mean_out("qty"), mean_out("price"))


@register("JB11_region_daily_by_tile", f"""WITH {COVER_SQL}, {POLY_SQL}
SELECT poly_id, time, {mean_sql(_lenient_sql('qty') + " / 25.4::DOUBLE")} AS prcp,
  {mean_sql("(" + _lenient_sql('price') + " - 273.15::DOUBLE) * 1.8::DOUBLE + 32.0::DOUBLE")} AS tmax, CAST(year(time) AS INTEGER) AS year
FROM g JOIN wt USING (y, x) GROUP BY poly_id, time""")
def q_jb11_tiles(spark, sf_dir):
    """The suppliers' weights through CSV, the averages of all years of the data, a directory a year."""
    store = fx.daily_store(spark, sf_dir, ("RAIN", "T2MAX"))
    w_path, out = scratch_path(spark, "weights"), scratch_path(spark, "region-daily")
    region_jobs.write_weights(supplier_weights(spark, sf_dir), w_path)
    years = store.axis().agg(F.min(F.year("time")).alias("first"), F.max(F.year("time")).alias("last")).first()   # two scalars
    region_jobs.region_daily_store(store, w_path, out, years["first"], years["last"], ("RAIN", "T2MAX"), strict=False, limit=0)
    found = region_jobs.read_yearly(spark, out)
    return found.select("poly_id", "time", mean_out("prcp"), mean_out("tmax"), "year")
