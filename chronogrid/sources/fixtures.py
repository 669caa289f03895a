"""Grids derived from the supplied test tables (see FIXTURES.md).

These are the inputs of the registered queries: every one is computed by Spark
from ``events``, ``lineitem`` or ``region`` so its size follows the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ChunkPlan, GridSpec
from ..functions.values import mask_missing
from ..operators.catalog import BUCKET_VARS

# The fixture grids' axes and chunking.
F1_SPEC = GridSpec("2024-01-01 00:00:00", "hour", ChunkPlan(144, 2, 2))
F1_END = "2024-01-30 23:00:00"
F1_SHAPE = (2, 2)
F2_SPEC = GridSpec("1995-01-02 00:00:00", "day", ChunkPlan(36, 4, 16))
F2_END = "2001-11-04 00:00:00"
F2_SHAPE = (8, 64)
F2_TILE_SPEC = GridSpec("1995-01-02 00:00:00", "day", ChunkPlan(180, 4, 16))   # for the bucketed store: fewer files


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hourly_grid(spark: SparkSession, sf_dir: str, plant_nan: bool = False, mask: bool = True) -> DataFrame:
    """``(time, y, x, T2D, RAINRATE)`` on 2 x 2 cells, one row per hour and cell
    with events.  With ``plant_nan`` every event with ``event_id % 97 = 0``
    carries NaN, which the ingest rule then masks to NULL (unless ``mask`` is
    False, to see the raw values)."""
    ev = table(spark, sf_dir, "events")
    v = F.col("value")
    if plant_nan:
        v = F.when(F.col("event_id") % 97 == 0, F.lit(float("nan"))).otherwise(v)
    g = (ev.select(F.window("ts", "1 hour").start.alias("time"),
                   F.floor((F.col("user_id") % 4) / 2).cast("int").alias("y"),
                   (F.col("user_id") % 2).cast("int").alias("x"),
                   v.alias("v"))
         .groupBy("time", "y", "x")
         .agg(F.max("v").alias("T2D"), F.min("v").alias("RAINRATE")))
    return mask_missing(g, ["T2D", "RAINRATE"]) if plant_nan and mask else g


def daily_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(time, y, x, qty, price)``: one row per ship day, line number and 64th of
    the parts.  Seven by 64 cells over seven years: rows grow with ``lineitem``."""
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_shipdate").alias("time"), F.col("l_linenumber").cast("int").alias("y"),
                       (F.col("l_partkey") % 64).cast("int").alias("x"))
            .agg(F.max("l_quantity").alias("qty"), F.max("l_extendedprice").alias("price")))


def daily_store(spark: SparkSession, sf_dir: str, names: tuple[str, str] = ("qty", "price"), buckets: int | None = 32, slots: int = 4):
    """F2 in a store bucketed by tile and slot; the axis spans the data's days."""
    from ..session import materialise, scratch_path
    from .gridstore import GridStore
    g = materialise(daily_grid(spark, sf_dir).withColumnsRenamed({"qty": names[0], "price": names[1]}), "f2")
    ends = g.agg(F.min("time").alias("first"), F.max("time").alias("last")).first()   # two scalars
    store = GridStore.create(spark, scratch_path(spark, "daily-tiles"), F2_TILE_SPEC, ends["first"], ends["last"], list(names),
                             shape=F2_SHAPE, buckets=buckets, slots=slots)
    store.write_region(g, stage=False)
    return store


# Names given to the first users of the derived catalog: five bucket variables.
BUCKET_NAMES = BUCKET_VARS[:5]


def _user_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    n = lambda t: F.sum(F.when(F.col("event_type") == t, 1).otherwise(0)).alias(f"n_{t}")
    return ev.groupBy("user_id").agg(n("signup"), n("purchase"), n("error"), n("view"), n("click"),
                                     F.max("event_type").alias("max_type"))


def _varname() -> F.Column:
    name = F.concat(F.lit("V"), F.col("user_id").cast("string"))
    for i, b in enumerate(BUCKET_NAMES):
        name = F.when(F.col("user_id") == i, F.lit(b)).otherwise(name)
    return name


def var_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 (derived): one variable per user of ``events``.

    dims ``[time,y,x]`` if the user ever signed up, else ``[y,x]`` (a constant);
    attributes from the user's event counts, including some to be removed."""
    u = _user_counts(spark, sf_dir)
    il = (F.when(F.col("n_purchase") >= F.col("n_click") + 3, F.lit("60-minute accumulation"))
          .when(F.col("n_purchase") > F.col("n_click"), F.lit("15-minute accumulation")))
    attrs = F.map_filter(F.create_map(
        F.lit("long_name"), F.concat(F.lit("user "), F.col("user_id").cast("string")),
        F.lit("units"), F.col("max_type"),
        F.lit("integration_length"), il,
        F.lit("esri_pe_string"), F.when(F.col("n_error") > F.col("n_view"), F.lit("PROJCS")),
        F.lit("proj4"), F.when(F.col("n_view") > F.col("n_click"), F.lit("+proj=lcc")),
        F.lit("resolution"), F.when(F.col("n_click") > F.col("n_signup"), F.lit("4000"))), lambda k, v: v.isNotNull())
    dims = F.when(F.col("n_signup") > F.col("n_error"), F.array(F.lit("time"), F.lit("y"), F.lit("x"))) \
        .otherwise(F.array(F.lit("y"), F.lit("x")))
    return u.select(_varname().alias("varname"), dims.alias("dims"), attrs.alias("attrs"),
                    F.create_map(F.lit("dtype"), F.lit("float64")).alias("encoding"))


def var_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata rows (varname, long_name, standard_name, units, coordinates) for
    the users with at least as many error as view events, plus a ``time`` row."""
    u = _user_counts(spark, sf_dir).where(F.col("n_error") >= F.col("n_view"))
    rows = u.select(_varname().alias("varname"),
                    F.concat(F.lit("meta "), F.col("user_id").cast("string")).alias("long_name"),
                    F.when(F.col("n_view") > F.col("n_click"), F.concat(F.lit("std_"), F.col("user_id").cast("string"))).alias("standard_name"),
                    F.when(F.col("n_click") > F.col("n_signup"), F.lit("m")).alias("units"),
                    F.when(F.col("n_signup") > F.col("n_purchase"), F.lit("x y")).alias("coordinates"))
    time_row = spark.createDataFrame([("time", "time", "time", "hours", None)],
                                     "varname string, long_name string, standard_name string, units string, coordinates string")
    return rows.unionByName(time_row)


def file_listing(spark: SparkSession, sf_dir: str, wrf_dir: str, template: str) -> DataFrame:
    """F5 (derived): files present, one per lineitem row: hour ``l_suppkey % 24``
    of the ship day, in the previous water-year directory when the return flag
    is 'A' (the misplaced boundary files)."""
    from ..functions import timeaxis as ta
    from .manifest import manifest_path
    li = table(spark, sf_dir, "lineitem")
    fdate = ta.add_interval("l_shipdate", hours=(F.col("l_suppkey") % 24).cast("int"))
    wy = F.when(F.col("l_returnflag") == "A", F.concat(F.lit("WY"), F.year("l_shipdate").cast("string"))) \
        .otherwise(ta.water_year_dir("l_shipdate"))
    return li.select(manifest_path(template, wrf_dir, wy, fdate).alias("path")).distinct()


def region_rectangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one rectangle per region over the F1 unit cells:
    x0 = 0.5 k, x1 = x0 + 0.7, y0 = 0.1 k, y1 = y0 + 1.0 (k = r_regionkey).
    Region 3 lies partly and region 4 wholly outside the 2 x 2 grid."""
    from ..functions.geometry import rectangle_ring
    k = F.col("r_regionkey").cast("double")
    x0, y0 = F.lit(0.5) * k, F.lit(0.1) * k
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("long").alias("poly_id"),
        rectangle_ring(x0, y0, x0 + F.lit(0.7), y0 + F.lit(1.0)).alias("ring"))


def nation_triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triangles, one per nation: p0 = (0.08 k, 0.05 k), p1 = p0 + (1.1, 0.3),
    p2 = p0 + (0.4, 1.2) (k = n_nationkey)."""
    from ..functions.geometry import point
    k = F.col("n_nationkey").cast("double")
    x0, y0 = F.lit(0.08) * k, F.lit(0.05) * k
    ring = F.array(point(x0, y0), point(x0 + F.lit(1.1), y0 + F.lit(0.3)), point(x0 + F.lit(0.4), y0 + F.lit(1.2)))
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("poly_id"), ring.alias("ring"))


#: Vertices of a supplier's concave ring and of the hole of every third one, around its centre (fixed values).
SUPPLIER_RING = ((-3.0, -1.5), (4.25, -0.75), (1.0, 0.0), (3.5, 2.25), (-2.0, 1.25))
SUPPLIER_HOLE = ((-1.5, -0.5), (0.25, -0.25), (-0.75, 0.75))


def supplier_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one concave ring per supplier over the F2 cells, a hole in every third
    (``poly_id, ring, hole``).  Centres are spread by the key: rings grow with
    ``supplier`` and many reach beyond the grid."""
    from ..functions.geometry import point
    k = F.col("s_suppkey").cast("double")
    cx, cy = F.pmod(k * 37, F.lit(680.0)) / 10.0 - 2.0, F.pmod(k * 13, F.lit(96.0)) / 10.0 - 0.5
    ring = lambda vertices: F.array(*[point(cx + F.lit(a), cy + F.lit(b)) for a, b in vertices])
    s = table(spark, sf_dir, "supplier").withColumn("poly_id", F.col("s_suppkey").cast("long"))
    outer = s.select("poly_id", ring(SUPPLIER_RING).alias("ring"), F.lit(False).alias("hole"))
    return outer.unionByName(s.where("s_suppkey % 3 = 0").select("poly_id", ring(SUPPLIER_HOLE).alias("ring"), F.lit(True).alias("hole")))
