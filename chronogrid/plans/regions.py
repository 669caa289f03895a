"""Region jobs: JB10 build_weights and JB11 region_daily (plus SR13, SR14, SR19 I/O)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timeaxis as ta
from ..functions import values as fv
from ..operators import regions, tilemeans
from ..operators.grid import CELL_KEYS
from ..operators.joins import BROADCAST_LIMIT_BYTES, size_checked_broadcast
from ..session import materialise, prepare_workers
from ..sources.gridstore import BUCKET_KEYS, GridStore, bucketed_table

WEIGHTS_SCHEMA = "poly_id bigint, y int, x int, w double"
YEAR_BUCKETS = 16
POLYGON_SCHEMA = "poly_id bigint, ring array<struct<x: double, y: double>>"


# --- SR13 polygon_scan --------------------------------------------------------
def read_polygons(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POLYGON_SCHEMA).parquet(path)


# --- SR14 weights_write / weights_read ----------------------------------------
def write_weights(w: DataFrame, path: str) -> None:
    w.select("poly_id", "y", "x", "w").write.mode("overwrite").option("header", True).csv(path)


def read_weights(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(WEIGHTS_SCHEMA).csv(path)


# --- SR19 yearly_region_write -------------------------------------------------
def write_yearly(df: DataFrame, path: str) -> None:
    """One output directory per calendar year (``year=<Y>``); years written before go.

    A year's polygons are dealt over up to ``YEAR_BUCKETS`` tasks and files."""
    (df.withColumn("year", F.year("time")).repartition("year", F.pmod(F.hash("poly_id"), F.lit(YEAR_BUCKETS)))
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("year").parquet(path))


def read_yearly(spark: SparkSession, path: str, year: int | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.where(F.col("year") == year) if year is not None else df


# --- JB10 build_weights -------------------------------------------------------
def build_weights(polys: DataFrame, cells: DataFrame, cg: regions.CellGrid, path: str,
                  rectangles: bool = False, to_grid=None, area_ring=None) -> None:
    """Polygons -> weight table written as CSV.

    ``to_grid`` (ring -> ring) brings polygon vertices into the grid plane
    first (e.g. ``projection.albers_to_grid``); cells are clipped there, where
    they are rectangles.  ``area_ring`` measures areas in another plane (e.g.
    ``projection.grid_to_equal_area``)."""
    if to_grid is not None:
        polys = polys.withColumn("ring", to_grid(F.col("ring")))
    w = regions.weights(polys, regions.overlay(polys, cells, cg, rectangles and area_ring is None, area_ring),
                        area_ring)
    write_weights(w, path)


# --- JN06 by tile: the product of a stored grid and its weights ----------------
TILE_WEIGHTS = ("block int, cells map<int, array<struct<poly_id: bigint, w: double, n_cells: bigint>>>, "
                "y_chunk int, x_chunk int, slot int")
#: Weights in a row of a packed table, about; a polygon's weights stay together.
PACKED = 1 << 15
#: Most steps, and cells times steps, of the grid that a block of polygons is averaged over at a time.
PIECE_STEPS, PIECE_VALUES = 128, 1 << 20
#: Most tasks that a bucket's blocks of polygons are dealt over in the product.
BUCKET_TASKS = 8


def _located(store: GridStore, w: DataFrame) -> DataFrame:
    """Weights with their tile and the cell's number in it."""
    plan = store.spec.plan
    rows = regions.with_cell_count(w).select(
        "poly_id", "y", "x", "w", "n_cells", (F.col("y") / plan.y).cast("int").alias("y_chunk"), (F.col("x") / plan.x).cast("int").alias("x_chunk"))
    return rows.withColumn("cell", _cell_number(store))


def _cell_number(store: GridStore):
    plan = store.spec.plan
    return ((F.col("y") - F.col("y_chunk") * plan.y) * plan.x + F.col("x") - F.col("x_chunk") * plan.x).cast("int")


def write_tile_weights(store: GridStore, w: DataFrame, path: str) -> None:
    """Weights bucketed as the store's grid is: by tile and slot, one copy a slot.

    A row holds a block of polygons by the tile's cells, about ``PACKED`` weights.  A
    polygon's weights lie in the buckets of the tiles that it meets.  The table is as large as
    the weights times the slots, whatever the length of the time axis."""
    rows = materialise(_located(store, w), "located")
    most = rows.groupBy("y_chunk", "x_chunk").count().agg(F.max("count")).first()[0] or 0   # one scalar
    block = F.pmod(F.xxhash64("poly_id"), F.lit(-(-most // PACKED) or 1)).cast("int").alias("block")
    by_cell = rows.groupBy("y_chunk", "x_chunk", block, "cell").agg(F.collect_list(F.struct("poly_id", "w", "n_cells")).alias("items"))
    packed = by_cell.groupBy("y_chunk", "x_chunk", "block").agg(F.map_from_entries(F.collect_list(F.struct("cell", "items"))).alias("cells"))
    packed = packed.select("block", "cells", "y_chunk", "x_chunk", F.explode(F.sequence(F.lit(0), F.lit(store.slots - 1))).alias("slot"))
    table = bucketed_table(store.spark, path, TILE_WEIGHTS, store.buckets)
    packed.repartition(*BUCKET_KEYS).write.insertInto(table, overwrite=True)


def tile_product(store: GridStore, weights_path: str, variables=None, start=None, end=None) -> DataFrame:
    """JN06 for weights of any size: a bucketed store's grid joined with weights bucketed alike.

    Every task reads the files of its tiles and slots on both sides and holds their
    weights (one tile's, bounded by the chunk plan and the polygons that meet it) in a
    hash table: no row of the grid is exchanged.  A cell's steps of a time chunk are
    gathered before the join and streamed out in order for one weight after another: along
    them only time and values change, and the next weight of the cell repeats these, so a
    product that is written takes little of the disk that its rows would take by step.
    Weights of many blocks are dealt over up to ``BUCKET_TASKS`` tasks a bucket, each of
    which reads the bucket's grid."""
    grid = store.read(variables, start=start, end=end, by_tile=True, with_chunks=True)
    names = [c for c in grid.columns if c not in ("time_chunk", *BUCKET_KEYS)]
    along = [c for c in names if c not in CELL_KEYS]
    series = grid.groupBy(*BUCKET_KEYS, "time_chunk", *CELL_KEYS).agg(F.sort_array(F.collect_list(F.struct(*along))).alias("_steps"))
    w = store.spark.table(bucketed_table(store.spark, weights_path, TILE_WEIGHTS, store.buckets))
    parts = min(BUCKET_TASKS, (w.agg(F.max("block")).first()[0] or 0) + 1)   # one scalar

    def product(part: int) -> DataFrame:
        met = series.join(w.where(F.pmod("block", F.lit(parts)) == part).hint("shuffle_hash"), list(BUCKET_KEYS))
        rows = met.select(*CELL_KEYS, "_steps", F.explode(F.try_element_at("cells", _cell_number(store))).alias("_item"))
        rows = rows.select(*CELL_KEYS, "_item.poly_id", "_item.w", "_item.n_cells", F.explode("_steps").alias("_step"))
        return rows.select(*[F.col("_step")[c].alias(c) if c in along else c for c in names], "poly_id", "w", "n_cells")
    return reduce(DataFrame.unionAll, map(product, range(parts)))


def store_means(store: GridStore, w: DataFrame, variables, start=None, end=None, strict: bool = True,
                limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """AG10 on a grid store: polygon averages with no exchange of the product, whatever the size of the weights.

    Weights of up to ``limit`` bytes are broadcast and only the partial sums (polygon and
    time) are exchanged; larger ones need a bucketed store (``block_means``)."""
    w = regions.with_cell_count(w)
    if not store.buckets or w.count() * regions.WEIGHT_ROW_BYTES <= limit:
        j = regions.join_weights(store.read(variables, start=start, end=end), w)
        return regions.weighted_mean(j, list(variables), strict=strict)
    return block_means(store, w, list(variables), start, end, strict)


def block_means(store: GridStore, w: DataFrame, variables: list[str], start=None, end=None, strict: bool = True) -> DataFrame:
    """``weighted_mean`` of a store's grid and large weights, by blocks of polygons of one home tile.

    The products of a polygon's cells are made and summed where its block is, to the same
    decimals; neither they nor partial sums are ever rows.  The grid is packed by tile and
    piece of the time axis, where its buckets lie, and each tile is sent to the blocks that
    meet it: what is exchanged is the grid times the blocks a tile meets, and the weights once
    a piece.  A task holds one block, and the tiles it meets for one piece."""
    spark, plan, step = store.spark, store.spec.plan, store.spec.step_seconds
    prepare_workers(spark)
    rows = _located(store, w)
    homes = rows.groupBy("poly_id").agg(F.min(F.struct("y_chunk", "x_chunk")).alias("home"), F.count("*").alias("n"))
    homes = materialise(homes, "homes")
    blocks = homes.groupBy("home").agg(F.ceil(F.sum("n") / F.lit(PACKED)).alias("n_blocks"))
    homes = homes.join(size_checked_broadcast(blocks, 24), "home").select(
        "poly_id", F.struct("home", F.pmod(F.xxhash64("poly_id"), F.col("n_blocks")).alias("part")).alias("block"))
    rows = materialise(rows.join(homes, "poly_id").select("block", "poly_id", "y_chunk", "x_chunk", "cell", "w", "n_cells"), "blocks")
    needs = materialise(rows.select("block", "y_chunk", "x_chunk").distinct(), "needs")
    sizes = needs.groupBy("block").count().agg(F.count("*").alias("blocks"), F.max("count").alias("tiles")).first()   # two scalars
    steps = max(1, min(PIECE_STEPS, PIECE_VALUES // (plan.y * plan.x * (sizes["tiles"] or 1))))

    grid = store.read(variables, start=start, end=end, by_tile=True)
    at = F.floor(ta.seconds_since("time", store.axis_start) / F.lit(step))
    cell = F.struct(_cell_number(store).alias("cell"), F.pmod(at, F.lit(steps)).cast("int").alias("pos"), *variables)
    pieces = grid.groupBy(*BUCKET_KEYS, F.floor(at / F.lit(steps)).alias("piece")).agg(F.collect_list(cell).alias("rows"))
    tasks = int(max(1, min(sizes["blocks"] * -(-store.n_steps // steps), 4096)))
    keys = ["block", "piece"]
    sent = pieces.join(size_checked_broadcast(needs, 48), ["y_chunk", "x_chunk"]).repartition(tasks, *keys)
    met = sent.groupBy(*keys).agg(F.collect_list(F.struct("y_chunk", "x_chunk", "rows")).alias("tiles"))
    items = rows.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("poly_id", "y_chunk", "x_chunk", "cell", "w", "n_cells"))).alias("items"))
    items = items.select("block", "items", F.explode(F.sequence(F.lit(0).cast("long"), F.lit((store.n_steps - 1) // steps).cast("long"))).alias("piece"))
    joined = met.join(items.repartition(tasks, *keys).hint("shuffle_hash"), keys).select("piece", "items", "tiles")
    schema = "poly_id long, step long, " + ", ".join(f"`{v}` double" for v in variables)
    means = joined.mapInArrow(tilemeans.block_means(variables, plan.y * plan.x, steps, strict), schema)
    seconds = F.col("step") * step
    time = ta.ntz(store.axis_start) + F.make_dt_interval(F.floor(seconds / 86400).cast("int"), F.lit(0), F.lit(0), F.pmod(seconds, F.lit(86400)).cast("decimal(18,6)"))
    return means.select("poly_id", time.alias("time"), *variables)


# --- JB11 region_daily --------------------------------------------------------
def region_daily(spark: SparkSession, daily_grid: DataFrame, weights_path: str, out_path: str,
                 first_year: int, last_year: int, variables=("RAIN", "T2MAX", "T2MIN")) -> None:
    """Polygon averages of all years and variables in one job: grid (time
    range pushed down) joined to the weights, averaged, converted, written
    one directory per year."""
    g = daily_grid.where((F.col("time") >= F.make_timestamp_ntz(F.lit(first_year), F.lit(1), F.lit(1),
                                                                 F.lit(0), F.lit(0), F.lit(0)))
                         & (F.col("time") < F.make_timestamp_ntz(F.lit(last_year + 1), F.lit(1), F.lit(1),
                                                                  F.lit(0), F.lit(0), F.lit(0))))
    j = regions.join_weights(g, read_weights(spark, weights_path))
    means = regions.weighted_mean(j, list(variables))
    write_yearly(fv.convert_units(means, keep=("poly_id", "time")), out_path)


def region_daily_store(store: GridStore, weights_path: str, out_path: str, first_year: int, last_year: int,
                       variables=("RAIN", "T2MAX", "T2MIN"), strict: bool = True, limit: int = BROADCAST_LIMIT_BYTES) -> None:
    """JB11 on a grid store: the years' polygon averages by ``store_means``, converted, one directory per year."""
    means = store_means(store, read_weights(store.spark, weights_path), variables, f"{first_year:04d}-01-01", f"{last_year:04d}-12-31",
                        strict, limit)
    write_yearly(fv.convert_units(means, keep=("poly_id", "time")), out_path)
