"""Chunk layout: rechunk, tile packing, chunk summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ChunkPlan, GridSpec
from . import grid as gops

TILE = ("time_chunk", "y_chunk", "x_chunk")


# --- LY01 rechunk -------------------------------------------------------------
def rechunk(df: DataFrame, spec: GridSpec) -> DataFrame:
    """Re-tile rows so each task holds whole (time, y, x) chunks, sorted inside.

    The shuffle is the reference's temporary store: memory-bounded by Spark's
    spill, retried by task retries.  Tiles are bounded by the chunk plan, so no
    task receives an unbounded group."""
    tiled = gops.with_chunk_columns(df, spec)
    return (tiled.repartition(*TILE)
            .sortWithinPartitions(*TILE, "time", "y", "x"))


# --- LY03 tile_pack -----------------------------------------------------------
def tile_pack(df: DataFrame, spec: GridSpec, axis_start, variable: str, max_values: int = 65_536) -> DataFrame:
    """Tiles as rows of values ordered by position (row-major time, y, x inside the
    tile), for export.  A row holds whole steps, ``slab`` after ``slab``, of at most
    ``max_values`` values (one step at least), so no task builds a large tile as one
    row."""
    p = spec.plan
    steps = max(1, min(p.time, max_values // (p.y * p.x)))
    t = gops.with_time_index(df, axis_start, spec.step_seconds)
    t = gops.with_chunk_columns(t, spec)
    step = F.pmod(F.col("time_idx"), F.lit(p.time))
    pos = (step * p.y + (F.col("y") % p.y)) * p.x + (F.col("x") % p.x)
    return (t.groupBy(*TILE, F.floor(step / steps).cast("int").alias("slab"))
            .agg(F.array_sort(F.collect_list(F.struct(pos.alias("pos"), F.col(variable).alias("v"))))
                 .alias("values")))


# --- LY04 chunk_summary -------------------------------------------------------
def chunk_summary(axis: DataFrame, grid: DataFrame, n_cells) -> DataFrame:
    """Per time chunk: time range and index range on the axis, rows written,
    and whether every (step, cell) has a row."""
    ax = axis.groupBy("time_chunk").agg(
        F.min("time").alias("start_time"), F.max("time").alias("end_time"),
        F.min("time_idx").alias("first_idx"), F.max("time_idx").alias("last_idx"),
        F.count("*").alias("n_steps"))
    rows = grid.groupBy("time_chunk").agg(F.count("*").alias("n_rows"))
    n_cells = n_cells if not isinstance(n_cells, int) else F.lit(n_cells)
    return (ax.join(rows, "time_chunk", "left")
            .withColumn("n_rows", F.coalesce(F.col("n_rows"), F.lit(0)))
            .withColumn("complete", F.col("n_rows") == F.col("n_steps") * n_cells))


# --- SR21 chunk_log -----------------------------------------------------------
def chunk_log(df: DataFrame, idx_col: str = "time_idx") -> DataFrame:
    """Chunk / date range / index range of processed chunks."""
    return df.groupBy("time_chunk").agg(
        F.min("time").alias("first_time"), F.max("time").alias("last_time"),
        F.min(idx_col).alias("first_idx"), F.max(idx_col).alias("last_idx"))


# --- SC18 clamp_chunk ---------------------------------------------------------
def clamp_chunks(dims: DataFrame, plan: ChunkPlan) -> DataFrame:
    """``dims(varname, dim, length)`` -> chunk size per dimension: the plan's
    size capped at the length, or the whole length when not in the plan."""
    plan_map = F.create_map(*[x for k, v in plan.as_dict().items() for x in (F.lit(k), F.lit(v))])
    size = F.element_at(plan_map, F.col("dim"))
    return dims.withColumn("chunk", F.coalesce(F.least(size, F.col("length")), F.col("length")).cast("long"))
