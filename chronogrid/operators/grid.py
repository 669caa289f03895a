"""Grid-table operators: selection, slicing, axis alignment, dense view."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import GridSpec, parse_base_date
from ..functions import timeaxis as ta

KEYS = ("time", "y", "x")
CELL_KEYS = ("y", "x")


# --- axis and cells ---------------------------------------------------------
def make_axis(spark: SparkSession, start, end, spec: GridSpec) -> DataFrame:
    """Regular axis ``(time_idx, time, time_chunk)`` from ``start`` to ``end`` inclusive.

    Generated from ``spark.range`` so the rows are produced in parallel
    (``sequence`` + ``explode`` would build the whole axis in one task).
    """
    s, e = parse_base_date(start), parse_base_date(end)
    if e < s:
        raise ValueError("axis end before start")
    n = int((e - s).total_seconds() // spec.step_seconds) + 1
    t = ta.ntz(s) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                       (F.col("id") * spec.step_seconds).cast("decimal(18,6)"))
    return (spark.range(n).select(F.col("id").cast("int").alias("time_idx"), t.alias("time"))
            .withColumn("time_chunk", ta.chunk_index("time", spec)))


def make_cells(spark: SparkSession, ny: int, nx: int) -> DataFrame:
    """Rectangular cell table ``(y, x)``."""
    return spark.range(ny * nx).select((F.col("id") / nx).cast("int").alias("y"),
                                       (F.col("id") % nx).cast("int").alias("x"))


def with_chunk_columns(df: DataFrame, spec: GridSpec) -> DataFrame:
    """Add ``time_chunk`` (partition) and ``y_chunk``/``x_chunk`` (clustering)."""
    return df.withColumns({
        "time_chunk": ta.chunk_index("time", spec),
        "y_chunk": (F.col("y") / spec.plan.y).cast("int"),
        "x_chunk": (F.col("x") / spec.plan.x).cast("int"),
    })


def with_time_index(df: DataFrame, axis_start, step_seconds: int, name: str = "time_idx") -> DataFrame:
    """Position on a regular axis computed from ``time`` (no join needed)."""
    return df.withColumn(name, ta.steps_since("time", axis_start, step_seconds).cast("int"))


# --- PF01 / PF02 ------------------------------------------------------------
def select_vars(df: DataFrame, names, keys=KEYS) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"variables not in grid: {missing}")
    return df.select(*[k for k in keys if k in df.columns], *names)


def drop_vars(df: DataFrame, names) -> DataFrame:
    """Drop variables; absent names are ignored."""
    return df.drop(*names)


# --- PF03 slice_by_index ------------------------------------------------------
def slice_by_index(df: DataFrame, st: int, en: int, idx_col: str = "time_idx", axis_start=None,
                   step_seconds: int | None = None) -> DataFrame:
    """Half-open positional slice ``st <= idx < en``.

    On a regular axis whose start is given the bounds become literals on ``time``,
    which reach the scan."""
    if axis_start is not None:
        at = lambda i: parse_base_date(axis_start) + _dt.timedelta(seconds=i * step_seconds)
        return df.where((F.col("time") >= ta.ntz(at(st))) & (F.col("time") < ta.ntz(at(en))))
    return df.where((F.col(idx_col) >= st) & (F.col(idx_col) < en))


# --- PF04 slice_by_label ------------------------------------------------------
def label_bounds(start_label: str, end_label: str) -> tuple[_dt.datetime, _dt.datetime]:
    """Inclusive label slice as a half-open range; a date-only end covers its whole day."""
    s = parse_base_date(start_label)
    e = parse_base_date(end_label)
    if len(end_label.strip()) == 10:
        e = e + _dt.timedelta(days=1)
    else:
        e = e + _dt.timedelta(microseconds=1)
    return s, e


def slice_by_label(df: DataFrame, start_label: str, end_label: str,
                   spec: GridSpec | None = None) -> DataFrame:
    """Rows with ``start <= time <= end`` as range predicates on the raw column
    (so Parquet statistics prune), plus a ``time_chunk`` partition predicate when
    the grid is chunk-partitioned."""
    s, e = label_bounds(start_label, end_label)
    cond = (F.col("time") >= ta.ntz(s)) & (F.col("time") < ta.ntz(e))
    if spec is not None and "time_chunk" in df.columns:
        c0, c1 = ta.time_chunk_bounds(s, e - _dt.timedelta(microseconds=1), spec)
        cond = F.col("time_chunk").between(c0, c1) & cond
    return df.where(cond)


# --- JN02 locate_time ---------------------------------------------------------
def locate_time(src: DataFrame, axis: DataFrame, n_steps: int | None = None) -> DataFrame:
    """Attach the destination axis position to every source row.

    Each source time must occur exactly once on the axis; otherwise the job fails
    (``raise_error`` inside the plan, no driver round trip).  The source is read
    once; the axis has one row a step and is broadcast when it is small, so the many
    rows of a step are never shuffled into one task.  ``n_steps`` (the axis length,
    where it is known) saves counting it.  On a regular axis ``locate_regular``
    needs no join."""
    from .joins import size_checked_broadcast
    counted = axis.groupBy("time").agg(F.count("*").alias("_n"), F.min("time_idx").cast("int").alias("time_idx"))
    j = src.join(size_checked_broadcast(counted, 24, n_rows=n_steps), "time", "left")
    return _checked_time(j, F.coalesce(F.col("_n") == 1, F.lit(False)), "time not on axis exactly once: ").drop("_n")


def locate_regular(src: DataFrame, axis_start, n_steps: int, step_seconds: int) -> DataFrame:
    """Axis positions computed from ``time``: no join.  A time off the axis
    (misaligned, before its start or after its end) fails the job in the plan."""
    secs = ta.seconds_since("time", axis_start)
    idx = F.floor(secs / F.lit(step_seconds)).cast("long")
    ok = (F.pmod(secs, F.lit(step_seconds)) == 0) & (idx >= 0) & (idx < F.lit(n_steps))
    return _checked_time(src.withColumn("time_idx", idx.cast("int")), ok, "time not on the store axis: ")


def _checked_time(df: DataFrame, ok, message: str) -> DataFrame:
    # the check sits on ``time`` itself, which every use keeps, so column pruning
    # cannot drop it
    checked = F.when(ok, F.col("time")).otherwise(F.raise_error(F.concat(F.lit(message), F.col("time").cast("string"))))
    return df.withColumn("time", checked.cast("timestamp_ntz"))


# --- JN05 axis_fill -----------------------------------------------------------
def dense_view(grid: DataFrame, axis: DataFrame, ny: int, nx: int) -> DataFrame:
    """Every (step, cell) of the array; unwritten positions are NULL.

    The dense index is generated from the axis by exploding the rows of cells of
    each step, then the cells of each row (output-sized work, no cross join, arrays
    no longer than a side), then left-joined to the grid.
    """
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    idx = axis.select("time_idx", "time", numbers(ny).alias("y")).select("time_idx", "time", "y", numbers(nx).alias("x"))
    return idx.join(grid, list(KEYS), "left")


# --- ST01 concat_time ---------------------------------------------------------
def concat_time(frames) -> DataFrame:
    """Concatenate grids along time (columns matched by name)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# --- AG13 time_extent ---------------------------------------------------------
def time_extent(df: DataFrame) -> DataFrame:
    return df.agg(F.min("time").alias("first_time"), F.max("time").alias("last_time"))
