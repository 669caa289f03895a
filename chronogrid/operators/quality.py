"""Value-range and missing-value checks over whole grids.

A grid table is sparse: an absent row is a missing value.  Every count is
therefore compared against the time axis and the cell table, never against
the rows present.  All variables and years are handled by one aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import fixed_decimals
from .grid import KEYS

# Fixed value: variable left out of the checks (a scalar with no data).
SCALAR_VARS = ("crs",)


# --- PF13 strip_crs -----------------------------------------------------------
def data_variables(df: DataFrame, variables=None, exclude=("time_idx", "time_chunk", "y_chunk", "x_chunk")) -> list[str]:
    """Requested variables, or all non-key numeric columns; never ``crs``."""
    if variables:
        missing = [v for v in variables if v not in df.columns]
        if missing:
            raise KeyError(f"variables not in grid: {missing}")
        return [v for v in variables if v not in SCALAR_VARS]
    numeric = {"double", "float", "int", "bigint", "smallint"}
    return [c for c, t in df.dtypes if c not in KEYS and c not in exclude and c not in SCALAR_VARS and t in numeric]


def _unpivot(df: DataFrame, ids: list[str], variables: list[str], fields: list[str]) -> DataFrame:
    """Wide per-variable aggregate columns ``{field}__{var}`` -> one row per variable."""
    stacked = F.explode(F.array(*[
        F.struct(F.lit(v).alias("variable"), *[F.col(f"{f}__{v}").alias(f) for f in fields])
        for v in variables])).alias("_s")
    return df.select(*ids, stacked).select(*ids, "_s.*")


# --- AG08 count_steps ---------------------------------------------------------
def steps_per_year(axis: DataFrame) -> DataFrame:
    return axis.groupBy(F.year("time").alias("year")).agg(F.count("*").alias("n_steps"))


# --- AG05 yearly_range --------------------------------------------------------
def yearly_range(grid: DataFrame, axis: DataFrame, n_cells, variables=None) -> DataFrame:
    """Per variable and year: min and max over all cells and steps.

    Strict: NULL when any value of the year is missing, i.e. when fewer than
    ``steps x cells`` values are present.  Every year of the axis has a row, also
    one without any value.  ``n_cells`` is an int or a scalar
    column."""
    variables = data_variables(grid, variables)
    aggs = []
    for v in variables:
        aggs += [F.min(v).alias(f"lo__{v}"), F.max(v).alias(f"hi__{v}"), F.count(v).alias(f"n__{v}")]
    return _yearly_range(grid.groupBy(F.year("time").alias("year")).agg(*aggs), axis, n_cells, variables)


def yearly_range_of_summaries(summaries: DataFrame, axis: DataFrame, n_cells, variables) -> DataFrame:
    """``yearly_range`` from a store's chunk summaries."""
    aggs = []
    for v in variables:
        aggs += [F.min(f"lo__{v}").alias(f"lo__{v}"), F.max(f"hi__{v}").alias(f"hi__{v}"), F.sum(f"n__{v}").alias(f"n__{v}")]
    return _yearly_range(summaries.groupBy("year").agg(*aggs), axis, n_cells, variables)


def _yearly_range(per_year: DataFrame, axis: DataFrame, n_cells, variables) -> DataFrame:
    long = _unpivot(per_year, ["year"], variables, ["lo", "hi", "n"])
    steps = steps_per_year(axis)
    n_cells = n_cells if not isinstance(n_cells, int) else F.lit(n_cells)
    frame = steps.select("year", "n_steps", F.explode(F.array(*[F.lit(v) for v in variables])).alias("variable"))
    out = (frame.join(long, ["variable", "year"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
           .withColumn("n_expected", F.col("n_steps") * n_cells))
    full = F.col("n") == F.col("n_expected")
    return out.select("variable", "year",
                      F.when(full, F.col("lo")).alias("min_value"),
                      F.when(full, F.col("hi")).alias("max_value"),
                      F.col("lo").alias("min_present"), F.col("hi").alias("max_present"),
                      F.col("n").alias("n_values"), "n_expected")


# --- AG06 overall_range -------------------------------------------------------
def overall_range(yearly: DataFrame) -> DataFrame:
    """Range over all years: NULL if any year is missing; also the range of
    the values present."""
    any_missing = F.max(F.col("min_value").isNull().cast("int")) == 1
    return yearly.groupBy("variable").agg(
        F.when(~any_missing, F.min("min_value")).alias("overall_min"),
        F.when(~any_missing, F.max("max_value")).alias("overall_max"),
        F.min("min_present").alias("present_min"),
        F.max("max_present").alias("present_max"))


# --- AG07 count_present -------------------------------------------------------
def count_present(grid: DataFrame, variables=None) -> DataFrame:
    """Non-missing steps per variable, cell and year (cells with rows)."""
    variables = data_variables(grid, variables)
    per_cell = grid.groupBy(F.year("time").alias("year"), "y", "x").agg(
        *[F.count(v).alias(f"n__{v}") for v in variables])
    return _unpivot(per_cell, ["year", "y", "x"], variables, ["n"]).withColumnRenamed("n", "n_present")


def count_present_of_summaries(summaries: DataFrame, variables) -> DataFrame:
    """``count_present`` from a store's chunk summaries."""
    per_cell = summaries.groupBy("year", "y", "x").agg(*[F.sum(f"n__{v}").alias(f"n__{v}") for v in variables])
    return _unpivot(per_cell, ["year", "y", "x"], variables, ["n"]).withColumnRenamed("n", "n_present")


# --- AG09 max_missing ---------------------------------------------------------
def max_missing(grid: DataFrame, axis: DataFrame, n_cells, variables=None) -> DataFrame:
    """Per variable and year: the largest number of missing steps of any cell,
    kept only when positive.

    A cell with no row in a year misses every step.  Instead of building the
    years x cells product, the number of cells with rows is compared with the
    cell total: if some cell has no row the answer is the year's step count,
    otherwise steps minus the smallest count present."""
    variables = data_variables(grid, variables)
    return max_missing_of_counts(count_present(grid, variables), axis, n_cells, variables)


def max_missing_of_counts(per_cell: DataFrame, axis: DataFrame, n_cells, variables) -> DataFrame:
    """``max_missing`` from the counts of ``count_present``."""
    per_year = per_cell.groupBy("variable", "year").agg(
        F.min("n_present").alias("min_n"), F.count("*").alias("cells_with_rows"))
    n_cells = n_cells if not isinstance(n_cells, int) else F.lit(n_cells)
    # every (variable, year) of the axis, so a year with no row at all is kept
    frame = steps_per_year(axis).select("year", "n_steps",
                                        F.explode(F.array(*[F.lit(v) for v in variables])).alias("variable"))
    out = frame.join(per_year, ["variable", "year"], "left").select(
        "variable", "year",
        (F.col("n_steps") - F.when(F.coalesce(F.col("cells_with_rows"), F.lit(0)) < n_cells, F.lit(0))
         .otherwise(F.col("min_n"))).alias("max_missing"))
    return where_positive(out, "max_missing")


def missing_per_cell(grid: DataFrame, axis: DataFrame, cells: DataFrame, variables=None) -> DataFrame:
    """Missing steps of every (variable, year, cell), absent cells included.

    Each cell row explodes into the axis years (a short array from two scalar
    subqueries), then the counts present are left-joined."""
    variables = data_variables(grid, variables)
    years = steps_per_year(axis)
    y0, y1 = years.select(F.min("year")).scalar(), years.select(F.max("year")).scalar()
    dense = (cells.select("y", "x", F.explode(F.sequence(y0, y1)).alias("year"))
             .select("year", "y", "x", F.explode(F.array(*[F.lit(v) for v in variables])).alias("variable")))
    present = count_present(grid, variables)
    return (dense.join(years, "year", "inner")
            .join(present, ["variable", "year", "y", "x"], "left")
            .select("variable", "year", "y", "x",
                    (F.col("n_steps") - F.coalesce(F.col("n_present"), F.lit(0))).alias("n_missing")))


# --- PF14 where_positive ------------------------------------------------------
def where_positive(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col) > 0)


# --- SR20 qa_report -----------------------------------------------------------
def qa_report(max_missing_df: DataFrame) -> DataFrame:
    """Report rows ``Variable / Year / Max missing``; no rows = no missing values."""
    return max_missing_df.select(F.col("variable").alias("Variable"),
                                 F.col("year").cast("string").alias("Year"),
                                 F.col("max_missing").cast("string").alias("Max missing"))


# --- JB08 text lines ----------------------------------------------------------
def range_report(yearly: DataFrame) -> DataFrame:
    """``<var> - <year>: <min> to <max>`` with 4 decimals, per variable and year."""
    return yearly.select("variable", "year", fixed_decimals("min_value").alias("min_txt"),
                         fixed_decimals("max_value").alias("max_txt"))
