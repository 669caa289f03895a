"""Check jobs: JB08 check_min_max and JB09 check_missing (hourly and daily grids)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import quality as qa
from ..sources import summaries


def check_min_max(grid: DataFrame, axis: DataFrame, n_cells, variables) -> DataFrame:
    """Min and max per variable and year (4-decimal text, NULL = missing values).

    ``variables`` is used as given (the hourly reference ignores it; here an
    empty list means all variables)."""
    return qa.range_report(qa.yearly_range(grid, axis, n_cells, variables or None))


def check_min_max_overall(grid: DataFrame, axis: DataFrame, n_cells, variables) -> DataFrame:
    return qa.overall_range(qa.yearly_range(grid, axis, n_cells, variables or None))


def check_missing(grid: DataFrame, axis: DataFrame, n_cells, variables) -> DataFrame:
    """Years with missing values: ``Variable / Year / Max missing`` (empty = clean)."""
    return qa.qa_report(qa.max_missing(grid, axis, n_cells, variables or None))


def _store_variables(store, variables) -> list[str]:
    return [v for v in variables or store.variables if v not in qa.SCALAR_VARS]


def yearly_range_store(store, variables=None, n_cells: int | None = None) -> DataFrame:
    """AG05 on a grid store: from its summaries where it keeps them; only chunks without a current one are scanned."""
    n, names = n_cells if n_cells is not None else store.n_cells(), _store_variables(store, variables)
    if not store.keeps_summaries:
        return qa.yearly_range(store.read(names), store.axis(), n, names)
    return qa.yearly_range_of_summaries(summaries.current_summaries(store, names), store.axis(), n, names)


def count_present_store(store, variables=None) -> DataFrame:
    """AG07 on a grid store, likewise."""
    names = _store_variables(store, variables)
    if not store.keeps_summaries:
        return qa.count_present(store.read(names), names)
    return qa.count_present_of_summaries(summaries.current_summaries(store, names), names)


def max_missing_store(store, variables=None, n_cells: int | None = None) -> DataFrame:
    """AG09 on a grid store, likewise."""
    n, names = n_cells if n_cells is not None else store.n_cells(), _store_variables(store, variables)
    return qa.max_missing_of_counts(count_present_store(store, names), store.axis(), n, names)


def check_missing_store(store, variables=None, n_cells: int | None = None) -> DataFrame:
    """JB09 on a grid store: axis, cell count and statistics come from the store's tables."""
    return qa.qa_report(max_missing_store(store, variables, n_cells))


def check_min_max_store(store, variables=None, n_cells: int | None = None) -> DataFrame:
    """JB08 on a grid store."""
    return qa.range_report(yearly_range_store(store, variables, n_cells))
