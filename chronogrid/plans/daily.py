"""Daily-store jobs: JB03 create_daily, JB04 process_daily, JB05 (daily)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ChunkPlan, GridSpec
from ..operators import daily as dops
from ..sources.gridstore import GridStore, catalog_frame


def create_daily(spark, path: str, hourly: GridStore, plan: ChunkPlan) -> GridStore:
    """JB03: empty daily store from an hourly store.

    Axis: one step per day from the first hourly time, up to the last hourly time;
    variables ``T2MAX``, ``T2MIN``, ``RAIN`` with their fixed attributes."""
    ax = hourly.axis().agg(F.min("time").alias("s"), F.max("time").alias("e")).collect()[0]
    # one step per day from the first hourly time while not past the last one
    start, end = ax["s"], ax["e"]
    variables = dops.daily_template_columns(hourly.variables)
    spec = GridSpec(hourly.spec.base_literal, "day", plan)
    catalog = catalog_frame(spark, [(v, ["time", "y", "x"], dops.DAILY_ATTRS[v], {}) for v in variables])
    cells = hourly.cells() if hourly.has_cells else None
    store = GridStore.create(spark, path, spec, start, end, variables, catalog, cells)
    if hourly.meta["n_cells"] is not None:
        store.meta["n_cells"] = hourly.meta["n_cells"]
        store._save_meta()
    return store


def daily_chunk_hours(daily_spec: GridSpec, axis_start: _dt.datetime, first_chunk: int, last_chunk: int) -> tuple[_dt.datetime, _dt.datetime]:
    """Inclusive hourly times of the day blocks whose labels lie in daily chunks ``first..last``.

    Blocks run from the start of the hourly axis, whatever its hour; a block belongs
    to the chunk of its label (its first hour) as a whole."""
    day = _dt.timedelta(days=1)
    low = daily_spec.base + _dt.timedelta(seconds=first_chunk * daily_spec.chunk_seconds)
    high = daily_spec.base + _dt.timedelta(seconds=(last_chunk + 1) * daily_spec.chunk_seconds)
    block = lambda t: max(0, -((axis_start - t) // day))  # noqa: E731  the first block labelled t or later
    return axis_start + block(low) * day, axis_start + block(high) * day - _dt.timedelta(hours=1)


def daily_from_hourly(hourly: GridStore, daily_spec: GridSpec | None = None,
                      first_chunk: int | None = None, last_chunk: int | None = None) -> DataFrame:
    """JB04 core: strict daily values (of daily chunks ``first..last`` if given).

    The chunk range becomes a time range of whole blocks on the hourly read, which
    the store turns into a ``time_chunk`` partition filter plus Parquet range
    predicates, so only the needed hourly chunks are scanned.  One exchange, partial
    aggregation before it.  A range that begins after the last hourly time is an
    error (PF16)."""
    axis = hourly.axis().agg(F.min("time").alias("first"), F.max("time").alias("last")).collect()[0]   # two scalars
    start = end = None
    if daily_spec is not None and first_chunk is not None:
        start, end = daily_chunk_hours(daily_spec, axis["first"], first_chunk,
                                       last_chunk if last_chunk is not None else first_chunk)
        if start > axis["last"]:
            raise ValueError(f"daily chunk {first_chunk} begins at {start}; the hourly axis ends at {axis['last']}")
        if end < start:
            end = start - _dt.timedelta(hours=1)
    df = hourly.read([v for v in ("T2D", "RAINRATE") if v in hourly.variables],
                     start=start and start.strftime("%Y-%m-%d %H:%M:%S"), end=end and end.strftime("%Y-%m-%d %H:%M:%S"))
    return dops.daily_reduce(df, axis["first"], hourly.spec.step_seconds, unique=True)


def process_daily(hourly: GridStore, daily_store: GridStore, first_chunk: int | None = None,
                  last_chunk: int | None = None) -> DataFrame:
    """JB04 / JB12: compute and insert daily chunks ``first..last`` in one job.

    Returns the chunk log (SR21) of the written chunks: chunk, first/last time,
    first/last axis index (lazy, read from the written partitions)."""
    d = daily_from_hourly(hourly, daily_store.spec, first_chunk, last_chunk)
    # attributes are lost by the aggregation: re-attach them from the catalog
    from ..operators.catalog import attrs_of, with_attrs
    d = with_attrs(d, attrs_of(daily_store.catalog(), [c for c in d.columns if c not in ("time", "y", "x")]))
    daily_store.write_region(d)
    from ..operators.layout import chunk_log
    written = daily_store.read([], with_chunks=True)
    if first_chunk is not None:
        written = written.where(F.col("time_chunk").between(first_chunk, last_chunk if last_chunk is not None
                                                            else first_chunk))
    return chunk_log(daily_store.locate(written))


def extend_daily(hourly: GridStore, daily_store: GridStore) -> bool:
    """JB05 (daily): extend the daily axis to the last day block of the hourly axis.

    An axis that already reaches that day stays as it is."""
    ends = hourly.axis().agg(F.min("time").alias("first"), F.max("time").alias("last")).collect()[0]
    label = ends["first"] + _dt.timedelta(days=(ends["last"] - ends["first"]).days)
    last = daily_store.axis().agg(F.max("time")).collect()[0][0]
    if label.date() <= last.date():
        return False
    return daily_store.extend_time(label)
