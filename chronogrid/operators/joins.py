"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side broadcast on purpose (estimated bytes).  Beyond it the planner
# shuffles both sides (sort-merge join, with AQE skew splitting).
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def size_checked_broadcast(df: DataFrame, row_bytes: int, limit: int = BROADCAST_LIMIT_BYTES,
                           n_rows: int | None = None) -> DataFrame:
    """``broadcast(df)`` when ``rows x row_bytes`` fits the limit, else ``df``.

    ``n_rows`` may be passed when a bound is already known (e.g. the axis
    length); otherwise the rows are counted (one cheap action on a small,
    usually already aggregated, side)."""
    n = n_rows if n_rows is not None else df.count()
    return F.broadcast(df) if n * row_bytes <= limit else df
