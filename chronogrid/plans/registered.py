"""All registered queries (one per operator of the inventory) and their DuckDB oracles."""

from . import q_arrays, q_daily, q_ingest, q_quality, q_projection, q_regions, q_store, q_time  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
