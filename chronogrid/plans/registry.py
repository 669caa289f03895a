"""Query registry, shared SQL fixtures and Spark fixture helpers.

Every query reads the supplied tables (``events``, ``lineitem``, ``region``) and
builds its input grid with Spark, so its work grows with the tables.  The oracle
is the same computation written in SQL for DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import daily
from ..sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------
# SQL fixtures (DuckDB)
# ---------------------------------------------------------------------------
F1_BASE = "TIMESTAMP '2024-01-01 00:00:00'"
F1_SQL = """SELECT date_trunc('hour', ts) AS time, CAST(floor((user_id % 4) / 2) AS INTEGER) AS y,
       CAST(user_id % 2 AS INTEGER) AS x, max(value) AS T2D, min(value) AS RAINRATE
FROM events GROUP BY 1, 2, 3"""
F1_NAN_SQL = """SELECT time, y, x, CASE WHEN isnan(T2D) THEN NULL ELSE T2D END AS T2D,
       CASE WHEN isnan(RAINRATE) THEN NULL ELSE RAINRATE END AS RAINRATE FROM (
  SELECT date_trunc('hour', ts) AS time, CAST(floor((user_id % 4) / 2) AS INTEGER) AS y,
         CAST(user_id % 2 AS INTEGER) AS x, max(v) AS T2D, min(v) AS RAINRATE
  FROM (SELECT *, CASE WHEN event_id % 97 = 0 THEN 'NaN'::DOUBLE ELSE value END AS v FROM events)
  GROUP BY 1, 2, 3)"""
F2_SQL = """SELECT l_shipdate AS time, CAST(l_linenumber AS INTEGER) AS y, CAST(l_partkey % 64 AS INTEGER) AS x,
       max(l_quantity) AS qty, max(l_extendedprice) AS price
FROM lineitem GROUP BY 1, 2, 3"""


def daily_sql(src: str) -> str:
    return f"""WITH h AS ({src}),
b AS (SELECT CAST(floor(date_diff('second', {F1_BASE}, time) / 86400) AS INTEGER) AS blk, * FROM h)
SELECT {F1_BASE} + to_days(blk) AS time, y, x,
  CASE WHEN count(T2D) = 24 THEN max(T2D) END AS T2MAX,
  CASE WHEN count(T2D) = 24 THEN min(T2D) END AS T2MIN,
  CASE WHEN count(RAINRATE) = 24 THEN CAST(sum(CAST(RAINRATE * 3600 AS DECIMAL(38,12))) AS DOUBLE) END AS RAIN,
  CAST(count(T2D) AS INTEGER) AS n_T2D, CAST(count(RAINRATE) AS INTEGER) AS n_RAINRATE
FROM b GROUP BY blk, y, x"""


def f1(spark, sf_dir, plant_nan=False):
    return fx.hourly_grid(spark, sf_dir, plant_nan=plant_nan)


def f1_daily(spark, sf_dir, plant_nan=False):
    return daily.daily_reduce(f1(spark, sf_dir, plant_nan), fx.F1_SPEC.base_date, with_counts=True, unique=True)



# lineitem ship dates (F2 times) as a SQL list of distinct days
F2_TIMES_SQL = "SELECT DISTINCT l_shipdate AS time FROM lineitem"
