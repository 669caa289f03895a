"""Registered queries: hourly -> daily reduction."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import timeaxis as ta
from ..functions import values as fv
from ..operators import daily, grid
from ..sources import fixtures as fx
from .registry import F1_BASE, F1_NAN_SQL, F1_SQL, daily_sql, f1, f1_daily, register


# ---------------------------------------------------------------------------
# Daily reduction (AG01-AG04, JN01, PF06, PF07, WN01, WN03)
# ---------------------------------------------------------------------------
@register("AG01_daily_max", f"SELECT time, y, x, T2MAX, n_T2D FROM ({daily_sql(F1_NAN_SQL)})")
def q_ag01(spark, sf_dir):
    return f1_daily(spark, sf_dir, plant_nan=True).select("time", "y", "x", "T2MAX", "n_T2D")


@register("AG02_daily_min", f"SELECT time, y, x, T2MIN, n_T2D FROM ({daily_sql(F1_NAN_SQL)})")
def q_ag02(spark, sf_dir):
    return f1_daily(spark, sf_dir, plant_nan=True).select("time", "y", "x", "T2MIN", "n_T2D")


@register("AG03_daily_sum", f"SELECT time, y, x, RAIN, n_RAINRATE FROM ({daily_sql(F1_NAN_SQL)})")
def q_ag03(spark, sf_dir):
    return f1_daily(spark, sf_dir, plant_nan=True).select("time", "y", "x", "RAIN", "n_RAINRATE")


@register("AG04_block_time_label", f"""WITH h AS ({F1_SQL}),
b AS (SELECT CAST(floor(date_diff('second', {F1_BASE}, time) / 86400) AS INTEGER) AS blk, * FROM h)
SELECT {F1_BASE} + to_days(blk) AS time, y, x, CAST(count(*) AS INTEGER) AS n_hours,
  CASE WHEN count(*) = 24 THEN {F1_BASE} + to_microseconds(CAST(round(avg(date_diff('second', {F1_BASE}, time)) - 690 * 60) AS BIGINT) * 1000000) END AS mean_label
FROM b GROUP BY blk, y, x""")
def q_ag04(spark, sf_dir):
    base = fx.F1_SPEC.base_date
    h = f1(spark, sf_dir).withColumn("_blk", daily.block_index(ta.steps_since("time", base, 3600)))
    return (h.groupBy("_blk", "y", "x")
            .agg(F.count("*").cast("int").alias("n_hours"),
                 F.when(F.count("*") == 24, daily.mean_minus_offset_label(F.col("time"), base)).alias("mean_label"))
            .select(daily.block_label(base, "_blk").alias("time"), "y", "x", "n_hours", "mean_label"))


@register("JN01_merge_daily", f"SELECT time, y, x, T2MAX, T2MIN, RAIN FROM ({daily_sql(F1_SQL)})")
def q_jn01(spark, sf_dir):
    return f1_daily(spark, sf_dir).select("time", "y", "x", "T2MAX", "T2MIN", "RAIN")


@register("PF06_derive_daily_vars",
          f"SELECT time, y, x, T2D AS T2MAX, T2D AS T2MIN, RAINRATE AS RAIN FROM ({F1_SQL})")
def q_pf06(spark, sf_dir):
    h = f1(spark, sf_dir)
    cols = daily.daily_template_columns(h.columns)
    return h.select("time", "y", "x", *[F.col(daily.DAILY_SOURCES[c]).alias(c) for c in cols])


@register("PF07_scale_var", f"SELECT time, y, x, RAINRATE * 3600 AS rain_mm FROM ({F1_SQL})")
def q_pf07(spark, sf_dir):
    return f1(spark, sf_dir).select("time", "y", "x", fv.rate_to_step_total("RAINRATE").alias("rain_mm"))


@register("WN03_block_index", f"""SELECT time, y, x,
  CAST(date_diff('hour', {F1_BASE}, time) AS INTEGER) AS time_idx,
  CAST(floor(date_diff('hour', {F1_BASE}, time) / 24) AS INTEGER) AS block FROM ({F1_SQL})""")
def q_wn03(spark, sf_dir):
    h = grid.with_time_index(f1(spark, sf_dir), fx.F1_SPEC.base_date, 3600)
    return h.select("time", "y", "x", "time_idx", daily.block_index("time_idx").alias("block"))


@register("WN01_fill_last_time", f"""WITH d AS (SELECT DISTINCT CAST(floor(date_diff('hour', {F1_BASE}, time) / 24) AS INTEGER) AS time_idx FROM ({F1_SQL})),
a AS (SELECT time_idx, CASE WHEN time_idx = (SELECT max(time_idx) FROM d) THEN NULL ELSE {F1_BASE} + to_days(time_idx) END AS time FROM d),
p AS (SELECT time_idx + 1 AS time_idx, time AS prev FROM a)
SELECT a.time_idx, coalesce(a.time, p.prev + INTERVAL 1 DAY) AS time FROM a LEFT JOIN p USING (time_idx)""")
def q_wn01(spark, sf_dir):
    base = fx.F1_SPEC.base_date
    d = (f1(spark, sf_dir).select(daily.block_index(ta.steps_since("time", base, 3600)).alias("time_idx"))
         .distinct())
    last = d.select(F.max("time_idx")).scalar()          # scalar subquery, no join
    # the last block's time is unknown (NaT in the reference) and gets filled
    ax = d.select("time_idx", F.when(F.col("time_idx") == last, F.lit(None))
                  .otherwise(daily.block_label(base, "time_idx")).alias("time"))
    return daily.fill_missing_time(ax)


# F1 without some hours, and with every ninth hour of the day twice, the second time halved: a
# repeated hour counts once and never in place of a missing one.
REPEATED_SQL = f"""SELECT time, y, x, max(T2D) AS T2D, max(RAINRATE) AS RAINRATE FROM (
  SELECT * FROM ({F1_SQL}) WHERE NOT (hour(time) = 7 AND day(time) % 3 = 0 AND y = 0)
  UNION ALL SELECT time, y, x, T2D / 2, RAINRATE / 2 FROM ({F1_SQL}) WHERE hour(time) % 9 = 0) GROUP BY time, y, x"""


def repeated_hours(spark, sf_dir):
    g = f1(spark, sf_dir)
    kept = g.where(~((F.hour("time") == 7) & (F.dayofmonth("time") % 3 == 0) & (F.col("y") == 0)))
    again = g.where(F.hour("time") % 9 == 0).select("time", "y", "x", (F.col("T2D") / 2).alias("T2D"), (F.col("RAINRATE") / 2).alias("RAINRATE"))
    return kept.unionByName(again)


@register("AG03_daily_repeated_hours", daily_sql(REPEATED_SQL))
def q_ag03_repeated(spark, sf_dir):
    return daily.daily_reduce(repeated_hours(spark, sf_dir), fx.F1_SPEC.base_date, with_counts=True)


@register("AG03_daily_merged_states", daily_sql(REPEATED_SQL))
def q_ag03_states(spark, sf_dir):
    """The same from the states of three batches that share days and hours, in any order."""
    base = fx.F1_SPEC.base_date
    h = repeated_hours(spark, sf_dir).groupBy("time", "y", "x").agg(F.max("T2D").alias("T2D"), F.max("RAINRATE").alias("RAINRATE"))
    parts = [h.where(F.hour("time") < 10), h.where(F.hour("time").between(8, 20)), h.where(F.hour("time") >= 19)]
    states = daily.day_state(parts[1], base)
    for p in (parts[0], parts[2]):
        states = daily.merge_states(states, daily.day_state(p, base))
    return daily.days_of_states(states, base, with_counts=True)
