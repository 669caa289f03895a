"""Registered queries: value-range and missing-value checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import timeaxis as ta
from ..operators import quality as qa
from ..session import materialise, scratch_path
from ..sources import fixtures as fx
from ..sources.gridstore import GridStore
from ..sources.summaries import incomplete_steps
from . import checks
from .registry import F1_SQL, F2_SQL, f1, register


def f2_axis(g):
    """Daily axis from the grid's first to last day (one row per day)."""
    ext = g.agg(F.min("time").alias("s"), F.max("time").alias("e"))
    return ext.select(F.explode(ta.date_range(F.col("s"), F.col("e"), "day")).alias("time"))


def f1_axis(g):
    """Hourly axis over the whole days spanned by the grid."""
    ext = g.agg(ta.floor_day(F.min("time")).alias("s"), ta.floor_day(F.max("time")).alias("e"))
    days = ext.select(F.explode(ta.date_range(F.col("s"), F.col("e"), "day")).alias("d"))
    return days.select(F.explode(ta.date_range(F.col("d"), ta.add_interval("d", hours=23), "hour")).alias("time"))


def f2_grid(spark, sf_dir):
    """F2 written once: the axis, the number of cells and the checks read it from there."""
    return materialise(fx.daily_grid(spark, sf_dir), "f2")


def n_cells(g):
    return g.select("y", "x").distinct().select(F.count("*")).scalar()


F2_FRAME = f"""g AS ({F2_SQL}),
ax AS (SELECT unnest(generate_series((SELECT min(time) FROM g), (SELECT max(time) FROM g), INTERVAL 1 DAY)) AS time),
steps AS (SELECT CAST(year(time) AS INTEGER) AS year, count(*) AS n_steps FROM ax GROUP BY 1),
nc AS (SELECT count(*) AS n_cells FROM (SELECT DISTINCT y, x FROM g))"""

F1_FRAME = f"""g AS ({F1_SQL}),
ax AS (SELECT unnest(generate_series(date_trunc('day', (SELECT min(time) FROM g)),
                                     date_trunc('day', (SELECT max(time) FROM g)) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS time),
steps AS (SELECT CAST(year(time) AS INTEGER) AS year, count(*) AS n_steps FROM ax GROUP BY 1),
nc AS (SELECT count(*) AS n_cells FROM (SELECT DISTINCT y, x FROM g))"""

YEARLY_SQL = f"""WITH {F2_FRAME},
py AS (SELECT CAST(year(time) AS INTEGER) AS year, min(qty) AS lo_q, max(qty) AS hi_q, count(qty) AS n_q,
              min(price) AS lo_p, max(price) AS hi_p, count(price) AS n_p FROM g GROUP BY 1),
lg AS (SELECT 'qty' AS variable, year, lo_q AS lo, hi_q AS hi, n_q AS n FROM py
       UNION ALL SELECT 'price', year, lo_p, hi_p, n_p FROM py)
SELECT v.variable, s.year, CASE WHEN n = n_steps * n_cells THEN lo END AS min_value,
       CASE WHEN n = n_steps * n_cells THEN hi END AS max_value, lo AS min_present, hi AS max_present,
       coalesce(n, 0) AS n_values, n_steps * n_cells AS n_expected
FROM steps s CROSS JOIN (VALUES ('qty'), ('price')) v(variable) CROSS JOIN nc
LEFT JOIN lg ON lg.year = s.year AND lg.variable = v.variable"""


def yearly(spark, sf_dir):
    g = f2_grid(spark, sf_dir)
    return qa.yearly_range(g, f2_axis(g), n_cells(g), ["qty", "price"])


@register("AG05_yearly_range", YEARLY_SQL)
def q_ag05(spark, sf_dir):
    return yearly(spark, sf_dir)


@register("AG06_overall_range", f"""SELECT variable,
  CASE WHEN bool_or(min_value IS NULL) THEN NULL ELSE min(min_value) END AS overall_min,
  CASE WHEN bool_or(min_value IS NULL) THEN NULL ELSE max(max_value) END AS overall_max,
  min(min_present) AS present_min, max(max_present) AS present_max FROM ({YEARLY_SQL}) GROUP BY variable""")
def q_ag06(spark, sf_dir):
    return qa.overall_range(yearly(spark, sf_dir))


@register("AG07_count_present", f"""WITH g AS ({F1_SQL})
SELECT variable, year, y, x, n_present FROM (
  SELECT 'T2D' AS variable, CAST(year(time) AS INTEGER) AS year, y, x, count(T2D) AS n_present FROM g GROUP BY 2, 3, 4
  UNION ALL
  SELECT 'RAINRATE', CAST(year(time) AS INTEGER), y, x, count(RAINRATE) FROM g GROUP BY 2, 3, 4)""")
def q_ag07(spark, sf_dir):
    return qa.count_present(f1(spark, sf_dir), ["T2D", "RAINRATE"])


@register("AG08_count_steps", f"""WITH {F2_FRAME} SELECT year, n_steps FROM steps""")
def q_ag08(spark, sf_dir):
    return qa.steps_per_year(f2_axis(fx.daily_grid(spark, sf_dir)))


MAXMISS_SQL = f"""WITH {F2_FRAME},
pc AS (SELECT CAST(year(time) AS INTEGER) AS year, y, x, count(qty) AS n_q, count(price) AS n_p FROM g GROUP BY 1, 2, 3),
lg AS (SELECT 'qty' AS variable, year, n_q AS n FROM pc UNION ALL SELECT 'price', year, n_p FROM pc),
py AS (SELECT variable, year, min(n) AS min_n, count(*) AS cells_with_rows FROM lg GROUP BY 1, 2),
fr AS (SELECT year, n_steps, v.variable FROM steps CROSS JOIN (VALUES ('qty'), ('price')) v(variable)),
mm AS (SELECT fr.variable, fr.year,
        n_steps - CASE WHEN coalesce(cells_with_rows, 0) < n_cells THEN 0 ELSE min_n END AS max_missing
       FROM fr LEFT JOIN py USING (variable, year) CROSS JOIN nc)
SELECT * FROM mm WHERE max_missing > 0"""


def maxmiss(spark, sf_dir):
    g = f2_grid(spark, sf_dir)
    return qa.max_missing(g, f2_axis(g), n_cells(g), ["qty", "price"])


@register("AG09_max_missing", MAXMISS_SQL)
def q_ag09(spark, sf_dir):
    return maxmiss(spark, sf_dir)


@register("PF14_where_positive", f"""WITH {F1_FRAME},
cells AS (SELECT DISTINCT y, x FROM g),
dense AS (SELECT s.year, s.n_steps, c.y, c.x, v.variable FROM steps s, cells c, (VALUES ('T2D'), ('RAINRATE')) v(variable)),
pc AS (SELECT CAST(year(time) AS INTEGER) AS year, y, x, count(T2D) AS n_t, count(RAINRATE) AS n_r FROM g GROUP BY 1, 2, 3)
SELECT variable, year, y, x, n_steps - coalesce(CASE variable WHEN 'T2D' THEN n_t ELSE n_r END, 0) AS n_missing
FROM dense LEFT JOIN pc USING (year, y, x)
WHERE n_steps - coalesce(CASE variable WHEN 'T2D' THEN n_t ELSE n_r END, 0) > 0""")
def q_pf14(spark, sf_dir):
    g = materialise(f1(spark, sf_dir), "f1")
    cells = g.select("y", "x").distinct()
    per_cell = qa.missing_per_cell(g, f1_axis(g), cells, ["T2D", "RAINRATE"])
    return qa.where_positive(per_cell, "n_missing")


@register("PF13_strip_crs", f"""SELECT time, y, x, T2D, RAINRATE FROM ({F1_SQL})""")
def q_pf13(spark, sf_dir):
    g = f1(spark, sf_dir).withColumn("crs", F.lit(1))
    return g.select("time", "y", "x", *qa.data_variables(g))


@register("SR20_qa_report", f"""SELECT variable AS "Variable", CAST(year AS VARCHAR) AS "Year",
  CAST(max_missing AS VARCHAR) AS "Max missing" FROM ({MAXMISS_SQL})""")
def q_sr20(spark, sf_dir):
    return qa.qa_report(maxmiss(spark, sf_dir))


@register("JB08_check_min_max", f"""WITH y AS ({YEARLY_SQL})
SELECT variable, year, printf('%.4f', min_value) AS min_txt, printf('%.4f', max_value) AS max_txt FROM y""")
def q_jb08(spark, sf_dir):
    from .checks import check_min_max
    g = f2_grid(spark, sf_dir)
    return check_min_max(g, f2_axis(g), n_cells(g), ["qty", "price"])


@register("JB09_check_missing", f"""WITH {F1_FRAME},
pc AS (SELECT CAST(year(time) AS INTEGER) AS year, y, x, count(T2D) AS n_t, count(RAINRATE) AS n_r FROM g GROUP BY 1, 2, 3),
lg AS (SELECT 'T2D' AS variable, year, n_t AS n FROM pc UNION ALL SELECT 'RAINRATE', year, n_r FROM pc),
py AS (SELECT variable, year, min(n) AS min_n, count(*) AS cells_with_rows FROM lg GROUP BY 1, 2),
fr AS (SELECT year, n_steps, v.variable FROM steps CROSS JOIN (VALUES ('T2D'), ('RAINRATE')) v(variable)),
mm AS (SELECT fr.variable, fr.year,
        n_steps - CASE WHEN coalesce(cells_with_rows, 0) < n_cells THEN 0 ELSE min_n END AS max_missing
       FROM fr LEFT JOIN py USING (variable, year) CROSS JOIN nc)
SELECT variable AS "Variable", CAST(year AS VARCHAR) AS "Year", CAST(max_missing AS VARCHAR) AS "Max missing"
FROM mm WHERE max_missing > 0""")
def q_jb09(spark, sf_dir):
    from .checks import check_missing
    g = materialise(f1(spark, sf_dir), "f1")
    return check_missing(g, f1_axis(g), n_cells(g), None)


# --- the same checks on a store that keeps summaries ----------------------------
# What the store holds after its writes: F2; then, up to day 200 and in the western half,
# twice the quantity; then no price in column 5 of the last 100 days, unsummarised.
STORE_G_SQL = f"""f2 AS ({F2_SQL}), ends AS (SELECT min(time) AS first, max(time) AS last FROM f2),
g AS (SELECT time, y, x, CASE WHEN time < first + INTERVAL 200 DAY AND x < 32 THEN 2 * qty ELSE qty END AS qty,
        CASE WHEN time > last - INTERVAL 100 DAY AND x = 5 THEN NULL ELSE price END AS price FROM f2, ends)"""


def summarised_store(spark, sf_dir):
    g = f2_grid(spark, sf_dir)
    ends = g.agg(F.min("time").alias("first"), F.max("time").alias("last")).first()   # two scalars
    store = GridStore.create(spark, scratch_path(spark, "summarised"), fx.F2_TILE_SPEC, ends["first"], ends["last"], ["qty", "price"],
                             shape=(7, 64), summaries=True)
    store.write_region(g, stage=False)
    store.write_region(g.where((F.col("time") < ta.add_interval(ta.ntz(ends["first"]), days=200)) & (F.col("x") < 32))
                       .select("time", "y", "x", (2 * F.col("qty")).alias("qty")))
    late = g.where((F.col("time") > ta.add_interval(ta.ntz(ends["last"]), days=-100)) & (F.col("x") == 5))
    store.write_region(late.select("time", "y", "x", F.lit(None).cast("double").alias("price")), summarise=False)
    return store


@register("AG05_yearly_range_of_summaries", YEARLY_SQL.replace(f"g AS ({F2_SQL})", STORE_G_SQL))
def q_ag05_store(spark, sf_dir):
    store = summarised_store(spark, sf_dir)
    return checks.yearly_range_store(store, n_cells=store.read().select("y", "x").distinct().count())


@register("AG07_count_present_of_summaries", f"""WITH {F2_FRAME.replace(f"g AS ({F2_SQL})", STORE_G_SQL)}
SELECT variable, year, y, x, n_present FROM (
  SELECT 'qty' AS variable, CAST(year(time) AS INTEGER) AS year, y, x, count(qty) AS n_present FROM g GROUP BY 2, 3, 4
  UNION ALL SELECT 'price', CAST(year(time) AS INTEGER), y, x, count(price) FROM g GROUP BY 2, 3, 4)""")
def q_ag07_store(spark, sf_dir):
    return checks.count_present_store(summarised_store(spark, sf_dir))


@register("JB09_check_missing_store", f"""SELECT variable AS "Variable", CAST(year AS VARCHAR) AS "Year",
  CAST(max_missing AS VARCHAR) AS "Max missing" FROM ({MAXMISS_SQL.replace(f"g AS ({F2_SQL})", STORE_G_SQL).replace("SELECT count(*) AS n_cells FROM (SELECT DISTINCT y, x FROM g)", "SELECT 448 AS n_cells")})""")
def q_jb09_store(spark, sf_dir):
    return checks.check_missing_store(summarised_store(spark, sf_dir))


@register("AG08_incomplete_steps", f"""WITH {F2_FRAME.replace(f"g AS ({F2_SQL})", STORE_G_SQL)},
have AS (SELECT time, count(qty) AS n_q, count(price) AS n_p FROM g GROUP BY 1)
SELECT v.variable, ax.time FROM ax CROSS JOIN (VALUES ('qty'), ('price')) v(variable) LEFT JOIN have USING (time)
WHERE coalesce(CASE v.variable WHEN 'qty' THEN n_q ELSE n_p END, 0) < 448""")
def q_ag08_incomplete(spark, sf_dir):
    return incomplete_steps(summarised_store(spark, sf_dir))
