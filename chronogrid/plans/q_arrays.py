"""Registered queries: chunked array export and import."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grid as gops
from ..session import prepare_workers, scratch_path
from ..sources import arraystore, blocks, datasource
from ..sources import fixtures as fx
from .registry import F1_BASE, F1_SQL, F2_SQL, f1, register

SPEC = fx.F1_SPEC
CHUNKS = (144, 2, 1)
# Steps of the array: whole days up to that of the last event.
STEPS_SQL = f"(SELECT (max(date_diff('hour', {F1_BASE}, date_trunc('hour', ts))) // 24 + 1) * 24 FROM events)"


def _export(spark, sf_dir, path):
    g = gops.with_time_index(f1(spark, sf_dir), SPEC.base_date, 3600)
    last = g.agg(F.max("time_idx")).first()[0]                # one scalar
    return arraystore.export_array_store(g, path, ["T2D", "RAINRATE"], ((last // 24 + 1) * 24, *fx.F1_SHAPE), CHUNKS)


@register("SR09_array_store_export", f"""WITH g AS (SELECT CAST(date_diff('hour', {F1_BASE}, time) AS INTEGER) AS t, * FROM ({F1_SQL})),
k AS (SELECT CAST(CAST(floor(t / 144) AS BIGINT) AS VARCHAR) || '.' || CAST(CAST(floor(y / 2) AS BIGINT) AS VARCHAR) || '.' || CAST(x AS VARCHAR) AS key, T2D, RAINRATE FROM g)
SELECT 'T2D' AS variable, key, count(T2D) AS n_values FROM k GROUP BY key
UNION ALL SELECT 'RAINRATE', key, count(RAINRATE) FROM k GROUP BY key""")
def q_sr09(spark, sf_dir):
    m = _export(spark, sf_dir, scratch_path(spark, "arrays"))
    return m.select("variable", "key", "n_values")


@register("SR08_array_store_import", f"""WITH ax AS (SELECT CAST(t AS INTEGER) AS time_idx, {F1_BASE} + to_hours(t) AS time FROM (SELECT unnest(range({STEPS_SQL})) AS t)),
c AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(y, x))
SELECT ax.time_idx, CAST(c.y AS INTEGER) AS y, CAST(c.x AS INTEGER) AS x, g.T2D, g.RAINRATE
FROM ax CROSS JOIN c LEFT JOIN ({F1_SQL}) g ON g.time = ax.time AND g.y = c.y AND g.x = c.x""")
def q_sr08(spark, sf_dir):
    path = scratch_path(spark, "arrays")
    _export(spark, sf_dir, path).write.format("noop").mode("overwrite").save()
    return arraystore.import_array_store(spark, path, ["T2D", "RAINRATE"])


# --- F2 (rows grow with lineitem) as an array of days x 8 x 64 -------------------
F2_BASE = "TIMESTAMP '1992-01-01 00:00:00'"
F2_INDEX_SQL = f"SELECT CAST(date_diff('day', {F2_BASE}, time) AS INTEGER) AS time_idx, y, x, qty, price FROM ({F2_SQL})"


def f2_array(spark, sf_dir, name, chunks):
    """F2 written through the data source; the array reaches to the last day of the data."""
    g = fx.daily_grid(spark, sf_dir).withColumn("time_idx", F.datediff("time", F.lit("1992-01-01").cast("date"))).drop("time")
    days = (g.agg(F.max("time_idx")).first()[0] or 0) + 1     # one scalar
    path = scratch_path(spark, name)
    datasource.write_array(g.select("time_idx", "y", "x", "qty", "price"), path, (days, *fx.F2_SHAPE), chunks)
    return path


@register("SR08_array_source_read", f"SELECT * FROM ({F2_INDEX_SQL}) WHERE time_idx BETWEEN 1200 AND 1500 AND x >= 40 AND y = 3")
def q_sr08_source(spark, sf_dir):
    """Written and read as ``format("chunkarray")``; only the chunks of the filters are opened."""
    path = f2_array(spark, sf_dir, "source", (400, 4, 16))
    df = datasource.read_array(spark, path, ["qty", "price"], missing=False)
    return df.where("time_idx BETWEEN 1200 AND 1500 AND x >= 40 AND y = 3")


@register("LY01_rechunk_blocks", F2_INDEX_SQL)
def q_ly01_blocks(spark, sf_dir):
    """An array of long thin chunks rechunked to flat wide ones by blocks, then read as rows."""
    prepare_workers(spark)
    path, target = f2_array(spark, sf_dir, "thin", (700, 2, 8)), scratch_path(spark, "flat")
    blocks.rechunk_array_store(spark, path, target, {"time": 90, "y": 5, "x": 100})
    return datasource.read_array(spark, target, ["qty", "price"], missing=False)


@register("LY01_rechunk_manifest", f"""WITH g AS ({F2_INDEX_SQL}),
k AS (SELECT CAST(time_idx // 90 AS VARCHAR) || '.' || CAST(y // 5 AS VARCHAR) || '.0' AS key, qty, price FROM g)
SELECT 'qty' AS variable, key, count(qty) AS n_values FROM k GROUP BY key UNION ALL SELECT 'price', key, count(price) FROM k GROUP BY key""")
def q_ly01_manifest(spark, sf_dir):
    prepare_workers(spark)
    path, target = f2_array(spark, sf_dir, "thin", (700, 2, 8)), scratch_path(spark, "flat")
    return blocks.rechunk_array_store(spark, path, target, {"time": 90, "y": 5, "x": 100}).where("n_values > 0").select("variable", "key", "n_values")
