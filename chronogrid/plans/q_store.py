"""Registered queries: grid store, region writes, axis, layout and jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import ChunkPlan, GridSpec, parse_base_date
from ..functions import timeaxis as ta
from ..operators import grid as gops
from ..operators import layout
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import hourly_files
from ..sources.gridstore import GridStore, catalog_frame
from . import daily as daily_jobs
from . import hourly as hourly_jobs
from .registry import F1_BASE, F1_SQL, daily_sql, f1, register

SPEC = fx.F1_SPEC                        # hourly, base 2024-01-01 00h, chunk 144 h, 2 x 2 tiles
END = fx.F1_END
N_STEPS = int((parse_base_date(END) - SPEC.base).total_seconds()) // SPEC.step_seconds + 1
DAILY_PLAN = ChunkPlan(6, 2, 2)          # 6-day daily chunks on the same base
TILE_SPEC = GridSpec(SPEC.base_date, "hour", ChunkPlan(144, 1, 1))


def hourly_store(spark, sf_dir, name="hourly", load=True):
    g = f1(spark, sf_dir)
    store = GridStore.create(spark, scratch_path(spark, name), SPEC, SPEC.base_date, END, ["T2D", "RAINRATE"])
    if load:
        store.write_region(g)
    return store


def chunk_sql(t="time", secs=144 * 3600):
    return f"CAST(floor(date_diff('second', {F1_BASE}, {t}) / {secs}) AS INTEGER)"


AXIS_SQL = f"""SELECT CAST(row_number() OVER (ORDER BY time) - 1 AS INTEGER) AS time_idx, time,
  {chunk_sql()} AS time_chunk
FROM (SELECT unnest(generate_series({F1_BASE}, TIMESTAMP '{END}', INTERVAL 1 HOUR)) AS time)"""


@register("SR05_grid_scan", f"SELECT time, y, x, T2D, RAINRATE FROM ({F1_SQL})")
def q_sr05(spark, sf_dir):
    return hourly_store(spark, sf_dir).read()


@register("SR15_create_grid_hourly", AXIS_SQL)
def q_sr15(spark, sf_dir):
    store = hourly_jobs.create_hourly(spark, scratch_path(spark, "create"), f1(spark, sf_dir).where(
        ta.chunk_index("time", SPEC) == 0), SPEC, END)
    assert store.read().isEmpty()
    return store.axis()


def loaded_store(spark, sf_dir, name):
    """Hourly store over the times of the data, with the variables that have values."""
    g = f1(spark, sf_dir)
    seen = g.agg(F.min("time").alias("first"), F.max("time").alias("last"),
                 F.count("T2D").alias("T2D"), F.count("RAINRATE").alias("RAINRATE")).collect()[0]   # four scalars
    if seen["first"] is None:
        raise ValueError("no hourly rows to create a store from")
    variables = [v for v in ("T2D", "RAINRATE") if seen[v]]
    store = GridStore.create(spark, scratch_path(spark, name), SPEC, seen["first"], seen["last"], variables)
    store.write_region(g.select("time", "y", "x", *variables))
    return store


DAILY_AXIS_SQL = """SELECT unnest(generate_series((SELECT min(date_trunc('hour', ts)) FROM events),
  (SELECT max(date_trunc('hour', ts)) FROM events), INTERVAL 1 DAY)) AS time"""


@register("SR16_create_grid_daily", f"""SELECT CAST(row_number() OVER (ORDER BY time) - 1 AS INTEGER) AS time_idx, time,
  {chunk_sql(secs=6 * 86400)} AS time_chunk
FROM ({DAILY_AXIS_SQL})""")
def q_sr16(spark, sf_dir):
    h = loaded_store(spark, sf_dir, "loaded")
    d = daily_jobs.create_daily(spark, scratch_path(spark, "daily"), h, DAILY_PLAN)
    return d.axis()


@register("SR17_region_write", f"SELECT time, y, x, T2D, RAINRATE FROM ({F1_SQL}) WHERE {chunk_sql()} % 5 IN (1, 2, 4)")
def q_sr17(spark, sf_dir):
    """A variable at a time, an hour in two writes, a chunk in two halves, a
    re-run: the store must hold exactly the rows of chunks 1, 2 and 4 of every five."""
    g = f1(spark, sf_dir).withColumn("c", ta.chunk_index("time", SPEC)).where("c % 5 IN (1, 2, 4)").drop("c")
    store = hourly_store(spark, sf_dir, load=False)
    store.write_region(g.select("time", "y", "x", "T2D"))
    store.write_region(g.where("x = 0").select("time", "y", "x", "RAINRATE"))    # half the cells of every hour
    store.write_region(g.where("x = 1").select("time", "y", "x", "RAINRATE"))
    first_half = ta.steps_since("time", SPEC.base_date, 3600) % 144 < 72
    store.write_region(g.where(first_half))                                       # a re-run of half of each chunk
    return store.read()


@register("SR18_constants_append", f"""SELECT DISTINCT y, x, 40.0 + 0.25 * y AS lat, -100.0 + 0.25 * x AS lon FROM ({F1_SQL})""")
def q_sr18(spark, sf_dir):
    store = hourly_store(spark, sf_dir, load=False)
    cells = f1(spark, sf_dir).select("y", "x").distinct()
    lat = cells.select("y", "x", (F.lit(40.0) + F.lit(0.25) * F.col("y")).alias("lat"))
    lon = cells.select("y", "x", (F.lit(-100.0) + F.lit(0.25) * F.col("x")).alias("lon"))
    store.write_constants(lat, catalog_frame(spark, [("lat", ["y", "x"], {"units": "degrees_north"}, {})]))
    store.write_constants(lon.where("x = 0"), catalog_frame(spark, [("lon", ["y", "x"], {"units": "degrees_east"}, {})]))
    store.write_constants(lon.where("x = 1"))                # other cells and variables stay
    return store.cells()


@register("JN02_locate_time", f"""SELECT time, y, x, CAST(date_diff('hour', {F1_BASE}, time) AS INTEGER) AS time_idx FROM ({F1_SQL})""")
def q_jn02(spark, sf_dir):
    axis = gops.make_axis(spark, SPEC.base_date, END, SPEC)
    return gops.locate_time(f1(spark, sf_dir), axis, N_STEPS).select("time", "y", "x", "time_idx")


@register("JN05_axis_fill", f"""WITH ax AS ({AXIS_SQL}), c AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(y, x))
SELECT ax.time_idx, ax.time, CAST(c.y AS INTEGER) AS y, CAST(c.x AS INTEGER) AS x, g.T2D, g.RAINRATE
FROM ax CROSS JOIN c LEFT JOIN ({F1_SQL}) g ON g.time = ax.time AND g.y = c.y AND g.x = c.x""")
def q_jn05(spark, sf_dir):
    axis = gops.make_axis(spark, SPEC.base_date, END, SPEC)
    return gops.dense_view(f1(spark, sf_dir), axis.select("time_idx", "time"), *fx.F1_SHAPE)


@register("LY01_rechunk", f"""SELECT time, y, x, T2D, RAINRATE, {chunk_sql()} AS time_chunk, y AS y_chunk, x AS x_chunk FROM ({F1_SQL})""")
def q_ly01(spark, sf_dir):
    return layout.rechunk(f1(spark, sf_dir), TILE_SPEC)


@register("LY03_tile_pack", f"""SELECT {chunk_sql()} AS time_chunk, y AS y_chunk, x AS x_chunk,
  string_agg(CAST(date_diff('hour', {F1_BASE}, time) % 144 AS VARCHAR) || ':' || printf('%.4f', T2D), ',' ORDER BY date_diff('hour', {F1_BASE}, time)) AS packed
FROM ({F1_SQL}) GROUP BY 1, 2, 3""")
def q_ly03(spark, sf_dir):
    t = layout.tile_pack(f1(spark, sf_dir), TILE_SPEC, SPEC.base_date, "T2D")
    txt = F.transform("values", lambda s: F.concat(s["pos"].cast("string"), F.lit(":"),
                                                    F.format_string("%.4f", s["v"])))
    return t.select("time_chunk", "y_chunk", "x_chunk", F.array_join(txt, ",").alias("packed"))


@register("LY04_chunk_summary", f"""WITH ax AS ({AXIS_SQL}),
a AS (SELECT time_chunk, min(time) AS start_time, max(time) AS end_time, min(time_idx) AS first_idx,
             max(time_idx) AS last_idx, count(*) AS n_steps FROM ax GROUP BY 1),
r AS (SELECT {chunk_sql()} AS time_chunk, count(*) AS n_rows FROM ({F1_SQL}) GROUP BY 1)
SELECT a.*, coalesce(r.n_rows, 0) AS n_rows, coalesce(r.n_rows, 0) = n_steps * 4 AS complete
FROM a LEFT JOIN r USING (time_chunk)""")
def q_ly04(spark, sf_dir):
    store = hourly_store(spark, sf_dir)
    return layout.chunk_summary(store.axis(), store.read(with_chunks=True), 4)


@register("SC18_clamp_chunk", f"""WITH g AS ({F1_SQL}),
d AS (SELECT 'T2D' AS varname, 'time' AS dim, count(DISTINCT time) AS length FROM g
      UNION ALL SELECT 'T2D', 'y', count(DISTINCT y) FROM g UNION ALL SELECT 'T2D', 'x', count(DISTINCT x) FROM g
      UNION ALL SELECT 'lat', 'y', count(DISTINCT y) FROM g UNION ALL SELECT 'lat', 'x', count(DISTINCT x) FROM g
      UNION ALL SELECT 'time', 'time', count(DISTINCT time) FROM g
      UNION ALL SELECT 'T2D', 'lev', count(DISTINCT y) * 3 FROM g)
SELECT varname, dim, length, CAST(coalesce(least(CASE dim WHEN 'time' THEN 144 WHEN 'y' THEN 175 WHEN 'x' THEN 175 END, length), length) AS BIGINT) AS chunk FROM d""")
def q_sc18(spark, sf_dir):
    g = f1(spark, sf_dir)
    lens = g.agg(F.countDistinct("time").alias("time"), F.countDistinct("y").alias("y"),
                 F.countDistinct("x").alias("x"))
    dims = lens.select(F.explode(F.array(
        *[F.struct(F.lit(v).alias("varname"), F.lit(d).alias("dim"), F.col(c).alias("length"))
          for v, d, c in [("T2D", "time", "time"), ("T2D", "y", "y"), ("T2D", "x", "x"), ("lat", "y", "y"),
                          ("lat", "x", "x"), ("time", "time", "time")]],
        F.struct(F.lit("T2D").alias("varname"), F.lit("lev").alias("dim"), (F.col("y") * 3).alias("length")))
    ).alias("d")).select("d.*")
    return layout.clamp_chunks(dims, ChunkPlan(144, 175, 175))


@register("SR21_chunk_log", f"""WITH d AS ({daily_sql(F1_SQL)})
SELECT CAST(floor(date_diff('day', {F1_BASE}, time) / 6) AS INTEGER) AS time_chunk, min(time) AS first_time, max(time) AS last_time,
  CAST(min(date_diff('day', {F1_BASE}, time)) AS INTEGER) AS first_idx, CAST(max(date_diff('day', {F1_BASE}, time)) AS INTEGER) AS last_idx
FROM d GROUP BY 1""")
def q_sr21(spark, sf_dir):
    h = hourly_store(spark, sf_dir)
    d = daily_jobs.create_daily(spark, scratch_path(spark, "daily"), h, DAILY_PLAN)
    daily_chunk = ta.chunk_index("time", d.spec)
    seen = h.read([]).agg(F.min(daily_chunk).alias("lo"), F.max(daily_chunk).alias("hi")).collect()[0]   # two scalars
    return daily_jobs.process_daily(h, d, seen["lo"], seen["hi"])


def chunks_of(g):
    """First and last hourly chunk with rows."""
    seen = g.agg(F.min(ta.chunk_index("time", SPEC)).alias("lo"), F.max(ta.chunk_index("time", SPEC)).alias("hi")).collect()[0]
    return seen["lo"], seen["hi"]


HOURLY_TEMPLATE = "{wrf_dir}/wy_dir={wy_dir}/fname={fdate:%Y%m%d%H%M}.LDASIN_DOMAIN1"


def hourly_files_of_f1(spark, sf_dir):
    """F1 written as one dataset per hour (with two constants) under a scratch root."""
    root = scratch_path(spark, "hourly-files")
    g = f1(spark, sf_dir).withColumns({"lat": F.lit(40.0) + F.col("y"), "lon": F.lit(-100.0) + F.col("x"),
                                       "wy_dir": ta.water_year_dir("time"),
                                       "fname": F.date_format("time", "yyyyMMddHHmm'.LDASIN_DOMAIN1'")})
    hourly_files.write_hourly_files(g, root)
    return root


def f1_files(spark):
    """Description of the hourly files of F1: a variable list, metadata, attributes to
    drop, two constants and the scalar that names the projection."""
    tyx, yx = ["time", "y", "x"], ["y", "x"]
    file_catalog = catalog_frame(spark, [
        ("T2D", tyx, {"long_name": "t2", "proj4": "+proj=lcc"}, {}), ("RAINRATE", tyx, {"units": "mm s-1"}, {}),
        ("lat", yx, {"units": "degrees_north"}, {}), ("lon", yx, {"units": "degrees_east"}, {}),
        ("crs", [], {"grid_mapping_name": "lambert_conformal_conic"}, {}), ("UNLISTED", tyx, {}, {})])
    listed = spark.createDataFrame([(v,) for v in ("T2D", "RAINRATE", "lat", "lon", "crs")], "variable string")
    meta = spark.createDataFrame([("T2D", "Temperature at 2 m", "air_temperature", "K", "x y")],
                                 "varname string, long_name string, standard_name string, units string, coordinates string")
    return hourly_jobs.describe_files(file_catalog, listed, metadata=meta)


@register("JB01_create_hourly", f"""WITH ax AS (SELECT CAST(row_number() OVER (ORDER BY time) - 1 AS INTEGER) AS time_idx, time, {chunk_sql()} AS time_chunk
  FROM (SELECT unnest(generate_series((SELECT min(date_trunc('hour', ts)) FROM events), TIMESTAMP '{END}', INTERVAL 1 HOUR)) AS time))
SELECT time_chunk, min(time) AS start_time, max(time) AS end_time, count(*) AS n_steps, CAST(0 AS BIGINT) AS n_rows FROM ax GROUP BY 1""")
def q_jb01(spark, sf_dir):
    root = hourly_files_of_f1(spark, sf_dir)
    store = hourly_jobs.create_hourly_from_files(
        spark, scratch_path(spark, "create"), SPEC, chunks_of(f1(spark, sf_dir))[0], END, root, HOURLY_TEMPLATE,
        f1_files(spark), listing=hourly_files.list_files(spark, root))
    assert store.cells().columns == ["y", "x", "lat", "lon"] and store.variables == ["RAINRATE", "T2D"]
    assert {r.varname for r in store.catalog().collect()} == {"T2D", "RAINRATE", "lat", "lon", "crs"}
    s = layout.chunk_summary(store.axis(), store.read(with_chunks=True), 4)
    return s.select("time_chunk", "start_time", "end_time", "n_steps", "n_rows")


@register("JB02_process_hourly", f"SELECT time, y, x, T2D, RAINRATE FROM ({F1_SQL})")
def q_jb02(spark, sf_dir):
    """Hourly files of F1 -> verified manifest of the data's chunks -> scan ->
    metadata on the catalog -> rechunked region write -> read back."""
    root = hourly_files_of_f1(spark, sf_dir)
    store = hourly_store(spark, sf_dir, load=False)
    hourly_jobs.process_hourly_files(spark, store, *chunks_of(f1(spark, sf_dir)), root, HOURLY_TEMPLATE, f1_files(spark),
                                     listing=hourly_files.list_files(spark, root))
    c = {r["varname"]: r for r in store.catalog().collect()}
    assert c["T2D"]["attrs"]["units"] == "K" and c["T2D"]["encoding"]["coordinates"] == "x y"
    return store.read()


@register("JB03_create_daily", f"""WITH v AS (SELECT count(value) > 0 AS present FROM events), ax AS (SELECT min(time) AS first_time, max(time) AS last_time, count(*) AS n_steps FROM ({DAILY_AXIS_SQL}))
SELECT varname, attr, t.value, first_time, last_time, n_steps FROM (VALUES ('RAIN', 'coordinates', 'x y'), ('RAIN', 'grid_mapping', 'crs'),
  ('RAIN', 'integration_length', '24-hour accumulation'), ('RAIN', 'long_name', 'Daily accumulated precipitation'),
  ('RAIN', 'standard_name', 'precipitation'), ('RAIN', 'units', 'mm'),
  ('T2MAX', 'coordinates', 'x y'), ('T2MAX', 'grid_mapping', 'crs'), ('T2MAX', 'long_name', 'Daily maximum temperature at 2 meters'), ('T2MAX', 'units', 'K'),
  ('T2MIN', 'coordinates', 'x y'), ('T2MIN', 'grid_mapping', 'crs'), ('T2MIN', 'long_name', 'Daily minimum temperature at 2 meters'), ('T2MIN', 'units', 'K')
) t(varname, attr, value) CROSS JOIN v CROSS JOIN ax WHERE present""")
def q_jb03(spark, sf_dir):
    h = loaded_store(spark, sf_dir, "loaded")
    d = daily_jobs.create_daily(spark, scratch_path(spark, "daily"), h, DAILY_PLAN)
    extent = d.axis().agg(F.min("time").alias("first_time"), F.max("time").alias("last_time"), F.count("*").alias("n_steps"))
    return d.catalog().select("varname", F.explode("attrs").alias("attr", "value")).join(F.broadcast(extent))   # one row


@register("JB04_process_daily", f"SELECT time, y, x, T2MAX, T2MIN, RAIN FROM ({daily_sql(F1_SQL)})")
def q_jb04(spark, sf_dir):
    h = hourly_store(spark, sf_dir)
    d = daily_jobs.create_daily(spark, scratch_path(spark, "daily"), h, DAILY_PLAN)
    daily_jobs.process_daily(h, d)
    return d.read()


@register("JB12_chunk_backfill", f"SELECT time, y, x, T2MAX, T2MIN, RAIN FROM ({daily_sql(F1_SQL)}) WHERE floor(date_diff('day', {F1_BASE}, time) / 6) BETWEEN 1 AND 3")
def q_jb12(spark, sf_dir):
    h = hourly_store(spark, sf_dir)
    d = daily_jobs.create_daily(spark, scratch_path(spark, "daily"), h, DAILY_PLAN)
    daily_jobs.process_daily(h, d, 1, 3)
    return d.read()


@register("JB05_extend_time", f"""SELECT CAST(row_number() OVER (ORDER BY time) - 1 AS INTEGER) AS time_idx, time, {chunk_sql()} AS time_chunk
FROM (SELECT unnest(generate_series((SELECT min(date_trunc('hour', ts)) FROM events), TIMESTAMP '2024-02-05 23:00:00', INTERVAL 1 HOUR)) AS time)""")
def q_jb05(spark, sf_dir):
    g = f1(spark, sf_dir)
    first = g.agg(F.min("time")).collect()[0][0]
    store = GridStore.create(spark, scratch_path(spark, "ext"), SPEC, first, END, ["T2D", "RAINRATE"])
    store.write_region(g)
    assert store.extend_time("2024-02-05 23:00:00")
    assert not store.extend_time("2024-02-05 23:00:00")          # already there: no-op
    return store.axis()


@register("JB07_info", f"""WITH e AS (SELECT min(date_trunc('hour', ts)) AS first_time, TIMESTAMP '{END}' AS last_time FROM events),
c AS (SELECT *, {chunk_sql('first_time')} AS fc, {chunk_sql('last_time')} AS lc FROM e)
SELECT '2024-01-01 00:00:00' AS base_date, first_time, fc AS first_chunk, {F1_BASE} + to_hours(fc * 144) AS first_chunk_start,
  {F1_BASE} + to_hours(fc * 144 + 143) AS first_chunk_end, last_time, lc AS last_chunk,
  {F1_BASE} + to_hours(lc * 144) AS last_chunk_start, {F1_BASE} + to_hours(lc * 144 + 143) AS last_chunk_end,
  last_time < {F1_BASE} + to_hours(lc * 144 + 143) AS partial_last_chunk FROM c""")
def q_jb07(spark, sf_dir):
    g = f1(spark, sf_dir)
    first = g.agg(F.min("time")).collect()[0][0]
    store = GridStore.create(spark, scratch_path(spark, "info"), SPEC, first, END, ["T2D", "RAINRATE"])
    return store.info()


@register("PF01_select_vars", f"SELECT time, y, x, T2D FROM ({F1_SQL})")
def q_pf01(spark, sf_dir):
    return gops.select_vars(hourly_store(spark, sf_dir).read(), ["T2D"])


@register("PF02_drop_vars", f"SELECT time, y, x, RAINRATE FROM ({F1_SQL})")
def q_pf02(spark, sf_dir):
    return gops.drop_vars(f1(spark, sf_dir), ["T2D", "not_there"])


@register("PF03_slice_by_index", f"SELECT time, y, x, T2D, RAINRATE, CAST(date_diff('hour', {F1_BASE}, time) AS INTEGER) AS time_idx FROM ({F1_SQL}) WHERE date_diff('hour', {F1_BASE}, time) >= 100 AND date_diff('hour', {F1_BASE}, time) < 400")
def q_pf03(spark, sf_dir):
    store = hourly_store(spark, sf_dir)
    return store.locate(store.read(steps=(100, 400)))


@register("PF04_slice_by_label", f"SELECT time, y, x, T2D, RAINRATE FROM ({F1_SQL}) WHERE time >= TIMESTAMP '2024-01-07 00:00:00' AND time < TIMESTAMP '2024-01-20 00:00:00'")
def q_pf04(spark, sf_dir):
    return hourly_store(spark, sf_dir).read(start="2024-01-07", end="2024-01-19")


@register("ST01_concat_time", f"SELECT time, y, x, T2D, RAINRATE FROM ({F1_SQL})")
def q_st01(spark, sf_dir):
    g = f1(spark, sf_dir)
    c = ta.chunk_index("time", SPEC)
    return gops.concat_time([g.where(c == i) for i in range(5)] + [g.where((c < 0) | (c > 4))])


@register("SL04_concat_order", f"SELECT time, y, x, T2D, RAINRATE, CAST(date_diff('hour', {F1_BASE}, time) AS INTEGER) AS time_idx FROM ({F1_SQL})")
def q_sl04(spark, sf_dir):
    """Steps follow the axis order: an explicit ``time_idx`` replaces list order."""
    g = gops.locate_regular(f1(spark, sf_dir), SPEC.base_date, N_STEPS, SPEC.step_seconds)
    return g.sortWithinPartitions("time_idx", "y", "x")


@register("AG13_time_extent", f"SELECT min(time) AS first_time, max(time) AS last_time FROM ({F1_SQL})")
def q_ag13(spark, sf_dir):
    return gops.time_extent(f1(spark, sf_dir))


@register("JB02_process_hourly_streaming", f"SELECT time, y, x, T2MAX, T2MIN, RAIN FROM ({daily_sql(F1_SQL)})")
def q_jb02_stream(spark, sf_dir):
    """JB02 + JB04 run incrementally: hourly files of F1 are streamed into the
    hourly store (one micro-batch per group of files) and each batch updates
    the daily chunks it touched."""
    from ..streaming.hourly_ingest import start_hourly_ingest
    src = scratch_path(spark, "hourly-src")
    g = f1(spark, sf_dir).withColumns({"wy_dir": ta.water_year_dir("time"),
                                       "fname": F.date_format("time", "yyyyMMddHH")})
    hourly_files.write_hourly_files(g, src)
    h = hourly_store(spark, sf_dir, load=False)
    d = daily_jobs.create_daily(spark, scratch_path(spark, "daily"), h, DAILY_PLAN)
    q = start_hourly_ingest(spark, src, hourly_files.hourly_schema(["T2D", "RAINRATE"]), h, d,
                            max_files_per_trigger=360)
    q.awaitTermination()
    return d.read()


@register("JB12_restarted_backfill", f"""SELECT time, y, x, T2MAX, T2MIN, RAIN FROM ({daily_sql(F1_SQL)})""")
def q_jb12_restarted(spark, sf_dir):
    """All daily chunks of the data, in runs that end early; then hours that came late to some chunks.

    The hours of odd days are written after the first pass: only the chunks whose
    input changed are processed again, and the last run finds nothing to do."""
    from . import backfill
    h = hourly_store(spark, sf_dir, load=False)
    g = f1(spark, sf_dir)
    odd = F.dayofmonth("time") % 2 == 1
    h.write_region(g.where(~odd))
    d = daily_jobs.create_daily(spark, scratch_path(spark, "daily"), h, DAILY_PLAN)
    day = ta.chunk_index("time", d.spec)
    seen = g.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).collect()[0]             # two scalars
    first = backfill.backfill_daily(h, d, seen["lo"], seen["hi"], at_a_time=2, most_runs=1)
    rest = backfill.backfill_daily(h, d, seen["lo"], seen["hi"], at_a_time=2)
    assert not set(first) & set(rest)
    h.write_region(g.where(odd))
    backfill.backfill_daily(h, d, seen["lo"], seen["hi"])
    assert not backfill.backfill_daily(h, d, seen["lo"], seen["hi"])
    return d.read()
