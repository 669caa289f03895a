"""Faults found by review, each reproduced: lost rows, missing values, day blocks, polygons, array files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from chronogrid.config import ChunkPlan, GridSpec
from chronogrid.operators import daily, quality, regions
from chronogrid.plans import checks
from chronogrid.plans import daily as daily_jobs
from chronogrid.session import scratch_path
from chronogrid.sources import arraystore, hourly_files
from chronogrid.sources.gridstore import GridStore

GRID = "time timestamp_ntz, y int, x int, T2D double, RAINRATE double"
DAY0 = dt.datetime(2024, 1, 1)
NAN = float("nan")


def hours(n, start=DAY0):
    return [start + dt.timedelta(hours=h) for h in range(n)]


def store(spark, end, start=DAY0, chunk=24, variables=("T2D", "RAINRATE"), base="2024-01-01 00:00:00", **more):
    spec = GridSpec(base, "hour", ChunkPlan(chunk, 1, 1))
    return GridStore.create(spark, scratch_path(spark, "t-fault"), spec, start, end, list(variables), **more)


def grid(spark, rows, schema=GRID):
    return spark.createDataFrame(rows, schema)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


# --- region writes ------------------------------------------------------------
def test_writes_merge_by_position_and_variable(spark):
    st = store(spark, "2024-01-02 23:00:00")
    full = [(t, 0, x, float(k), 10.0 + x) for k, t in enumerate(hours(48)) for x in (0, 1)]
    df = grid(spark, full)
    st.write_region(df.select("time", "y", "x", "T2D"))
    st.write_region(df.where("x = 0").select("time", "y", "x", "RAINRATE"))
    st.write_region(df.where("x = 1").select("time", "y", "x", "RAINRATE"))
    assert rows_of(st.read()) == sorted(full)
    # a value that is given as missing is set, others stay; repeated positions count once
    st.write_region(grid(spark, [(DAY0, 0, 0, None, None)] * 2).select("time", "y", "x", "T2D"), stage=False)
    assert rows_of(st.read(start=DAY0, end="2024-01-01 00:00:00")) == [(DAY0, 0, 0, None, 10.0), (DAY0, 0, 1, 0.0, 11.0)]
    # whole chunks are replaced only on demand
    st.write_region(grid(spark, [(DAY0, 0, 0, 1.0, 1.0)]), replace_chunks=True)
    assert st.read(chunks=(0, 0)).count() == 1 and st.read(chunks=(1, 1)).count() == 48


def test_stream_of_an_hour_in_two_files(spark):
    from chronogrid.streaming.hourly_ingest import start_hourly_ingest
    full = [(t, 0, x, float(k + x), 0.5) for k, t in enumerate(hours(24)) for x in (0, 1)]
    src = scratch_path(spark, "t-two-files")
    for x in (0, 1):
        hourly_files.write_hourly_files(grid(spark, full).where(F.col("x") == x).where("hour(time) < 6 OR hour(time) = 23").withColumns(
            {"wy_dir": F.lit(f"x{x}"), "fname": F.date_format("time", "yyyyMMddHH")}), f"{src}/{x}", n_writers=1)
    st = store(spark, "2024-01-01 23:00:00")
    st.write_region(grid(spark, [r for r in full if 6 <= r[0].hour < 23]))
    d = daily_jobs.create_daily(spark, scratch_path(spark, "t-two-days"), st, ChunkPlan(1, 1, 1))
    start_hourly_ingest(spark, f"{src}/*/*/*", hourly_files.hourly_schema(["T2D", "RAINRATE"]), st, d, max_files_per_trigger=7).awaitTermination()
    assert rows_of(st.read()) == sorted(full)
    assert rows_of(d.read(["T2MAX", "T2MIN"])) == [(DAY0, 0, 0, 23.0, 0.0), (DAY0, 0, 1, 24.0, 1.0)]


def test_steps_reach_the_scan(spark):
    st = store(spark, "2024-01-02 23:00:00")
    st.write_region(grid(spark, [(t, 0, 0, 1.0, 1.0) for t in hours(48)]))
    part = st.read(steps=(30, 40))
    assert [r.time_idx for r in st.locate(part).orderBy("time").collect()] == list(range(30, 40))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(time," in plan and "PartitionFilters: [isnotnull(time_chunk" in plan


def test_created_again_a_store_is_empty(spark):
    st = store(spark, "2024-01-01 23:00:00", cells=spark.createDataFrame([(0, 0)], "y int, x int"))
    st.write_region(grid(spark, [(t, 0, 0, 1.0, 1.0) for t in hours(24)]))
    again = GridStore.create(spark, st.path, st.spec, DAY0, "2024-01-01 23:00:00", ["T2D"])
    assert again.read().count() == 0 and not again.has_cells and not GridStore(spark, st.path).has_cells


def test_constants_are_added(spark):
    st = store(spark, "2024-01-01 23:00:00")
    st.write_constants(spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0)], "y int, x int, lat double"))
    st.write_constants(spark.createDataFrame([(0, 1, 5.0, 7.0), (1, 0, 6.0, 8.0)], "y int, x int, lon double, lat double"))
    got = {(r.y, r.x): (r.lat, r.lon) for r in GridStore(spark, st.path).cells().collect()}
    assert got == {(0, 0): (1.0, None), (0, 1): (7.0, 5.0), (1, 0): (8.0, 6.0)}


def test_extend_after_a_lost_run(spark):
    st = store(spark, "2024-01-01 23:00:00")
    before = dict(st.meta)
    assert st.extend_time("2024-01-02 23:00:00")
    st.meta = before                                   # as if the run had died before it saved the length
    st.n_steps = before["n_steps"] = 24
    st._save_meta()
    again = GridStore(spark, st.path)
    assert not again.extend_time("2024-01-02 23:00:00") and GridStore(spark, st.path).n_steps == 48
    again.write_region(grid(spark, [(dt.datetime(2024, 1, 2, 5), 0, 0, 1.0, 1.0)]))


# --- missing values -----------------------------------------------------------
def test_nan_is_missing_in_the_store_and_the_day(spark):
    rows = [(t, 0, 0, NAN if k == 5 else 0.0 + k, 1.0) for k, t in enumerate(hours(24))]
    st = store(spark, "2024-01-01 23:00:00")
    st.write_region(grid(spark, rows))
    assert st.read().where("T2D IS NULL").count() == 1 and st.read().where(F.isnan("T2D")).count() == 0
    d = daily_jobs.create_daily(spark, scratch_path(spark, "t-nan"), st, ChunkPlan(1, 1, 1))
    daily_jobs.process_daily(st, d)
    assert rows_of(d.read()) == [(DAY0, 0, 0, None, None, 24 * 3600.0)]
    src = scratch_path(spark, "t-nan-files")
    grid(spark, rows).write.parquet(src)
    read, _ = hourly_files.load_hourly_files(spark, [src], ["T2D", "RAINRATE"])
    assert read.where("T2D IS NULL").count() == 1


def test_files_are_unpacked_renamed_and_classed(spark):
    from chronogrid.plans import hourly as jobs
    from chronogrid.sources.gridstore import catalog_frame
    root = scratch_path(spark, "t-described")
    raw = [(t, 0, x, -9999.0 if (h, x) == (3, 1) else 100.0 + h, 7.0 + x, 1.0) for h, t in enumerate(hours(24)) for x in (0, 1)]
    df = spark.createDataFrame(raw, "time timestamp_ntz, y int, x int, T2 double, lat double, JUNK double")
    hourly_files.write_hourly_files(df.withColumns({"wy_dir": F.lit("WY2024"), "fname": F.date_format("time", "yyyyMMddHHmm")}), root, n_writers=2)
    cat = catalog_frame(spark, [("T2", ["time", "y", "x"], {"proj4": "p"}, {"scale_factor": "0.5", "add_offset": "10", "_FillValue": "-9999"}),
                                ("lat", ["y", "x"], {}, {}), ("crs", [], {"a": "b"}, {}), ("JUNK", ["time", "y", "x"], {}, {})])
    files = jobs.describe_files(cat, spark.createDataFrame([("T2",), ("lat",), ("crs",)], "variable string"), {"T2": "T2D"})
    assert files.variables == {"T2": "T2D"} and files.constants == {"lat": "lat"}
    template = "{wrf_dir}/wy_dir={wy_dir}/fname={fdate:%Y%m%d%H%M}"
    spec = GridSpec("2024-01-01 00:00:00", "hour", ChunkPlan(24, 1, 1))
    st = jobs.create_hourly_from_files(spark, scratch_path(spark, "t-described-store"), spec, 0, "2024-01-01 23:00:00", root, template, files)
    assert rows_of(st.cells()) == [(0, 0, 7.0), (0, 1, 8.0)] and st.read().count() == 0
    jobs.process_hourly_files(spark, st, 0, 0, root, template, files, listing=hourly_files.list_files(spark, root))
    got = {(r.time.hour, r.x): r.T2D for r in st.read().collect()}
    assert got == {(h, x): None if (h, x) == (3, 1) else 60.0 + 0.5 * h for h in range(24) for x in (0, 1)}
    described = {r.varname: r for r in st.catalog().collect()}
    assert set(described) == {"T2D", "lat", "crs"} and described["T2D"].attrs == {} and described["T2D"].encoding == {}
    with pytest.raises(KeyError):
        jobs.describe_files(cat, rename_vars={"absent": "x"})


def test_an_absent_cell_is_missing_from_a_polygon(spark):
    w = spark.createDataFrame([(1, 0, 0, 0.5), (1, 0, 1, 0.5)], "poly_id long, y int, x int, w double")
    g = grid(spark, [(DAY0, 0, 0, 10.0, 1.0), (DAY0 + dt.timedelta(1), 0, 0, 10.0, 1.0), (DAY0 + dt.timedelta(1), 0, 1, 20.0, None)])
    strict = {r.time: (r.T2D, r.RAINRATE) for r in regions.weighted_mean(regions.join_weights(g, w), ["T2D", "RAINRATE"]).collect()}
    assert strict == {DAY0: (None, None), DAY0 + dt.timedelta(1): (15.0, None)}
    loose = {r.time: r.T2D for r in regions.weighted_mean(regions.join_weights(g, w), ["T2D"], strict=False).collect()}
    assert loose == {DAY0: 10.0, DAY0 + dt.timedelta(1): 15.0}


def test_weights_far_below_one(spark):
    w = spark.createDataFrame([(1, 0, 0, 1e-11), (1, 0, 1, 3e-11)], "poly_id long, y int, x int, w double")
    g = grid(spark, [(DAY0, 0, 0, 10.0, 1.0), (DAY0, 0, 1, 20.0, 1.0)])
    assert regions.weighted_mean(regions.join_weights(g, w), ["T2D"]).first().T2D == pytest.approx(17.5)


def test_a_year_without_rows_stays_in_the_ranges(spark):
    axis = spark.createDataFrame([(dt.datetime(y, 1, 1),) for y in (2000, 2001, 2002)], "time timestamp_ntz")
    g = grid(spark, [(dt.datetime(2000, 1, 1), 0, 0, 1.0, 1.0), (dt.datetime(2002, 1, 1), 0, 0, 3.0, 1.0)])
    yearly = quality.yearly_range(g, axis, 1, ["T2D"])
    assert {(r.year, r.min_value, r.n_values) for r in yearly.collect()} == {(2000, 1.0, 1), (2001, None, 0), (2002, 3.0, 1)}
    assert tuple(quality.overall_range(yearly).first()) == ("T2D", None, None, 1.0, 3.0)


def test_a_cell_never_written_is_missing(spark):
    st = store(spark, "2024-01-01 23:00:00", shape=(1, 2))
    st.write_region(grid(spark, [(t, 0, 0, 1.0, 1.0) for t in hours(24)]))
    report = {tuple(r) for r in checks.check_missing_store(st).collect()}
    assert report == {("T2D", "2024", "24"), ("RAINRATE", "2024", "24")}
    unknown = store(spark, "2024-01-01 23:00:00")
    with pytest.raises(ValueError):
        checks.check_missing_store(unknown)


# --- day blocks ---------------------------------------------------------------
@pytest.mark.parametrize("base,start", [("2024-01-01 00:00:00", dt.datetime(2024, 1, 1, 5)), ("1979-10-01 00:00:00", dt.datetime(2024, 1, 1)),
                                        ("1979-10-01 00:00:00", dt.datetime(2024, 1, 1, 5))])
def test_daily_chunks_are_whole_blocks(spark, base, start):
    times = hours(6 * 24, start)
    st = store(spark, times[-1], start, base=base)
    st.write_region(grid(spark, [(t, 0, 0, float(k % 24), 1.0) for k, t in enumerate(times)]))
    whole = daily_jobs.create_daily(spark, scratch_path(spark, "t-whole"), st, ChunkPlan(2, 1, 1))
    daily_jobs.process_daily(st, whole)
    want = rows_of(whole.read())
    assert len(want) == 6 and all(r[3:] == (23.0, 0.0, 86400.0) for r in want)
    parts = daily_jobs.create_daily(spark, scratch_path(spark, "t-parts"), st, ChunkPlan(2, 1, 1))
    parts.write_region(whole.read())
    chunks = sorted(r[0] for r in parts.axis().select("time_chunk").distinct().collect())
    for c in chunks:                                   # a backfill leaves the neighbours as they are
        log = daily_jobs.process_daily(st, parts, c).collect()
        assert [r.time_chunk for r in log] == [c]
        assert rows_of(parts.read()) == want
    with pytest.raises(ValueError):
        daily_jobs.process_daily(st, parts, chunks[-1] + 2)


def test_daily_extend_off_midnight(spark):
    start = dt.datetime(2024, 1, 1, 5)
    st = store(spark, "2024-01-03 23:00:00", start)
    d = daily_jobs.create_daily(spark, scratch_path(spark, "t-ext5"), st, ChunkPlan(6, 1, 1))
    assert not daily_jobs.extend_daily(st, d)
    st.extend_time("2024-01-05 07:00:00")
    assert daily_jobs.extend_daily(st, d) and not daily_jobs.extend_daily(st, d)
    assert d.axis().agg(F.max("time")).first()[0] == dt.datetime(2024, 1, 5, 5)


# --- polygons -----------------------------------------------------------------
def ring(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


def test_parts_and_holes(spark):
    polys = spark.createDataFrame([(1, ring(0.0, 0.0, 2.0, 1.0), False), (1, ring(2.0, 0.0, 3.0, 1.0), False), (1, ring(0.5, 0.0, 1.0, 1.0), True),
                                   (2, ring(0.0, 0.0, 1.0, 0.5), None), (2, ring(0.0, 0.5, 1.0, 1.0), None)],
                                  "poly_id long, ring array<struct<x: double, y: double>>, hole boolean")
    cells = spark.createDataFrame([(0, x) for x in range(3)], "y int, x int")
    w = regions.weights(polys, regions.overlay(polys, cells, regions.CellGrid()))
    got = {(r.poly_id, r.x): r.w for r in w.collect()}
    assert got == pytest.approx({(1, 0): 0.2, (1, 1): 0.4, (1, 2): 0.4, (2, 0): 1.0})


def test_years_are_written_by_several_tasks(spark):
    from chronogrid.plans import regions as region_jobs
    path = scratch_path(spark, "t-years")
    df = spark.range(200).select(F.col("id").alias("poly_id"), F.lit(DAY0).cast("timestamp_ntz").alias("time"))
    region_jobs.write_yearly(df.withColumn("time", F.add_months("time", -12).cast("timestamp_ntz")), path)
    region_jobs.write_yearly(df, path)
    assert [r.year for r in region_jobs.read_yearly(spark, path).select("year").distinct().collect()] == [2024]


# --- array files --------------------------------------------------------------
def test_only_absent_chunks_are_fill(spark, tmp_path):
    g = spark.createDataFrame([(t, 0, 0, float(t)) for t in range(4)], "time_idx int, y int, x int, v double")
    path = str(tmp_path / "arrays")
    arraystore.export_array_store(g, path, ["v"], (4, 1, 1), (2, 1, 1)).collect()
    os.remove(f"{path}/v/0.0.0")
    assert sorted((r.time_idx, r.v) for r in arraystore.import_array_store(spark, path, ["v"]).collect()) == [(0, None), (1, None), (2, 2.0), (3, 3.0)]
    os.remove(f"{path}/v/1.0.0")
    os.mkdir(f"{path}/v/1.0.0")                        # there, but it can't be read
    with pytest.raises(Exception, match="directory|Is a|not a regular"):
        arraystore.import_array_store(spark, path, ["v"]).collect()


def test_each_array_is_read_by_its_own_metadata(spark, tmp_path):
    import gzip
    import json
    import zlib

    import numpy as np
    import zstandard
    rng = np.random.default_rng(1)
    kinds = {"a": ("<f8", (3, 2, 2), "C", "NaN", "zstd"), "b": ("<i2", (2, 3, 4), "F", -32768, "zlib"),
             "c": (">f4", (5, 3, 4), "C", None, None), "d": ("<i4", (2, 3, 4), "C", -1, "gzip")}
    shape, truth, meta = (5, 3, 4), {}, {}
    pack = {"zstd": lambda b: zstandard.ZstdCompressor().compress(b), "zlib": zlib.compress, "gzip": gzip.compress, None: bytes}
    for v, (dtype, chunks, order, fill, codec) in kinds.items():
        truth[v] = values = rng.integers(0, 100, shape).astype(dtype)
        if fill not in (None, "NaN"):
            values[0, 0, :2] = fill
        meta[f"{v}/.zarray"] = {"shape": shape, "chunks": chunks, "dtype": dtype, "order": order, "fill_value": fill,
                                "compressor": codec and {"id": codec}, "filters": None, "zarr_format": 2}
        (tmp_path / v).mkdir()
        for t in range(0, 5, chunks[0]):
            for y in range(0, 3, chunks[1]):
                for x in range(0, 4, chunks[2]):
                    full = np.zeros(chunks, dtype)
                    part = values[t:t + chunks[0], y:y + chunks[1], x:x + chunks[2]]
                    full[tuple(slice(k) for k in part.shape)] = part
                    (tmp_path / v / f"{t // chunks[0]}.{y // chunks[1]}.{x // chunks[2]}").write_bytes(pack[codec](full.tobytes(order)))
    (tmp_path / ".zmetadata").write_text(json.dumps({"metadata": meta}))
    got = {(r.time_idx, r.y, r.x): r for r in arraystore.import_array_store(spark, str(tmp_path)).collect()}
    assert len(got) == 60
    for at in np.ndindex(*shape):
        for v, (_, _, _, fill, _) in kinds.items():
            want = float(truth[v][at])
            assert got[at][v] == (None if want == fill else want)


@pytest.mark.parametrize("position", [(4, 0, 0), (-1, 0, 0), (0, 1, 0), (0, 0, None)])
def test_positions_outside_the_shape_are_refused(spark, tmp_path, position):
    g = spark.createDataFrame([(0, 0, 0, 1.0), (*position, 2.0)], "time_idx int, y int, x int, v double")
    with pytest.raises(Exception, match="outside the shape"):
        arraystore.export_array_store(g, str(tmp_path / "a"), ["v"], (4, 1, 1), (2, 1, 1)).collect()


def test_scratch_is_cleared(spark, monkeypatch):
    import chronogrid.session as session
    monkeypatch.setattr(session, "scratch_root", lambda s, root=f"{session.checkpoint_root(spark)}/t-clear": root)
    path = session.scratch_path(spark, "table")
    spark.range(3).write.parquet(path)
    session.clear_scratch(spark)
    assert not os.path.exists(path)


def test_shared_folder_is_required_on_a_cluster(monkeypatch):
    from types import SimpleNamespace
    from chronogrid.session import checkpoint_root
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None),
                              sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        checkpoint_root(session)
    assert daily.STEPS_PER_DAY == 24
