"""Jobs: manifest report, partial last chunk, streaming replay."""

import datetime as dt

from pyspark.sql import functions as F

from chronogrid.config import ChunkPlan, GridSpec
from chronogrid.session import scratch_path
from chronogrid.sources import hourly_files, manifest
from chronogrid.sources.gridstore import GridStore


def test_manifest_report_counts_missing(spark):
    spec = GridSpec("1979-10-01 00:00:00", "hour", ChunkPlan(24))
    chunks = spark.createDataFrame([(0,), (1,)], "chunk int")
    m = manifest.hourly_manifest(chunks, spec, "/w")
    listing = spark.createDataFrame([("/w/WY1980/197910020000.LDASIN_DOMAIN1",),
                                     ("/w/WY1980/197910020100.LDASIN_DOMAIN1",)], "path string")
    rep = {r["chunk"]: (r["expected"], r["found"], r["missing"]) for r in
           manifest.manifest_report(m, manifest.verified_manifest(m, listing, "/w")).collect()}
    assert rep == {0: (24, 0, 24), 1: (24, 2, 22)}


def test_partial_last_chunk_flag(spark):
    spec = GridSpec("2024-01-01 00:00:00", "hour", ChunkPlan(6, 1, 1))
    st = GridStore.create(spark, scratch_path(spark, "t-info"), spec, "2024-01-01 00:00:00",
                          "2024-01-01 08:00:00", ["v"])
    info = st.info().first()
    assert info["last_chunk"] == 1 and info["partial_last_chunk"]
    assert info["last_chunk_end"] == dt.datetime(2024, 1, 1, 11)


def test_streaming_replay_is_idempotent(spark):
    from chronogrid.streaming.hourly_ingest import start_hourly_ingest
    spec = GridSpec("2024-01-01 00:00:00", "hour", ChunkPlan(24, 1, 1))
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), 0, 0, float(h), 0.5) for h in range(48)]
    src = scratch_path(spark, "t-stream-src")
    df = spark.createDataFrame(rows, "time timestamp_ntz, y int, x int, T2D double, RAINRATE double")
    hourly_files.write_hourly_files(df.withColumns({"wy_dir": F.lit("WY2024"),
                                                    "fname": F.date_format("time", "yyyyMMddHH")}), src, n_writers=4)
    st = GridStore.create(spark, scratch_path(spark, "t-stream-store"), spec, "2024-01-01 00:00:00",
                          "2024-01-02 23:00:00", ["T2D", "RAINRATE"])
    schema = hourly_files.hourly_schema(["T2D", "RAINRATE"])
    for _ in range(2):      # second run: fresh checkpoint, every file replayed
        start_hourly_ingest(spark, src, schema, st, max_files_per_trigger=20).awaitTermination()
        got = st.read()
        assert got.count() == 48 and got.exceptAll(df).count() == 0


def test_daily_store_carries_attributes_and_merge_frames(spark):
    from chronogrid.operators import daily
    from chronogrid.plans import daily as daily_jobs
    from chronogrid.sources import fixtures as fx
    spec = fx.F1_SPEC
    h = GridStore.create(spark, scratch_path(spark, "t-h"), spec, spec.base_date, fx.F1_END, ["T2D", "RAINRATE"])
    h.write_region(fx.hourly_grid(spark, "/root/testdata/sf0.001"))
    d = daily_jobs.create_daily(spark, scratch_path(spark, "t-d"), h, ChunkPlan(6, 2, 2))
    daily_jobs.process_daily(h, d, 0, 1)
    meta = {f.name: f.metadata for f in d.read(with_attrs=True).schema.fields}
    assert meta["RAIN"]["units"] == "mm" and meta["T2MAX"]["long_name"].startswith("Daily maximum")
    red = daily.daily_reduce(fx.hourly_grid(spark, "/root/testdata/sf0.001"), spec.base_date)
    merged = daily.merge_frames([red.select("time", "y", "x", "T2MAX"), red.select("time", "y", "x", "RAIN")])
    assert merged.count() == red.count() and merged.exceptAll(red.select("time", "y", "x", "T2MAX", "RAIN")).count() == 0


def test_daily_axis_from_hourly_not_starting_at_midnight(spark):
    from chronogrid.plans import daily as daily_jobs
    spec = GridSpec("2024-01-01 00:00:00", "hour", ChunkPlan(24, 1, 1))
    h = GridStore.create(spark, scratch_path(spark, "t-h5"), spec, "2024-01-01 05:00:00", "2024-01-03 23:00:00", ["T2D"])
    d = daily_jobs.create_daily(spark, scratch_path(spark, "t-d5"), h, ChunkPlan(6, 1, 1))
    assert [r[0] for r in d.axis().orderBy("time").select("time").collect()] == [
        dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 2, 5), dt.datetime(2024, 1, 3, 5)]


def test_extend_daily_follows_hourly(spark):
    from chronogrid.plans import daily as daily_jobs
    spec = GridSpec("2024-01-01 00:00:00", "hour", ChunkPlan(24, 1, 1))
    h = GridStore.create(spark, scratch_path(spark, "t-hx"), spec, "2024-01-01 00:00:00", "2024-01-02 23:00:00", ["T2D"])
    d = daily_jobs.create_daily(spark, scratch_path(spark, "t-dx"), h, ChunkPlan(6, 1, 1))
    assert not daily_jobs.extend_daily(h, d)                 # already up to date
    assert h.extend_time("2024-01-04 23:00:00")
    assert daily_jobs.extend_daily(h, d)
    assert d.axis().count() == 4 and d.n_steps == 4


def test_tune_for_input_bounds(spark):
    from chronogrid.session import input_size, tune_for_input
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert tune_for_input(spark, input_size(spark, "/root/testdata/sf0.01"), min_partitions=8) == 8
        assert tune_for_input(spark, 10 * 1024 ** 4) == 20480             # 10 TB: a quarter in 128 MB pieces
        assert tune_for_input(spark, 100 * 1024 ** 4) == 65536            # capped
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(128 * 1024 * 1024)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
