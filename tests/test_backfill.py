"""Restartable backfills: chunks left, changed input, and a run that fails half way."""

import pytest
from pyspark.sql import functions as F

from chronogrid.config import ChunkPlan, GridSpec
from chronogrid.functions import timeaxis as ta
from chronogrid.plans import backfill
from chronogrid.plans import daily as jobs
from chronogrid.plans import hourly as hourly_jobs
from chronogrid.session import scratch_path
from chronogrid.sources import hourly_files
from chronogrid.sources.gridstore import GridStore, catalog_frame

SPEC = GridSpec("2024-01-01 00:00:00", "hour", ChunkPlan(48, 2, 2))


def hours(spark, days):
    return spark.range(24 * days).select((F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("time"),
                                         F.lit(0).alias("y"), F.lit(0).alias("x"), (F.col("id") % 37).cast("double").alias("T2D"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_daily_goes_on_where_it_ended(spark, monkeypatch):
    h = GridStore.create(spark, scratch_path(spark, "h"), SPEC, "2024-01-01", "2024-01-12 23:00:00", ["T2D"])
    h.write_region(hours(spark, 10))
    d = jobs.create_daily(spark, scratch_path(spark, "d"), h, ChunkPlan(2, 2, 2))
    process, calls = jobs.process_daily, []

    def failing(hourly, daily, a, b):
        calls.append((a, b))
        if len(calls) == 3:
            raise RuntimeError("lost")
        return process(hourly, daily, a, b)
    monkeypatch.setattr(jobs, "process_daily", failing)
    with pytest.raises(RuntimeError):
        backfill.backfill_daily(h, d, 0, 9, at_a_time=1)
    assert calls == [(0, 0), (1, 1), (2, 2)]
    assert backfill.backfill_daily(h, d, 0, 9, at_a_time=2) == [2, 3, 4]       # chunk 5 has no hours yet
    assert calls[3:] == [(2, 3), (4, 4)]
    assert rows(d.read()) == rows(jobs.daily_from_hourly(h))
    assert backfill.backfill_daily(h, d, 0, 9) == []
    # hours of days 3 and 4 change, and new ones come
    h.write_region(hours(spark, 12).where("time >= timestamp_ntz'2024-01-11 00:00:00'"))
    h.write_region(hours(spark, 4).where("time >= timestamp_ntz'2024-01-04 05:00:00'").withColumn("T2D", F.lit(-1.0)))
    assert backfill.backfill_daily(h, d, 0, 9) == [1, 5]
    assert rows(d.read()) == rows(jobs.daily_from_hourly(h))
    assert {(r.chunk, r.runs) for r in backfill.progress_report(d).collect()} == {(0, 1), (1, 2), (2, 1), (3, 1), (4, 1), (5, 1)}


def test_hourly_files_that_changed(spark):
    root, template = scratch_path(spark, "files"), "{wrf_dir}/wy_dir={wy_dir}/fname={fdate:%Y%m%d%H}"
    named = lambda g: g.withColumns({"wy_dir": ta.water_year_dir("time"), "fname": F.date_format("time", "yyyyMMddHH")})
    hourly_files.write_hourly_files(named(hours(spark, 6)), root)
    files = hourly_jobs.describe_files(catalog_frame(spark, [("T2D", ["time", "y", "x"], {}, {})]))
    store = GridStore.create(spark, scratch_path(spark, "store"), SPEC, "2024-01-01", "2024-01-08 23:00:00", ["T2D"])
    run = lambda **how: backfill.backfill_hourly(spark, store, 0, 3, root, template, files, **how)
    assert run(at_a_time=1, most_runs=2) == [0, 1]
    assert run() == [2]
    assert run() == []
    changed = named(hours(spark, 3).where("time = timestamp_ntz'2024-01-03 07:00:00'").withColumn("T2D", F.lit(500.0)))
    changed.write.mode("append").partitionBy("wy_dir", "fname").parquet(root)
    assert run() == [1]
    assert store.read().where("T2D = 500").count() == 1 and store.read().count() == 144
