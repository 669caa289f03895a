"""Daily values by presence masks: repeated and missing hours, merged states, the stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chronogrid.config import ChunkPlan, GridSpec
from chronogrid.operators import daily
from chronogrid.plans import daily as jobs
from chronogrid.session import scratch_path
from chronogrid.sources import hourly_files
from chronogrid.sources.gridstore import GridStore
from chronogrid.streaming.hourly_ingest import DayStates, start_hourly_ingest

BASE = dt.datetime(2024, 3, 1, 6)
SCHEMA = "time timestamp_ntz, y int, x int, T2D double, RAINRATE double"


def hours(spark, rows):
    return spark.createDataFrame([(BASE + dt.timedelta(hours=h), 0, x, t, r) for h, x, t, r in rows], SCHEMA)


def test_a_repeat_is_no_substitute(spark):
    day = [(h, 0, float(h), 1.0) for h in range(24)]
    for unique in (False, True):
        short = hours(spark, day[:23] + [(5, 0, 5.0, 1.0)])
        assert tuple(daily.daily_reduce(short, BASE, unique=unique).first())[3:] == (None, None, None)
    twice = hours(spark, day + [(5, 0, -50.0, 0.5), (5, 0, None, None)])
    assert tuple(daily.daily_reduce(twice, BASE).first()) == (BASE, 0, 0, 23.0, 0.0, 24 * 3600.0)
    nan = hours(spark, day[:23] + [(23, 0, None, 1.0)])
    assert tuple(daily.daily_reduce(nan, BASE, with_counts=True).first())[3:] == (None, None, 24 * 3600.0, 23, 24)


def test_merge_in_any_order(spark):
    rows = [(h, x, float(h * 7 % 11 + x), 0.25 * h) for h in range(60) for x in range(3) if (h, x) != (30, 1)]
    want = sorted(map(tuple, daily.daily_reduce(hours(spark, rows), BASE).collect()))
    parts = [rows[k::4] for k in range(4)]
    for order in ((0, 1, 2, 3), (3, 1, 0, 2)):
        s = daily.day_state(hours(spark, parts[order[0]]), BASE)
        for k in order[1:]:
            s = daily.merge_states(s, daily.day_state(hours(spark, parts[k]), BASE))
        assert sorted(map(tuple, daily.days_of_states(s, BASE).collect()), key=repr) == sorted(want, key=repr)
    # a later correction replaces its hour only, a missing value included
    s = daily.merge_states(s, daily.day_state(hours(spark, [(3, 0, 99.0, None)]), BASE))
    first = next(r for r in daily.days_of_states(s, BASE).collect() if (r.time, r.x) == (BASE, 0))
    assert first.T2MAX == 99.0 and first.RAIN is None


def test_plan_has_one_exchange(spark):
    plan = daily.daily_reduce(hours(spark, [(0, 0, 1.0, 1.0)]), BASE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


@pytest.mark.parametrize("before", [False, True], ids=["new", "earlier rows"])
def test_stream_of_batches(spark, monkeypatch, before):
    rows = [(h, x, float(h % 13 - x), 0.5) for h in range(72) for x in range(2) if h != 40]
    spec = GridSpec("2024-03-01 00:00:00", "hour", ChunkPlan(48, 2, 2))
    hourly = GridStore.create(spark, scratch_path(spark, "h"), spec, BASE, BASE + dt.timedelta(hours=95), ["RAINRATE", "T2D"])
    if before:
        hourly.write_region(hours(spark, rows[:50]))
        rows = rows[50:]
    d = jobs.create_daily(spark, scratch_path(spark, "d"), hourly, ChunkPlan(2, 2, 2))
    src, ckpt = scratch_path(spark, "src"), scratch_path(spark, "ckpt")
    schema = hourly_files.hourly_schema(["T2D", "RAINRATE"])
    read = []
    plain = GridStore.read
    monkeypatch.setattr(GridStore, "read", lambda self, *a, **k: read.append(a) or plain(self, *a, **k))

    def send(some):
        hours(spark, some).coalesce(1).write.mode("append").parquet(src)
        start_hourly_ingest(spark, src, schema, hourly, d, checkpoint=ckpt, max_files_per_trigger=1).awaitTermination()

    def agrees():
        want = jobs.daily_from_hourly(hourly)
        got = d.read().select(want.columns)
        touched = {tuple(r) for r in got.select("time", "y", "x").collect()}
        assert sorted(map(tuple, got.collect()), key=repr) == sorted((tuple(r) for r in want.collect() if tuple(r)[:3] in touched), key=repr)
        return touched

    send(rows[::2])
    send(rows[1::2])
    assert len(agrees()) == (4 if before else 6)
    n = len([a for a in read if a and a[0]])
    send([(40, 0, 5.0, 0.5), (41, 1, -77.0, 9.0)])       # a late hour and a correction, days after
    assert len([a for a in read if a and a[0]]) == n      # from states alone: no values of the hourly store are read
    agrees()
    done = {(r.time, r.x): r for r in d.read().collect()}
    assert done[BASE + dt.timedelta(days=1), 0].T2MAX is not None and done[BASE + dt.timedelta(days=1), 1].T2MAX is None
    DayStates(hourly, d)                                  # opening it again changes nothing
    send(rows[:4])                                        # a replay
    agrees()
