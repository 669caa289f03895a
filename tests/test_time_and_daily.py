"""Edge cases and properties of the time core and the daily reduction."""

import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronogrid.config import ChunkPlan, GridSpec
from chronogrid.functions import timeaxis as ta
from chronogrid.operators import daily, grid as gops

HOURLY = GridSpec("1979-10-01 00:00:00", "hour", ChunkPlan(144))
DAILY = GridSpec("1979-10-01 00:00:00", "day", ChunkPlan(36))


def hourly_rows(spark, rows):
    return spark.createDataFrame(rows, "time timestamp_ntz, y int, x int, T2D double, RAINRATE double")


def test_short_last_day_and_missing_hour_are_missing(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(hours=h), 0, 0, float(h), 0.001) for h in range(24 * 3 - 5) if h != 30]
    out = {r["time"]: r for r in daily.daily_reduce(hourly_rows(spark, rows), base).collect()}
    assert out[base]["T2MAX"] == 23.0 and out[base]["T2MIN"] == 0.0
    assert out[base]["RAIN"] == pytest.approx(24 * 0.001 * 3600)
    assert out[base + dt.timedelta(days=1)]["T2MAX"] is None      # hour 30 missing
    assert out[base + dt.timedelta(days=2)]["RAIN"] is None       # short last block
    assert out[base + dt.timedelta(days=2)]["T2MIN"] is None


def test_nan_is_missing_for_min_and_max(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(hours=h), 0, 0, float("nan") if h == 5 else 1.0, 1.0) for h in range(24)]
    from chronogrid.functions.values import mask_missing
    g = mask_missing(hourly_rows(spark, rows), ["T2D", "RAINRATE"])
    r = daily.daily_reduce(g, base).collect()[0]
    assert r["T2MAX"] is None and r["T2MIN"] is None and r["RAIN"] == pytest.approx(24 * 3600.0)


def test_label_when_first_hour_absent(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(hours=h), 0, 0, 1.0, 1.0) for h in range(1, 24)]
    r = daily.daily_reduce(hourly_rows(spark, rows), base).collect()[0]
    assert r["time"] == base and r["T2MAX"] is None


def test_tmin_le_tmax(spark):
    from chronogrid.sources import fixtures as fx
    d = daily.daily_reduce(fx.hourly_grid(spark, "/root/testdata/sf0.01"), fx.F1_SPEC.base_date)
    assert d.where(F.col("T2MIN") > F.col("T2MAX")).count() == 0


def py_chunk(t: dt.datetime, spec: GridSpec) -> int:
    return math.floor((t - spec.base).total_seconds() / spec.chunk_seconds)


@settings(max_examples=25, deadline=None)
@given(st.datetimes(min_value=dt.datetime(1950, 1, 1), max_value=dt.datetime(2100, 1, 1)))
def test_chunk_index_matches_floor(spark, t):
    t = t.replace(microsecond=0)
    df = spark.createDataFrame([(t,)], "t timestamp_ntz")
    r = df.select(ta.chunk_index("t", HOURLY).alias("h"), ta.chunk_index("t", DAILY).alias("d")).collect()[0]
    assert (r["h"], r["d"]) == (py_chunk(t, HOURLY), py_chunk(t, DAILY))


def test_chunk_range_roundtrip_and_negative(spark):
    df = spark.range(-5, 40).select(F.col("id").cast("int").alias("i"))
    r = df.select("i", ta.chunk_index(ta.chunk_start("i", HOURLY), HOURLY).alias("a"),
                  ta.chunk_index(ta.chunk_end("i", HOURLY), HOURLY).alias("b"),
                  ta.chunk_index(ta.chunk_end("i", DAILY), DAILY).alias("c")).collect()
    assert all(x["i"] == x["a"] == x["b"] == x["c"] for x in r)
    before = spark.createDataFrame([(dt.datetime(1979, 9, 30, 23),)], "t timestamp_ntz")
    assert before.select(ta.chunk_index("t", HOURLY)).first()[0] == -1
    s, e = spark.range(1).select(ta.chunk_start(F.lit(0), HOURLY), ta.chunk_end(F.lit(0), HOURLY)).first()
    assert (s, e) == (dt.datetime(1979, 10, 1), dt.datetime(1979, 10, 6, 23))


def test_non_utc_session_gives_same_chunks(spark):
    """Across the spring clock change in a zone with DST, zone-free arithmetic
    still counts 24 hours a day."""
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Denver")
        ts = [dt.datetime(2024, 3, 10, h) for h in range(0, 6)]
        df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
        got = [r[0] for r in df.select(ta.seconds_since("t", "2024-03-10 00:00:00")).collect()]
        assert got == [h * 3600 for h in range(6)]
        ax = gops.make_axis(spark, "2024-03-10 00:00:00", "2024-03-10 05:00:00", HOURLY)
        assert [r["time"] for r in ax.orderBy("time_idx").collect()] == ts
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_parse_datetime_formats_and_error(spark):
    df = spark.createDataFrame([("2024-01-05:07",), ("2024-01-05 07:00:00",), ("2024-01-05T07",),
                                ("2024-01-05T07:00:00",), ("junk",)], "s string")
    got = [r[0] for r in df.select(ta.parse_datetime("s")).collect()]
    assert got[:4] == [dt.datetime(2024, 1, 5, 7)] * 4 and got[4] is None
    with pytest.raises(Exception):
        ta.require_parsed(df.withColumn("t", ta.parse_datetime("s")), "s", "t").collect()


def test_water_year_and_pad(spark):
    df = spark.createDataFrame([(dt.datetime(1999, 9, 30, 23),), (dt.datetime(1999, 10, 1),)], "t timestamp_ntz")
    assert [r[0] for r in df.select(ta.water_year_dir("t")).collect()] == ["WY1999", "WY2000"]
    assert spark.range(1).select(ta.pad_index(F.lit(123456), 5)).first()[0] == "123456"


def test_fill_missing_time(spark):
    ax = spark.createDataFrame([(0, dt.datetime(2024, 1, 1)), (1, dt.datetime(2024, 1, 2)), (2, None)],
                               "time_idx int, time timestamp_ntz")
    got = {r["time_idx"]: r["time"] for r in daily.fill_missing_time(ax).collect()}
    assert got[2] == dt.datetime(2024, 1, 3)
