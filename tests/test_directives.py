"""Date formats against Python's own strptime and strftime."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from chronogrid.functions import directives as di
from chronogrid.functions import timeaxis as ta

FORMATS = [*ta.HOURLY_FORMATS, *ta.DAILY_FORMATS, "%Y%m%d%H", "%y/%j", "%Y-%j %H", "%d.%m.%Y %H:%M:%S.%f", "100%% %Y", "%H:%M"]
TEXTS = ["2024-1-5:3", "2024-01-05 3:00:00", "2024-1-5T03", "2024-01-05T03:04:05", "2024-02-30:1", "2023-02-29", "2024-2-29", "2024-13-1",
         "2024-1-5", "2024-1-5:24", "2024-1-5 1:60:00", "2024-1-5 1:2:60", "2024-1-5 1:2:61", "2024-1-5   1:2:3", "2024-1-5\t1:2:3", " 2024-1-5",
         "2024-1-5 ", "24-1-5", "20240105", "2024010503", "202411233", "0001-1-1:0", "0000-1-1:0", "9999-12-31T23", "2024-1-5t3", "", None, "x",
         "24/366", "23/366", "69/1", "68/001", "2024-60 7", "5.1.2024 1:2:3.5", "05.01.2024 1:2:3.000001", "100% 2024", "7:5", "23:59", "2024- 5- 5",
         "2024-1- 5", "2024-001-5", "2024-1-05:007"]


def python_reads(text, fmt):
    try:
        return dt.datetime.strptime(text, fmt) if text is not None else None
    except ValueError:
        return None


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_reads_as_strptime_does(spark, zone):
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choices("0123456789-:T /", k=rng.randint(4, 16))) for _ in range(300)]
    texts += [f"{rng.randint(1, 9999):04d}-{rng.randint(0, 13)}-{rng.randint(0, 32):0{rng.randint(1, 2)}d}{rng.choice(['', ':', 'T', ' '])}{rng.randint(0, 25)}"
              for _ in range(300)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in texts], "s string")
        rows = df.select("s", *[di.strptime(F.col("s"), f).alias(f"c{k}") for k, f in enumerate(FORMATS)],
                         ta.parse_datetime("s").alias("first")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for r in rows:
        for k, f in enumerate(FORMATS):
            assert r[f"c{k}"] == python_reads(r.s, f), (r.s, f)
        assert r.first == next((x for x in (python_reads(r.s, f) for f in ta.HOURLY_FORMATS) if x), None), r.s
    assert sum(r.first is not None for r in rows) > 20


def test_writes_as_strftime_does(spark):
    times = [dt.datetime(2024, 1, 5, 3, 4, 5, 6000), dt.datetime(1979, 10, 1), dt.datetime(2000, 12, 31, 23, 59, 59, 999999)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    for f in FORMATS + ["%Y%j", "WY%Y/%m"]:
        assert [r[0] for r in df.select(di.strftime(F.col("t"), f)).collect()] == [t.strftime(f) for t in times]


def test_unknown_directives(spark):
    for f in ("%Q", "%", "%Y %Y", "%Y %y"):
        with pytest.raises(ValueError):
            di.compile_format(f)


def test_cf_units(spark):
    rows = [(1.5, "hours since 1979-10-01 00:00:00"), (2.0, "days since 2000-2-9"), (90.0, "Minutes since 2000-01-01T06:00:00"),
            (1.0, "fortnights since 2000-01-01"), (1.0, "hours since yesterday"), (1.0, None), (None, "hours since 2000-01-01")]
    got = [r[0] for r in spark.createDataFrame(rows, "n double, u string").select(ta.cf_decode("n", "u")).collect()]
    assert got == [dt.datetime(1979, 10, 1, 1, 30), dt.datetime(2000, 2, 11), dt.datetime(2000, 1, 1, 7, 30), None, None, None, None]
