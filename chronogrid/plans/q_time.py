"""Registered queries: time-axis scalar functions and guards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import ChunkPlan, GridSpec
from ..functions import timeaxis as ta
from ..functions import values as fv
from ..sources import fixtures as fx
from .registry import F1_BASE, F1_SQL, F2_SQL, F2_TIMES_SQL, f1, register

# Fixed parameters of the queries below.
HOURLY_SPEC = GridSpec("1979-10-01 00:00:00", "hour", ChunkPlan(144, 175, 175))
DAILY_SPEC = GridSpec("1979-10-01 00:00:00", "day", ChunkPlan(36, 350, 350))
OFFSET_SPEC = GridSpec("2024-01-10 05:00:00", "hour", ChunkPlan(144, 175, 175))
BASE79 = "TIMESTAMP '1979-10-01 00:00:00'"


def f2_times(spark, sf_dir):
    return fx.table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").alias("time")).distinct()


def event_hours(spark, sf_dir):
    return (fx.table(spark, sf_dir, "events").select(F.window("ts", "1 hour").start.alias("time"))
            .distinct())


EV_HOURS_SQL = "SELECT DISTINCT date_trunc('hour', ts) AS time FROM events"

_FMT_SQL = ["%Y-%m-%d:%H", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H", "%Y-%m-%dT%H:%M:%S"]


@register("SC01_parse_datetime", f"""WITH s AS (
  SELECT event_id, CASE event_id % 5
    WHEN 0 THEN strftime(ts, '{_FMT_SQL[0]}') WHEN 1 THEN strftime(ts, '{_FMT_SQL[1]}')
    WHEN 2 THEN strftime(ts, '{_FMT_SQL[2]}') WHEN 3 THEN strftime(ts, '{_FMT_SQL[3]}')
    ELSE 'bad:' || strftime(ts, '%Y%m%d') END AS s FROM events)
SELECT event_id, s, coalesce({", ".join(f"try_strptime(s, '{f}')" for f in _FMT_SQL)}) AS t FROM s""")
def q_sc01(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    fmts = ["yyyy-MM-dd:HH", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH", "yyyy-MM-dd'T'HH:mm:ss"]
    k = F.col("event_id") % 5
    s = (F.when(k == 0, F.date_format("ts", fmts[0])).when(k == 1, F.date_format("ts", fmts[1]))
         .when(k == 2, F.date_format("ts", fmts[2])).when(k == 3, F.date_format("ts", fmts[3]))
         .otherwise(F.concat(F.lit("bad:"), F.date_format("ts", "yyyyMMdd"))))
    return ev.select("event_id", s.alias("s")).withColumn("t", ta.parse_datetime("s"))


# Texts as a command line gives them: fields of one digit, and some that are no dates.
LOOSE_SQL = """SELECT event_id, CASE event_id % 9
    WHEN 0 THEN year(ts) || '-' || month(ts) || '-' || day(ts) || ':' || hour(ts)
    WHEN 1 THEN year(ts) || '-' || month(ts) || '-' || day(ts) || '  ' || hour(ts) || ':' || minute(ts) || ':' || second(ts)
    WHEN 2 THEN year(ts) || '-' || month(ts) || '-' || day(ts) || 'T' || hour(ts)
    WHEN 3 THEN year(ts) || '-' || month(ts) || '-' || day(ts) || 't' || hour(ts) || ':' || minute(ts) || ':' || second(ts)
    WHEN 4 THEN year(ts) || '-' || month(ts) || '-' || (day(ts) + 20) || ':' || hour(ts)
    WHEN 5 THEN year(ts) || '-' || month(ts) || '-' || day(ts) || 'T' || (hour(ts) + 10)
    WHEN 6 THEN strftime(ts, '%Y-%m-%d:%H')
    WHEN 7 THEN ' ' || strftime(ts, '%Y-%m-%dT%H')
    ELSE year(ts) || '-' || month(ts) || '-' || day(ts) || ' ' || hour(ts) || ':' || minute(ts) || ':' || (second(ts) + 30) END AS s, ts FROM events"""


def loose_texts(spark, sf_dir):
    t = F.col("ts")
    day = F.concat(F.year(t).cast("string"), F.lit("-"), F.month(t).cast("string"), F.lit("-"))
    d, h, m, sec = F.dayofmonth(t), F.hour(t), F.minute(t), F.second(t)
    clock = lambda s: F.concat(h.cast("string"), F.lit(":"), m.cast("string"), F.lit(":"), s.cast("string"))
    join = lambda *p: F.concat(day, *[x if isinstance(x, str) else x.cast("string") for x in p])
    k = F.col("event_id") % 9
    s = (F.when(k == 0, join(d, F.lit(":"), h)).when(k == 1, join(d, F.lit("  "), clock(sec))).when(k == 2, join(d, F.lit("T"), h))
         .when(k == 3, join(d, F.lit("t"), clock(sec))).when(k == 4, join(d + 20, F.lit(":"), h)).when(k == 5, join(d, F.lit("T"), h + 10))
         .when(k == 6, F.date_format(t, "yyyy-MM-dd:HH")).when(k == 7, F.concat(F.lit(" "), F.date_format(t, "yyyy-MM-dd'T'HH")))
         .otherwise(join(d, F.lit(" "), clock(sec + 30))))
    return fx.table(spark, sf_dir, "events").select("event_id", s.alias("s"))


# What the texts mean, from their fields: nothing is parsed.
LOOSE_TIME_SQL = """CASE event_id % 9 WHEN 0 THEN date_trunc('hour', ts) WHEN 1 THEN date_trunc('second', ts)
  WHEN 2 THEN date_trunc('hour', ts) WHEN 3 THEN date_trunc('second', ts)
  WHEN 4 THEN CASE WHEN day(ts) + 20 <= day(last_day(ts)) THEN date_trunc('hour', ts) + INTERVAL 20 DAY END
  WHEN 5 THEN CASE WHEN hour(ts) + 10 <= 23 THEN date_trunc('hour', ts) + INTERVAL 10 HOUR END
  WHEN 6 THEN date_trunc('hour', ts) WHEN 7 THEN NULL
  ELSE CASE WHEN second(ts) + 30 <= 59 THEN date_trunc('second', ts) + INTERVAL 30 SECOND END END"""


@register("SC01_parse_loose_texts", f"SELECT event_id, s, {LOOSE_TIME_SQL} AS t FROM ({LOOSE_SQL})")
def q_sc01_loose(spark, sf_dir):
    return loose_texts(spark, sf_dir).withColumn("t", ta.parse_datetime("s"))


@register("JB06_chunks_of_loose_texts", f"""SELECT event_id, s, CAST(floor(date_diff('second', {BASE79}, t) / (144 * 3600)) AS INTEGER) AS chunk,
  strftime(t, '%Y-%m-%dT%H') AS label FROM (SELECT event_id, s, {LOOSE_TIME_SQL} AS t FROM ({LOOSE_SQL})) WHERE t IS NOT NULL""")
def q_jb06_loose(spark, sf_dir):
    """JB06 on the texts that are dates (the job fails on others)."""
    from .hourly import chunk_index_of_texts
    texts = loose_texts(spark, sf_dir)
    dates = texts.where(ta.parse_datetime("s").isNotNull())
    return chunk_index_of_texts(dates, "s", HOURLY_SPEC).select("event_id", "s", "chunk", "label")


@register("SC02_format_datetime",
          f"SELECT DISTINCT time, strftime(time, '%Y-%m-%d %H:%M:%S') AS label, strftime(time, '%Y-%m-%dT%H') AS label_h FROM ({F1_SQL})")
def q_sc02(spark, sf_dir):
    return (f1(spark, sf_dir).select("time").distinct()
            .select("time", ta.format_datetime("time").alias("label"),
                    ta.format_datetime("time", "yyyy-MM-dd'T'HH").alias("label_h")))


@register("SC03_year_of", f"SELECT CAST(year(time) AS INTEGER) AS year, count(*) AS n FROM ({F2_SQL}) GROUP BY 1")
def q_sc03(spark, sf_dir):
    return fx.daily_grid(spark, sf_dir).groupBy(ta.year_of("time").alias("year")).agg(F.count("*").alias("n"))


@register("SC04_water_year", f"""SELECT time, CAST(year(time) + CASE WHEN month(time) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS water_year,
  'WY' || CAST(year(time) + CASE WHEN month(time) >= 10 THEN 1 ELSE 0 END AS VARCHAR) AS wy_dir FROM ({F2_TIMES_SQL})""")
def q_sc04(spark, sf_dir):
    return f2_times(spark, sf_dir).select("time", ta.water_year("time").alias("water_year"),
                                          ta.water_year_dir("time").alias("wy_dir"))


@register("SC05_add_interval", f"""SELECT time, time + INTERVAL 1 DAY AS next_day, time - INTERVAL 6 HOUR AS minus_6h,
  time + INTERVAL 90 MINUTE AS plus_90m FROM ({F2_TIMES_SQL})""")
def q_sc05(spark, sf_dir):
    t = f2_times(spark, sf_dir)
    return t.select("time", ta.add_interval("time", days=1).alias("next_day"),
                    ta.add_interval("time", hours=-6).alias("minus_6h"),
                    ta.add_interval("time", minutes=90).alias("plus_90m"))


@register("SC06_date_range", f"""WITH e AS (SELECT min(date_trunc('hour', ts)) AS s, max(date_trunc('hour', ts)) AS t FROM events)
SELECT unnest(generate_series(s, t, INTERVAL 1 HOUR)) AS time FROM e""")
def q_sc06(spark, sf_dir):
    """Hourly axis from the first to the last event hour.

    Days are generated first, then each day expands to its hours, so no single
    row holds the whole axis."""
    h = fx.table(spark, sf_dir, "events").select(F.window("ts", "1 hour").start.alias("t"))
    ext = h.agg(F.min("t").alias("s"), F.max("t").alias("e"))
    days = ext.select("s", "e", F.explode(ta.date_range(ta.floor_day("s"), ta.floor_day("e"), "day")).alias("d"))
    hours = days.select("s", "e", F.explode(ta.date_range(F.col("d"), ta.add_interval("d", hours=23), "hour"))
                        .alias("time"))
    return hours.where(F.col("time").between(F.col("s"), F.col("e"))).select("time")


@register("SC07_year_bounds", """SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year,
  CAST(make_date(CAST(year(l_shipdate) AS INTEGER), 1, 1) AS TIMESTAMP) AS year_start,
  CAST(make_date(CAST(year(l_shipdate) AS INTEGER), 12, 31) AS TIMESTAMP) AS year_end FROM lineitem""")
def q_sc07(spark, sf_dir):
    y = fx.table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year")).distinct()
    return y.select("year", ta.year_start("year").alias("year_start"), ta.year_end("year").alias("year_end"))


def _chunk_sql(t: str, base: str, secs: int) -> str:
    return f"CAST(floor(date_diff('second', {base}, {t}) / {secs}) AS INTEGER)"


@register("SC08_chunk_index", f"""SELECT time,
  {_chunk_sql('time', BASE79, 144 * 3600)} AS chunk_hourly,
  {_chunk_sql('time', "TIMESTAMP '2024-01-10 05:00:00'", 144 * 3600)} AS chunk_offset,
  {_chunk_sql('time', BASE79, 36 * 86400)} AS chunk_daily FROM ({EV_HOURS_SQL})""")
def q_sc08(spark, sf_dir):
    return event_hours(spark, sf_dir).select(
        "time", ta.chunk_index("time", HOURLY_SPEC).alias("chunk_hourly"),
        ta.chunk_index("time", OFFSET_SPEC).alias("chunk_offset"),
        ta.chunk_index("time", DAILY_SPEC).alias("chunk_daily"))


@register("SC09_chunk_range", f"""WITH c AS (SELECT DISTINCT {_chunk_sql('time', BASE79, 36 * 86400)} AS chunk FROM ({F2_TIMES_SQL}))
SELECT chunk, {BASE79} + to_days(chunk * 36) AS chunk_start,
  {BASE79} + to_days(chunk * 36 + 36) - INTERVAL 24 HOUR AS chunk_end,
  {BASE79} + to_days(chunk * 6) AS hourly_start,
  {BASE79} + to_days(chunk * 6 + 6) - INTERVAL 1 HOUR AS hourly_end FROM c""")
def q_sc09(spark, sf_dir):
    c = f2_times(spark, sf_dir).select(ta.chunk_index("time", DAILY_SPEC).alias("chunk")).distinct()
    return c.select("chunk", ta.chunk_start("chunk", DAILY_SPEC).alias("chunk_start"),
                    ta.chunk_end("chunk", DAILY_SPEC).alias("chunk_end"),
                    ta.chunk_start("chunk", HOURLY_SPEC).alias("hourly_start"),
                    ta.chunk_end("chunk", HOURLY_SPEC).alias("hourly_end"))


@register("SC11_cf_time", f"""SELECT event_id, 'hours since 2024-01-01 00:00:00' AS units,
  {F1_BASE} + to_microseconds(CAST(event_id % 720 AS BIGINT) * 3600000000) AS time FROM events""")
def q_sc11(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events").select(
        "event_id", F.lit("hours since 2024-01-01 00:00:00").alias("units"), (F.col("event_id") % 720).alias("hours"))
    return ev.select("event_id", "units", ta.cf_decode("hours", "units").alias("time"))


@register("SC13_pad_index", f"""WITH c AS (SELECT DISTINCT {_chunk_sql('time', BASE79, 144 * 3600)} AS chunk FROM ({F2_TIMES_SQL}))
SELECT chunk, printf('%05d', chunk) AS chunk5, printf('%04d', chunk) AS chunk4, printf('%02d', chunk) AS chunk2 FROM c""")
def q_sc13(spark, sf_dir):
    c = f2_times(spark, sf_dir).select(ta.chunk_index("time", HOURLY_SPEC).alias("chunk")).distinct()
    return c.select("chunk", ta.pad_index("chunk", 5).alias("chunk5"), ta.pad_index("chunk", 4).alias("chunk4"),
                    ta.pad_index("chunk", 2).alias("chunk2"))


@register("SC14_fixed_decimals", f"""SELECT time, y, x, printf('%.4f', qty) AS qty_txt, printf('%.4f', price) AS price_txt FROM ({F2_SQL})""")
def q_sc14(spark, sf_dir):
    return fx.daily_grid(spark, sf_dir).select("time", "y", "x", fv.fixed_decimals("qty").alias("qty_txt"),
                                              fv.fixed_decimals("price").alias("price_txt"))


@register("SC19_index_to_daily", f"""WITH n AS (SELECT CAST(date_diff('hour', {F1_BASE}, max(date_trunc('hour', ts))) AS BIGINT) + 1 AS n_steps FROM events),
c AS (SELECT DISTINCT CAST(floor(date_diff('hour', {F1_BASE}, date_trunc('hour', ts)) / 144) AS BIGINT) AS chunk FROM events),
r AS (SELECT chunk, chunk * 144 AS c_st, least(chunk * 144 + 144, n_steps) AS c_en FROM c, n)
SELECT chunk, c_st, c_en, CAST(floor(c_st / 24) AS BIGINT) AS d_st, CAST(ceil(c_en / 24) AS BIGINT) AS d_en FROM r""")
def q_sc19(spark, sf_dir):
    h = event_hours(spark, sf_dir).select(ta.steps_since("time", fx.F1_SPEC.base_date, 3600).alias("idx"))
    n_steps = h.select(F.max("idx") + 1).scalar()
    c = h.select(F.floor(F.col("idx") / 144).cast("long").alias("chunk")).distinct()
    r = c.select("chunk", (F.col("chunk") * 144).alias("c_st"), F.least(F.col("chunk") * 144 + 144, n_steps).alias("c_en"))
    d_st, d_en = ta.hourly_to_daily_range("c_st", "c_en")
    return r.select("chunk", "c_st", "c_en", d_st.alias("d_st"), d_en.alias("d_en"))


@register("PF16_guard_range", f"""WITH n AS (SELECT CAST(date_diff('hour', {F1_BASE}, max(date_trunc('hour', ts))) AS BIGINT) + 1 AS n_steps FROM events),
c AS (SELECT DISTINCT CAST(floor(date_diff('hour', {F1_BASE}, date_trunc('hour', ts)) / 100) AS BIGINT) AS chunk FROM events)
SELECT chunk, chunk * 100 AS c_st, least(chunk * 100 + 100, n_steps) AS c_en, chunk * 100 < n_steps AS inside FROM c, n""")
def q_pf16(spark, sf_dir):
    h = event_hours(spark, sf_dir).select(ta.steps_since("time", fx.F1_SPEC.base_date, 3600).alias("idx"))
    n_steps = h.select(F.max("idx") + 1).scalar()
    c = h.select(F.floor(F.col("idx") / 100).cast("long").alias("chunk")).distinct()
    st, en, inside = ta.clip_range(F.col("chunk") * 100, F.col("chunk") * 100 + 100, n_steps)
    return c.select("chunk", st.alias("c_st"), en.alias("c_en"), inside.alias("inside"))


@register("PF17_partial_chunk_flag", f"""WITH c AS (SELECT {_chunk_sql('time', BASE79, 36 * 86400)} AS chunk, max(time) AS last_time FROM ({F2_TIMES_SQL}) GROUP BY 1)
SELECT chunk, last_time, last_time < {BASE79} + to_days(chunk * 36 + 36) - INTERVAL 24 HOUR AS partial FROM c""")
def q_pf17(spark, sf_dir):
    c = (f2_times(spark, sf_dir).groupBy(ta.chunk_index("time", DAILY_SPEC).alias("chunk"))
         .agg(F.max("time").alias("last_time")))
    return c.select("chunk", "last_time", (F.col("last_time") < ta.chunk_end("chunk", DAILY_SPEC)).alias("partial"))


@register("PF18_axis_up_to_date", """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, max(l_shipdate) AS last_time,
  CAST(CAST(max(l_shipdate) AS DATE) AS TIMESTAMP) = CAST(make_date(CAST(year(l_shipdate) AS INTEGER), 12, 31) AS TIMESTAMP) AS up_to_date
FROM lineitem GROUP BY 1""")
def q_pf18(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    g = li.groupBy(F.year("l_shipdate").alias("year")).agg(F.max("l_shipdate").alias("last_time"))
    return g.select("year", "last_time", (ta.floor_day("last_time") == ta.year_end("year")).alias("up_to_date"))


@register("PF19_chunk_aligned", f"""SELECT time, date_diff('second', {BASE79}, time) % (6 * 86400) = 0 AS aligned_6d,
  date_diff('second', {BASE79}, time) % (36 * 86400) = 0 AS aligned_36d FROM ({F2_TIMES_SQL})""")
def q_pf19(spark, sf_dir):
    return f2_times(spark, sf_dir).select("time", ta.chunk_aligned("time", HOURLY_SPEC).alias("aligned_6d"),
                                          ta.chunk_aligned("time", DAILY_SPEC).alias("aligned_36d"))


@register("JB06_get_chunk_index", f"""WITH s AS (
  SELECT event_id, CASE event_id % 4
    WHEN 0 THEN strftime(ts, '{_FMT_SQL[0]}') WHEN 1 THEN strftime(ts, '{_FMT_SQL[1]}')
    WHEN 2 THEN strftime(ts, '{_FMT_SQL[2]}') ELSE strftime(ts, '{_FMT_SQL[3]}') END AS s FROM events),
p AS (SELECT event_id, s, coalesce({", ".join(f"try_strptime(s, '{f}')" for f in _FMT_SQL)}) AS t FROM s)
SELECT event_id, s, {_chunk_sql('t', BASE79, 144 * 3600)} AS chunk, strftime(t, '%Y-%m-%dT%H') AS label FROM p""")
def q_jb06(spark, sf_dir):
    from .hourly import chunk_index_of_texts
    ev = fx.table(spark, sf_dir, "events")
    fmts = ["yyyy-MM-dd:HH", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH", "yyyy-MM-dd'T'HH:mm:ss"]
    k = F.col("event_id") % 4
    s = (F.when(k == 0, F.date_format("ts", fmts[0])).when(k == 1, F.date_format("ts", fmts[1]))
         .when(k == 2, F.date_format("ts", fmts[2])).otherwise(F.date_format("ts", fmts[3])))
    return chunk_index_of_texts(ev.select("event_id", s.alias("s")), "s", HOURLY_SPEC)
