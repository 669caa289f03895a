"""Hourly -> daily reduction with strict missing handling.

A day is a block of 24 consecutive steps of the hourly axis (positions
``24k .. 24k+23``).  A block value exists only if all 24 steps are present and
non-missing; absent rows count as missing.  Which hours have a value is a mask of 24
bits, merged by ``bit_or``: a repeated hour can't stand in for a missing one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import timeaxis as ta
from ..functions.values import rate_to_step_total

STEPS_PER_DAY = 24

# Daily variables and the hourly variables they come from.
DAILY_SOURCES = {"T2MAX": "T2D", "T2MIN": "T2D", "RAIN": "RAINRATE"}

# Attributes of the daily variables.
DAILY_ATTRS = {
    "T2MAX": {"coordinates": "x y", "grid_mapping": "crs",
              "long_name": "Daily maximum temperature at 2 meters", "units": "K"},
    "T2MIN": {"coordinates": "x y", "grid_mapping": "crs",
              "long_name": "Daily minimum temperature at 2 meters", "units": "K"},
    "RAIN": {"coordinates": "x y", "grid_mapping": "crs",
             "long_name": "Daily accumulated precipitation", "standard_name": "precipitation",
             "units": "mm", "integration_length": "24-hour accumulation"},
}

# Sum accumulator: a fixed-point decimal makes the daily sum independent of the
# order rows arrive in (identical on every run, retry and partitioning).
SUM_TYPE = "decimal(38,12)"


# --- WN03 block_index -----------------------------------------------------------
def block_index(idx) -> Column:
    idx = F.col(idx) if isinstance(idx, str) else idx
    return F.floor(idx / STEPS_PER_DAY).cast("int")


#: All 24 hours.
FULL_DAY = (1 << STEPS_PER_DAY) - 1


def _bit(hour: Column, when: Column) -> Column:
    return F.when(when, F.call_function("shiftleft", F.lit(1), hour))


def hour_mask(v: str) -> Column:
    """Bits of the hours (column ``_hour``) at which ``v`` has a value."""
    return F.coalesce(F.bit_or(_bit(F.col("_hour"), F.col(v).isNotNull())), F.lit(0))


def strict(agg: Column, mask: Column) -> Column:
    """Aggregate only when every hour of the day has a value."""
    return F.when(mask == FULL_DAY, agg)


def strict_max(v: str) -> Column:
    return strict(F.max(v), hour_mask(v))


def strict_min(v: str) -> Column:
    return strict(F.min(v), hour_mask(v))


def strict_sum(v: Column | str, hours_of: str) -> Column:
    v = F.col(v) if isinstance(v, str) else v
    return strict(F.sum(v.cast(SUM_TYPE)), hour_mask(hours_of)).cast("double")


# --- PF06 derive_daily_vars ---------------------------------------------------
def daily_template_columns(available) -> list[str]:
    """Daily variables that can be derived from the available hourly ones."""
    return [d for d, s in DAILY_SOURCES.items() if s in available]


# --- AG01-AG04, JN01, PF07 ----------------------------------------------------
def _blocks(hourly: DataFrame, axis_start, step_seconds: int) -> DataFrame:
    # block = floor(seconds since the axis start / (24 steps)): one division
    secs, day = ta.seconds_since("time", axis_start), STEPS_PER_DAY * step_seconds
    return hourly.withColumns({"_block": F.floor(secs / F.lit(day)).cast("int"),
                               "_hour": F.floor(F.pmod(secs, F.lit(day)) / F.lit(step_seconds)).cast("int")})


def daily_sources(columns) -> list[str]:
    have = [c for c in ("T2D", "RAINRATE") if c in columns]
    if not have:
        raise ValueError("daily reduction needs T2D and/or RAINRATE")
    return have


def day_state(hourly: DataFrame, axis_start, step_seconds: int = 3600, keys=("y", "x")) -> DataFrame:
    """``_block, keys, seen`` and per variable its 24 hourly values: what is known of each cell-day.

    ``seen`` has the bits of the hours with a row.  An hour that comes in several rows
    counts once, by its largest value.  One grouped aggregation, partial before its
    exchange; states of one cell-day are put together by ``merge_states``."""
    have = daily_sources(hourly.columns)
    g = _blocks(hourly, axis_start, step_seconds)
    slots = {v: F.array(*[F.max(F.when(F.col("_hour") == h, F.col(v))) for h in range(STEPS_PER_DAY)]).alias(v) for v in have}
    return g.groupBy("_block", *keys).agg(F.bit_or(_bit(F.col("_hour"), F.lit(True))).alias("seen"), *slots.values())


def merge_states(old: DataFrame, new: DataFrame, keys=("y", "x")) -> DataFrame:
    """States of ``old`` and ``new`` together: hours seen in ``new`` (missing values included) replace those of ``old``.

    Variables that ``new`` lacks stay as they are."""
    have = [c for c in old.columns if c not in ("_block", "seen", *keys)]
    j = old.alias("o").join(new.alias("n"), ["_block", *keys], "full")
    bits = F.coalesce(F.col("n.seen"), F.lit(0))

    def values(v: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(STEPS_PER_DAY - 1)), lambda h: F.when(
            bits.bitwiseAND(F.call_function("shiftleft", F.lit(1), h)) != 0, F.get(F.col(f"n.{v}"), h)).otherwise(F.get(F.col(f"o.{v}"), h)))
    return j.select("_block", *keys, F.coalesce(F.col("o.seen"), F.lit(0)).bitwiseOR(bits).alias("seen"), *[(values(v) if v in new.columns else F.coalesce(F.col(f"o.{v}"), F.array_repeat(F.lit(None).cast("double"), STEPS_PER_DAY))).alias(v)
                                                     for v in have])


def days_of_states(states: DataFrame, axis_start, keys=("y", "x"), with_counts: bool = False) -> DataFrame:
    """Strict daily values of cell-day states; a day with a missing hour has NULLs."""
    have = [c for c in states.columns if c not in ("_block", "seen", *keys)]
    n = {v: F.size(F.filter(v, lambda x: x.isNotNull())) for v in have}
    full = {v: n[v] == STEPS_PER_DAY for v in have}
    out = []
    if "T2D" in have:
        out += [F.when(full["T2D"], F.array_max("T2D")).alias("T2MAX"), F.when(full["T2D"], F.array_min("T2D")).alias("T2MIN")]
    if "RAINRATE" in have:
        total = F.aggregate("RAINRATE", F.lit(0).cast(SUM_TYPE), lambda a, x: (a + rate_to_step_total(x).cast(SUM_TYPE)).cast(SUM_TYPE))
        out.append(F.when(full["RAINRATE"], total.cast("double")).alias("RAIN"))
    if with_counts:
        out += [n[v].cast("int").alias(f"n_{v}") for v in have]
    return states.select(block_label(axis_start, "_block").alias("time"), *keys, *out)


def daily_reduce(hourly: DataFrame, axis_start, step_seconds: int = 3600,
                 keys=("y", "x"), with_counts: bool = False, unique: bool = False) -> DataFrame:
    """Strict daily ``T2MAX``/``T2MIN`` from ``T2D`` and ``RAIN`` from ``RAINRATE``.

    One grouped aggregation computes all three (the reference merges three
    separate reductions).  ``time`` of a block is the axis time of its first
    step, which equals the mean of its 24 times minus 690 minutes for a full
    block, and stays defined when the first hour itself is absent.

    Any frame may repeat an hour of a cell, which counts once by its largest value.
    ``unique`` says that none does (a grid store holds one row a position): a mask, a
    maximum, a minimum and a sum are then aggregated instead of 24 values."""
    if not unique:
        return days_of_states(day_state(hourly, axis_start, step_seconds, keys), axis_start, keys, with_counts)
    have = daily_sources(hourly.columns)
    g = _blocks(hourly, axis_start, step_seconds)
    aggs = []
    if "T2D" in have:
        aggs += [strict_max("T2D").alias("T2MAX"), strict_min("T2D").alias("T2MIN")]
    if "RAINRATE" in have:
        aggs += [strict_sum(rate_to_step_total("RAINRATE"), "RAINRATE").alias("RAIN")]
    if with_counts:
        aggs += [F.bit_count(hour_mask(c)).cast("int").alias(f"n_{c}") for c in have]
    out = g.groupBy("_block", *keys).agg(*aggs)
    return out.select(block_label(axis_start, "_block").alias("time"), *keys, *[c for c in out.columns if c not in ("_block", *keys)])


# --- AG04 block_time_label ----------------------------------------------------
def block_label(axis_start, block) -> Column:
    """Time label of a day block: first step of the block on the axis."""
    b = F.col(block) if isinstance(block, str) else block
    return ta.ntz(axis_start) + F.make_dt_interval(b.cast("int"), F.lit(0), F.lit(0), F.lit(0))


# Fixed value: minutes subtracted from the mean time of a day block.
LABEL_OFFSET_MINUTES = 690


def mean_minus_offset_label(times: Column, axis_start, minutes: int = LABEL_OFFSET_MINUTES) -> Column:
    """The reference's label rule, for comparison: mean of the block's times
    minus ``minutes`` (an aggregate over one block's rows; zone-free)."""
    secs = F.avg(ta.seconds_since(times, axis_start)) - F.lit(minutes * 60)
    return ta.ntz(axis_start) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs.cast("decimal(18,6)"))


# --- WN01 fill_last_time ------------------------------------------------------
def fill_missing_time(axis: DataFrame, idx: str = "time_idx", time: str = "time") -> DataFrame:
    """A NULL time becomes the previous step's time plus one day.

    Done as an equi-join on ``idx - 1`` instead of a global ``lag`` window,
    which would move the whole axis into one task.
    """
    prev = axis.select((F.col(idx) + 1).alias(idx), F.col(time).alias("_prev"))
    return (axis.join(prev, idx, "left")
            .withColumn(time, F.coalesce(F.col(time), ta.add_interval("_prev", days=1)))
            .drop("_prev"))


# --- JN01 for separately stored frames ----------------------------------------
def merge_frames(frames, keys=("time", "y", "x")) -> "DataFrame":
    """Align daily variables computed or stored separately: full outer joins on
    the keys (a position present in one frame only keeps NULL elsewhere)."""
    from functools import reduce
    return reduce(lambda a, b: a.join(b, list(keys), "full"), frames)
