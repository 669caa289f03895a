"""Time-axis scalar functions as Spark column expressions.

All arithmetic is zone-free on TIMESTAMP_NTZ: differences are built from
``datediff`` on dates plus the time of day, so no result depends on the
session time zone or on daylight-saving changes.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import GridSpec, parse_base_date
from .directives import strftime, strptime

# Accepted input formats, in the order they are tried.
HOURLY_FORMATS = ("%Y-%m-%d:%H", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H", "%Y-%m-%dT%H:%M:%S")
DAILY_FORMATS = ("%Y-%m-%d",)
#: What a base date of a CF units text may look like.
CF_FORMATS = ("%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ntz(value: str | _dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal (never routed through a time zone)."""
    d = parse_base_date(value)
    txt = d.strftime("%Y-%m-%d %H:%M:%S") + (f".{d.microsecond:06d}" if d.microsecond else "")
    return F.to_timestamp_ntz(F.lit(txt))


def floor_day(t) -> Column:
    """Start of the day of an NTZ time (date -> NTZ cast is zone-free)."""
    return F.to_date(_c(t)).cast("timestamp_ntz")


def floor_hour(t) -> Column:
    """Start of the hour of an NTZ time."""
    t = _c(t)
    return floor_day(t) + F.make_dt_interval(F.lit(0), F.hour(t), F.lit(0), F.lit(0))


# --- SC01 parse_datetime ---------------------------------------------------
def parse_datetime(s, formats=HOURLY_FORMATS) -> Column:
    """First ``strptime`` format that reads the whole text, else NULL (``require_parsed``
    turns NULLs into an error).  Lenient as ``strptime`` is: fields of one digit are read;
    no session zone is involved."""
    return F.coalesce(*[strptime(_c(s), f) for f in formats])


def require_parsed(df, text_col: str, ts_col: str):
    """Raise (at execution) when a non-NULL text did not parse in any format."""
    return df.withColumn(
        ts_col,
        F.when(F.col(text_col).isNotNull() & F.col(ts_col).isNull(),
               F.raise_error(F.concat(F.lit("unparseable datetime: "), F.col(text_col))))
        .otherwise(F.col(ts_col)))


# --- SC02 format_datetime / SC03 year_of ----------------------------------
def format_datetime(t, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(_c(t), fmt)


def year_of(t) -> Column:
    return F.year(_c(t))


# --- SC04 water_year -------------------------------------------------------
def water_year(t) -> Column:
    """Water year of a day: the calendar year, plus one from October 1 on."""
    t = _c(t)
    return F.year(t) + F.when(F.month(t) >= 10, F.lit(1)).otherwise(F.lit(0))


def water_year_dir(t) -> Column:
    return F.concat(F.lit("WY"), water_year(t).cast("string"))


# --- SC05 add_interval -----------------------------------------------------
def add_interval(t, days=0, hours=0, minutes=0) -> Column:
    """``t`` plus a day-time interval; arguments may be ints or columns."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(int(v))
    return _c(t) + F.make_dt_interval(lit(days), lit(hours), lit(minutes), F.lit(0))


# --- seconds since a base, zone-free ---------------------------------------
def seconds_since(t, base) -> Column:
    """Whole seconds from ``base`` (literal) to NTZ column ``t`` (floor)."""
    b = parse_base_date(base)
    t = _c(t)
    base_sod = b.hour * 3600 + b.minute * 60 + b.second
    return (F.datediff(F.to_date(t), F.lit(b.date())).cast("long") * 86400
            + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t) - F.lit(base_sod))


def steps_since(t, base, step_seconds: int) -> Column:
    """Floor of (t - base) / step, e.g. the position on an hourly axis."""
    return F.floor(seconds_since(t, base) / F.lit(step_seconds)).cast("long")


# --- SC06 date_range -------------------------------------------------------
def date_range(start, end, freq: str = "hour") -> Column:
    """Array of the regular axis start..end inclusive (explode it)."""
    step = F.expr("INTERVAL 1 HOUR") if freq == "hour" else F.expr("INTERVAL 1 DAY")
    s = ntz(start) if isinstance(start, (str, _dt.datetime)) else start
    e = ntz(end) if isinstance(end, (str, _dt.datetime)) else end
    return F.sequence(s, e, step)


# --- SC07 year_bounds ------------------------------------------------------
def year_start(y) -> Column:
    """First day of a year (as TIMESTAMP_NTZ midnight)."""
    return F.make_date(_c(y), F.lit(1), F.lit(1)).cast("timestamp_ntz")


def year_end(y) -> Column:
    """Last day of a year (as TIMESTAMP_NTZ midnight)."""
    return F.make_date(_c(y), F.lit(12), F.lit(31)).cast("timestamp_ntz")


# --- SC08 chunk_index / SC09 chunk_range -----------------------------------
def chunk_index(t, spec: GridSpec) -> Column:
    """Floor of (t - base) / chunk length; negative before the base."""
    return F.floor(seconds_since(t, spec.base) / F.lit(spec.chunk_seconds)).cast("int")


def chunk_start(idx, spec: GridSpec) -> Column:
    secs = _c(idx).cast("long") * F.lit(spec.chunk_seconds)
    return ntz(spec.base) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs.cast("decimal(18,6)"))


def chunk_end(idx, spec: GridSpec) -> Column:
    """Inclusive end: next start minus one step (1 hour hourly, 24 hours daily)."""
    return add_interval(chunk_start(_c(idx) + 1, spec), hours=-(spec.step_seconds // 3600))


def time_chunk_bounds(start, end, spec: GridSpec) -> tuple[int, int]:
    """Driver-side chunk numbers of two literal times (for partition pruning)."""
    def idx(v):
        d = parse_base_date(v) - spec.base
        return int((d.days * 86400 + d.seconds) // spec.chunk_seconds)
    return idx(start), idx(end)


# --- SC11 cf_time ----------------------------------------------------------
# Seconds of the CF units read here.
CF_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
_CF_UNITS = r"(?i)^\s*(second|minute|hour|day)s?\s+since\s+(.+?)\s*$"


def cf_base(units) -> Column:
    """Base time of a CF ``hours since <date>`` units string."""
    return parse_datetime(F.regexp_extract(_c(units), _CF_UNITS, 2), CF_FORMATS)


def cf_decode(numbers, units) -> Column:
    """Numeric time in ``hours since <base>`` (or days, minutes, seconds) to TIMESTAMP_NTZ."""
    step = F.element_at(F.create_map(*[x for k, v in CF_SECONDS.items() for x in (F.lit(k), F.lit(v))]),
                        F.nullif(F.lower(F.regexp_extract(_c(units), _CF_UNITS, 1)), F.lit("")))
    secs = (_c(numbers).cast("double") * step).cast("decimal(18,6)")
    return cf_base(units) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


# --- SC12 path_format ------------------------------------------------------
_FIELD = re.compile(r"\{(\w+)(?::([^}]*))?\}")


def path_format(template: str, fields: dict[str, Column]) -> Column:
    """Fill ``{name}`` / ``{name:%Y%m%d%H}`` fields of a path template.

    Only named fields are substituted (no code is evaluated); a field with a
    strftime spec must be a timestamp column.
    """
    parts, pos = [], 0
    for m in _FIELD.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        name, spec = m.group(1), m.group(2)
        if name not in fields:
            raise KeyError(f"template field {name!r} not supplied")
        col = fields[name]
        if spec:
            col = strftime(col, spec)
        parts.append(col.cast("string"))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


# --- SC13 pad_index --------------------------------------------------------
def pad_index(i, width: int = 5) -> Column:
    """Zero-padded number; longer numbers are kept whole (unlike lpad)."""
    i = _c(i)
    return F.when(i.isNotNull(), F.format_string(f"%0{width}d", i))


# --- SC19 index_to_daily ---------------------------------------------------
def hourly_to_daily_range(c_st, c_en) -> tuple[Column, Column]:
    """Hourly half-open index range -> daily range, one more for a partial day."""
    st = F.floor(_c(c_st) / 24).cast("long")
    en = F.ceil(_c(c_en) / 24).cast("long")
    return st, en


# --- PF16 guard_range ------------------------------------------------------
def clip_range(c_st, c_en, n_steps) -> tuple[Column, Column, Column]:
    """(start, end clipped to the data, start-is-inside flag)."""
    return _c(c_st), F.least(_c(c_en), _c(n_steps)), _c(c_st) < _c(n_steps)


# --- PF19 chunk_aligned ----------------------------------------------------
def chunk_aligned(st, spec: GridSpec) -> Column:
    """Whole number of chunks after the base."""
    return F.pmod(seconds_since(st, spec.base), F.lit(spec.chunk_seconds)) == 0


# --- PF17 partial_chunk_flag ------------------------------------------------
def partial_chunk(last_time, spec) -> Column:
    """Whether the chunk of the last time ends after it."""
    t = F.col(last_time) if isinstance(last_time, str) else last_time
    return t < chunk_end(chunk_index(t, spec), spec)


# --- PF18 axis_up_to_date ---------------------------------------------------
def axis_up_to_date(axis_end: _dt.datetime, wanted_end: _dt.datetime) -> bool:
    """Whether an axis already reaches the end asked for."""
    return axis_end >= wanted_end
