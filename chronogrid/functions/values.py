"""Value-level functions: missing values, packing, units, text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Seconds per hourly step (rate in mm/s -> mm per step),
# millimetres per inch, kelvin at 0 degrees Celsius.
SECONDS_PER_HOUR = 3600
MM_PER_INCH = 25.4
KELVIN_AT_ZERO_C = 273.15


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- SC21 is_missing -------------------------------------------------------
def is_missing(v) -> Column:
    v = _c(v)
    return v.isNull() | F.isnan(v)


def mask_nan(v) -> Column:
    """NaN -> NULL: NULL is the only missing marker inside the engine."""
    v = _c(v)
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v.cast("double"))


def mask_missing(df: DataFrame, columns) -> DataFrame:
    """Apply :func:`mask_nan` to the named float columns (ingest rule)."""
    return df.withColumns({c: mask_nan(c) for c in columns})


# --- SR06 mask_and_scale ---------------------------------------------------
def mask_and_scale(packed, fill_value=None, scale_factor: float = 1.0, add_offset: float = 0.0) -> Column:
    """Decode packed values: fill value -> missing, then ``v * scale + offset``."""
    p = _c(packed)
    decoded = p.cast("double") * F.lit(float(scale_factor)) + F.lit(float(add_offset))
    if fill_value is None:
        return decoded
    return F.when(p == F.lit(fill_value), F.lit(None).cast("double")).otherwise(decoded)


# --- PF07 scale_var --------------------------------------------------------
def rate_to_step_total(rate, seconds: int = SECONDS_PER_HOUR) -> Column:
    """Rate per second times the step length (mm/s -> mm per hour)."""
    return _c(rate) * F.lit(float(seconds))


# --- SC15 convert_units ----------------------------------------------------
def mm_to_inches(v) -> Column:
    return _c(v) / F.lit(MM_PER_INCH)


def kelvin_to_fahrenheit(v) -> Column:
    return (_c(v) - F.lit(KELVIN_AT_ZERO_C)) * F.lit(1.8) + F.lit(32.0)


# Output names and conversions of the polygon averages.
UNIT_CONVERSIONS = {
    "RAIN": ("prcp", mm_to_inches),
    "T2MAX": ("tmax", kelvin_to_fahrenheit),
    "T2MIN": ("tmin", kelvin_to_fahrenheit),
}


def convert_units(df: DataFrame, conversions=None, keep=()) -> DataFrame:
    """Converted variables under their new names, plus the ``keep`` columns."""
    conversions = conversions or UNIT_CONVERSIONS
    cols = [F.col(k) for k in keep]
    cols += [fn(F.col(src)).alias(dst) for src, (dst, fn) in conversions.items() if src in df.columns]
    return df.select(*cols)


# --- SC14 fixed_decimals ---------------------------------------------------
def fixed_decimals(v, places: int = 4) -> Column:
    """``%.Nf`` text; a missing value stays NULL (format_string would print 'null')."""
    v = _c(v)
    return F.when(v.isNotNull(), F.format_string(f"%.{places}f", v))


# Encoding keys of packed variables.
PACKING_KEYS = ("_FillValue", "scale_factor", "add_offset")


def decode_packed(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """SR06 driven by the catalog: every column whose catalog encoding has a
    ``scale_factor``, ``add_offset`` or ``_FillValue`` is decoded.  The
    encodings of the frame's columns (one small row each) are read once."""
    rows = (catalog.where(F.col("varname").isin(*df.columns))
            .select("varname", "encoding").collect())
    out = df
    for r in rows:
        enc = dict(r["encoding"] or {})
        if not any(k in enc for k in PACKING_KEYS):
            continue
        fill = enc.get("_FillValue")
        out = out.withColumn(r["varname"], mask_and_scale(
            r["varname"], None if fill is None else float(fill),
            float(enc.get("scale_factor", 1.0)), float(enc.get("add_offset", 0.0))))
    return out
