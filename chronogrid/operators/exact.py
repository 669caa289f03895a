"""Sums of doubles as Spark's ``decimal(38,18)`` makes them, on whole arrays.

A double's decimal is that of its shortest text, rounded half up to 18 places, and sums
of decimals are exact.  Here a decimal is three integer limbs (units, and billionths and
billionths of billionths of one), so limbs are added as 64-bit integers in any order.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import numpy as np

BILLION = 1_000_000_000
#: Values whose sums of some thousands fit the limbs; larger ones are refused.
LARGEST = 1e15
_SPLIT = 134217729.0                                                   # 2 ** 27 + 1
_POW = np.array([float(f"1e{k}") for k in range(-6, 17)])              # powers from 1e-6 on
_UP = np.array([10.0 ** k for k in range(23)])                         # exact in a double
_INT = np.array([10 ** k for k in range(19)], np.int64)
#: Decimal exponent of a power of two, or one less.
_EXPONENT = np.clip(np.floor((np.arange(-1100, 1100) - 1) * np.log10(2.0)), -6, 15).astype(np.int64)


def _two_product(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``a * b`` and its rounding error."""
    p = a * b
    t = a * _SPLIT
    ah = t - (t - a)
    al = a - ah
    t = b * _SPLIT
    bh = t - (t - b)
    bl = b - bh
    return p, ((ah * bh - p) + ah * bl + al * bh) + al * bl


def _shortest(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Integers ``c`` of up to 17 digits and ``k``: c / 10 ** k is the shortest decimal of ``a`` (0, or 1e-6 to ``LARGEST``)."""
    mantissa, two = np.frexp(a)
    e = _EXPONENT[two + 1100]
    e += a >= _POW[e + 7]
    k = 16 - e
    up = _UP[k]
    high, low = _two_product(a, up)
    whole = np.rint(low)
    rest = low - whole                                                 # a * 10 ** k = m + rest
    m = high.astype(np.int64) + whole.astype(np.int64)
    half = np.ldexp(up, two - 54)                                      # decimals nearer than that read back as a
    lower = np.where(mantissa == 0.5, half / 2, half)                  # below a power of two doubles are denser
    c = m
    for unit in (10, 100):                                             # at most one multiple of 100 is that near
        tens = m // unit
        r = m - tens * unit
        over = r + rest - unit / 2
        to = np.where((over > 0) | ((over == 0) & (tens & 1 == 1)), unit, 0) - r   # halves to even
        off = to - rest
        c = np.where((off < half) & (off > -lower), m + to, c)
    return c, k


def limbs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The decimals of doubles."""
    negative = values < 0
    signed = negative.any()
    a = np.abs(values) if signed else values
    usual = (a < LARGEST) & ((a >= 1e-6) | (a == 0))
    whole_array = usual.all()
    u = a if whole_array else np.where(usual, a, 0.0)
    c, k = _shortest(u)
    units = u.astype(np.int64)                                         # no whole number lies between a double and its decimal
    if k.max(initial=0) > 18:                                          # more than 18 places: half up
        less, drop = k > 18, _INT[np.maximum(k - 18, 0)]
        k = np.minimum(k, 18)
        part = np.where(less, (c + drop // 2) // drop, (c - units * _INT[k]) * _INT[18 - k])
    else:
        part = (c - units * _INT[k]) * _INT[18 - k]
    if not whole_array:
        if not (a < LARGEST).all():
            raise ArithmeticError(f"values from {LARGEST:.0e} on, or none, can't be summed")
        small = ~usual
        scaled = a[small] * 1e18
        near = np.floor(scaled + 0.5)
        unsure = np.abs(scaled - np.floor(scaled) - 0.5) < 1e-3
        near[unsure] = [int((Decimal(repr(x)) * 10 ** 18).quantize(Decimal(1), ROUND_HALF_UP)) for x in a[small][unsure].tolist()]
        part[small] = near.astype(np.int64)
    first = part // BILLION
    second = part - first * BILLION
    if signed:
        sign = np.where(negative, -1, 1)
        return units * sign, first * sign, second * sign
    return units, first, second


def places(values: np.ndarray, most: int = 9) -> int | None:
    """Decimal places, up to ``most``, that write all of ``values``, if any."""
    return next((k for k in range(most + 1) if (np.rint(values * _UP[k]) / _UP[k] == values).all()), None)


def short(values: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers ``q`` and where ``q / 10 ** k`` is the decimal of a double (elsewhere ``q`` is 0), for ``k`` up to 18.

    A decimal of up to 15 digits that reads back as the double is its shortest: no two share
    one.  Sums of some ten thousands of ``q`` fit 64 bits."""
    q = np.rint(values * _UP[k])
    done = (q / _UP[k] == values) & (np.abs(q) < 1e14)
    return np.where(done, q, 0.0).astype(np.int64), done


def split(sums: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The limbs of ``sums / 10 ** k``."""
    units = sums // _INT[k]
    part = (sums - units * _INT[k]) * _INT[18 - k]
    first = part // BILLION
    return units, first, part - first * BILLION


def to_double(units: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The doubles nearest to sums of limbs."""
    first = first + second // BILLION
    units = units + first // BILLION
    part = first % BILLION * BILLION + second % BILLION
    high = part.astype(np.float64)
    low = (part - high.astype(np.int64)).astype(np.float64)
    scale = np.full_like(high, 1e18)
    q = high / scale
    p, err = _two_product(q, scale)
    q2 = (((high - p) - err) + low) / scale
    u = units.astype(np.float64)
    s = u + q
    t = s - u
    return s + (((u - (s - t)) + (q - t)) + q2)
