"""Date formats as ``strptime`` reads them, compiled to columns.

A format becomes a pattern of its directives, each as wide and as lenient as Python's
(``%m`` is one digit or two), and the fields become a TIMESTAMP_NTZ by
``try_make_timestamp_ntz``: no session zone and no legacy parser is involved.  A text that
the pattern doesn't cover to its end, or whose fields are no date, is NULL.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# What each directive accepts, as strptime does (ASCII digits).
ACCEPTS = {
    "Y": r"[0-9]{4}",
    "y": r"[0-9]{2}",
    "m": r"1[0-2]|0[1-9]|[1-9]",
    "d": r"3[0-1]|[1-2][0-9]|0[1-9]|[1-9]| [1-9]",
    "H": r"2[0-3]|[0-1][0-9]|[0-9]",
    "M": r"[0-5][0-9]|[0-9]",
    "S": r"6[0-1]|[0-5][0-9]|[0-9]",
    "f": r"[0-9]{1,6}",
    "j": r"36[0-6]|3[0-5][0-9]|[1-2][0-9][0-9]|0[1-9][0-9]|00[1-9]|[1-9][0-9]|0[1-9]|[1-9]",
}
# The Spark pattern that writes each directive as strftime does.
WRITES = {"Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "H": "HH", "M": "mm", "S": "ss", "f": "SSSSSS", "j": "DDD"}


#: Stands between the fields of a match; a text that holds it is no date.
MARK = "\x01"


@dataclass(frozen=True)
class Compiled:
    """A pattern with one group a field, and the fields in the order of their groups."""

    pattern: str
    fields: tuple[str, ...]


def compile_format(fmt: str) -> Compiled:
    """The pattern of a ``strptime`` format; blanks stand for any blanks, letters for either case."""
    pattern, fields, at = [], [], 0
    while at < len(fmt):
        c = fmt[at]
        if c == "%":
            name = fmt[at + 1:at + 2]
            at += 2
            if name == "%":
                pattern.append("%")
                continue
            if name not in ACCEPTS:
                raise ValueError(f"unknown directive %{name} in {fmt!r}")
            if name in fields:
                raise ValueError(f"%{name} twice in {fmt!r}")
            fields.append(name)
            pattern.append(f"({ACCEPTS[name]})")
        elif c.isspace():
            pattern.append(r"\s+")
            at = next((k for k in range(at, len(fmt)) if not fmt[k].isspace()), len(fmt))
        else:
            pattern.append(re.escape(c))
            at += 1
    if "Y" in fields and "y" in fields:
        raise ValueError(f"two years in {fmt!r}")
    return Compiled("(?i)^" + "".join(pattern), tuple(fields))


def strptime(text: Column, fmt: str) -> Column:
    """The time that ``fmt`` reads from a text, else NULL.

    Fields that the format lacks are those of January 1, 1900, midnight; ``%j`` counts
    from January 1 and may reach the next year."""
    c = compile_format(fmt)
    # one match of the leftmost reading; what it leaves over must be empty, as strptime tries no other one
    groups = MARK.join(f"${k + 1}" for k in range(len(c.fields) + 1))
    parts = F.split(F.regexp_replace(text, F.lit(f"(?s){c.pattern}(.*)$"), F.lit(MARK + groups)), MARK)
    return F.element_at(F.transform(F.array(parts), lambda p: _made(p, c.fields, F.instr(text, MARK) == 0)), 1)


def _made(parts: Column, fields: tuple[str, ...], clean: Column) -> Column:
    """The time of a match's fields (parts: nothing, the fields, what is left over)."""
    def number(name: str, default: int) -> Column:
        return F.trim(F.get(parts, fields.index(name) + 1)).try_cast("int") if name in fields else F.lit(default)
    year = number("Y", 1900)
    if "y" in fields:
        two = number("y", 0)
        year = two + F.when(two >= 69, F.lit(1900)).otherwise(F.lit(2000))
    second = number("S", 0).cast("decimal(16,6)")
    if "f" in fields:
        micro = F.rpad(F.get(parts, fields.index("f") + 1), 6, "0").try_cast("int")
        second = (second + micro.cast("decimal(16,6)") / F.lit(1_000_000)).cast("decimal(16,6)")
    # years from 1 on and seconds up to 59, as datetime has them
    ok = clean & (F.size(parts) == len(fields) + 2) & (F.get(parts, len(fields) + 1) == "") & (year >= 1) & (number("S", 0) <= 59)
    julian = "j" in fields
    made = F.try_make_timestamp_ntz(F.when(ok, year), F.lit(1) if julian else number("m", 1), F.lit(1) if julian else number("d", 1),
                                    number("H", 0), number("M", 0), second)
    return made + F.make_dt_interval(number("j", 1) - 1) if julian else made


def strftime(t: Column, fmt: str) -> Column:
    """A time as ``strftime`` writes it."""
    compile_format(fmt)
    pieces, at = [], 0
    for m in re.finditer(r"%(.)", fmt):
        if m.start() > at:
            pieces.append(F.lit(fmt[at:m.start()]))
        pieces.append(F.lit("%") if m[1] == "%" else F.date_format(t, WRITES[m[1]]))
        at = m.end()
    if at < len(fmt):
        pieces.append(F.lit(fmt[at:]))
    return F.concat(*pieces) if pieces else F.when(t.isNotNull(), F.lit(""))
