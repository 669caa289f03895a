"""Job parameters (the reference keeps them in a YAML file with defaults)."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

STEP_SECONDS = {"hour": 3600, "day": 86400}


def parse_base_date(s: str | _dt.datetime) -> _dt.datetime:
    """Accept a base date with or without a time part."""
    if isinstance(s, _dt.datetime):
        return s
    for fmt in ("%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d"):
        try:
            return _dt.datetime.strptime(s, fmt)
        except ValueError:
            continue
    raise ValueError(f"unrecognised base date {s!r}")


@dataclass(frozen=True)
class ChunkPlan:
    """Chunk shape: ``time`` steps (hours for an hourly grid, days for a daily
    grid) by ``y`` by ``x`` cells."""

    time: int
    y: int = 175
    x: int = 175

    def as_dict(self) -> dict:
        return {"time": self.time, "y": self.y, "x": self.x}


@dataclass(frozen=True)
class GridSpec:
    """Regular time axis and chunking of one grid store."""

    base_date: str = "1979-10-01 00:00:00"
    freq: str = "hour"                      # "hour" or "day"
    plan: ChunkPlan = field(default_factory=lambda: ChunkPlan(144))

    @property
    def base(self) -> _dt.datetime:
        return parse_base_date(self.base_date)

    @property
    def base_literal(self) -> str:
        return self.base.strftime("%Y-%m-%d %H:%M:%S")

    @property
    def step_seconds(self) -> int:
        return STEP_SECONDS[self.freq]

    @property
    def chunk_seconds(self) -> int:
        return self.plan.time * self.step_seconds

    @property
    def num_days(self) -> int:
        """Days per chunk, derived from the plan so the two cannot disagree."""
        days, rem = divmod(self.chunk_seconds, 86400)
        if rem:
            raise ValueError(f"chunk of {self.plan.time} {self.freq}s is not whole days")
        return days


# Default base date and chunk plans of the hourly and daily stores.
HOURLY = GridSpec("1979-10-01 00:00:00", "hour", ChunkPlan(144, 175, 175))
DAILY = GridSpec("1979-10-01 00:00:00", "day", ChunkPlan(36, 350, 350))
