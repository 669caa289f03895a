"""What a Python worker keeps between the tasks of one operator.

Workers are used again by later jobs.  Only one operator's tables stay in memory at
a time: the next operator's first task drops those of the one before."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable
from typing import Any

import pyarrow as pa

_KEPT: dict[str, Any] = {}


def _give_back() -> None:
    """Returns freed memory to the system: the worker lives on beside others."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries than glibc
        ctypes.CDLL(None).malloc_trim(0)


def kept(owner: str, make: Callable[[], Any] = dict) -> Any:
    """The value of ``owner`` in this worker, made at first; those of others are dropped."""
    if owner not in _KEPT:
        _KEPT.clear()
        _give_back()
        _KEPT[owner] = make()
    return _KEPT[owner]
