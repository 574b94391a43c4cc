"""Duration parsing shared by the operators: '1 hour', '5 minutes', '5 s',
a ``timedelta``, or an integer number of milliseconds."""

from __future__ import annotations

import datetime as _dt
import re

_UNITS = {
    "us": 1, "microsecond": 1, "microseconds": 1,
    "ms": 1_000, "millisecond": 1_000, "milliseconds": 1_000,
    "s": 1_000_000, "sec": 1_000_000, "second": 1_000_000, "seconds": 1_000_000,
    "min": 60_000_000, "minute": 60_000_000, "minutes": 60_000_000,
    "h": 3_600_000_000, "hour": 3_600_000_000, "hours": 3_600_000_000,
    "d": 86_400_000_000, "day": 86_400_000_000, "days": 86_400_000_000,
}


def duration_micros(d) -> int:
    """Duration -> integer microseconds."""
    if isinstance(d, _dt.timedelta):
        return (d.days * 86_400 + d.seconds) * 1_000_000 + d.microseconds
    if isinstance(d, int):
        return d * 1_000
    if isinstance(d, str):
        m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]+)\s*", d)
        if not m or m.group(2).lower() not in _UNITS:
            raise ValueError(f"cannot parse duration {d!r}")
        return int(m.group(1)) * _UNITS[m.group(2).lower()]
    raise TypeError(f"unsupported duration {d!r}")


def spark_interval(d) -> str:
    """Duration -> text accepted by ``withWatermark`` / ``window``."""
    us = duration_micros(d)
    if us % 1_000_000 == 0:
        return f"{us // 1_000_000} seconds"
    if us % 1_000 == 0:
        return f"{us // 1_000} milliseconds"
    return f"{us} microseconds"
