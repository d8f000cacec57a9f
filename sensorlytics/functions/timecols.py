"""Time columns: epoch milliseconds, tumbling-window starts and calendar slots.

All arithmetic is on epoch-millisecond longs so it is independent of the session time
zone and stays inside whole-stage codegen.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_MINUTE = 60_000
MS_PER_HOUR = 3_600_000

_UNITS = {
    "ms": 1, "millisecond": 1, "milliseconds": 1,
    "s": 1000, "sec": 1000, "second": 1000, "seconds": 1000,
    "min": MS_PER_MINUTE, "minute": MS_PER_MINUTE, "minutes": MS_PER_MINUTE,
    "h": MS_PER_HOUR, "hour": MS_PER_HOUR, "hours": MS_PER_HOUR,
    "d": 86_400_000, "day": 86_400_000, "days": 86_400_000,
}


def width_ms(width: str | int) -> int:
    """``"5 minutes"`` / ``"1 day"`` / an int of milliseconds → milliseconds."""
    if isinstance(width, int):
        if width <= 0:
            raise ValueError("window width must be positive")
        return width
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", width)
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"cannot parse window width {width!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def spark_interval(width: str | int) -> str:
    """Width as a Spark interval string for ``F.window`` / ``withWatermark``."""
    return f"{width_ms(width)} milliseconds"


def ntz_epoch_ms(col: str | Column) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ column taken as UTC wall clock (zone-free).

    Floor division in long arithmetic (exact, also before 1970)."""
    c = F.col(col) if isinstance(col, str) else col
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    return F.call_function("div", us - F.pmod(us, F.lit(1000)), F.lit(1000))


def window_start_ms(ts_ms: str | Column, width: str | int) -> Column:
    """Start of the epoch-aligned tumbling window holding ``ts_ms``."""
    c = F.col(ts_ms) if isinstance(ts_ms, str) else ts_ms
    w = width_ms(width)
    return (c - F.pmod(c, F.lit(w))).cast("long")


def slot_floor_ms(ts_ms: str | Column, minutes: int) -> Column:
    """Calendar slot: zero seconds and ms, floor the minute-of-hour to a multiple of ``minutes``.

    Restarts every hour (so ``minutes`` = 7 leaves a short last slot, and ``minutes`` > 60
    gives hour slots), evaluated in UTC. Equals the tumbling-window start only when
    ``minutes`` divides 60.
    """
    if minutes <= 0:
        raise ValueError("slot minutes must be positive")
    c = F.col(ts_ms) if isinstance(ts_ms, str) else ts_ms
    into_hour = F.pmod(c, F.lit(MS_PER_HOUR))
    minute = F.call_function("div", into_hour, F.lit(MS_PER_MINUTE))
    return (c - into_hour + F.call_function("div", minute, F.lit(minutes)) * F.lit(minutes * MS_PER_MINUTE)).cast("long")
