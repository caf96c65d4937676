"""Epoch-millisecond window arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def floor_to_window(ms, size_ms: int) -> Column:
    """Start of the epoch-aligned window that holds ``ms``."""
    ms = _col(ms)
    return ms - F.pmod(ms, F.lit(size_ms))


def window_remaining(ms, size_ms: int) -> Column:
    """Milliseconds left in the window that holds ``ms``."""
    return F.lit(size_ms) - F.pmod(_col(ms), F.lit(size_ms))


def event_time(ms="ts_ms") -> Column:
    """Event time comes from the payload, never from the transport."""
    return F.timestamp_millis(_col(ms))


def tumbling(size_ms: int) -> Column:
    return F.window("ts", f"{size_ms} milliseconds")


def utc_date(ms) -> Column:
    """Day of an epoch-millisecond value, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(_col(ms) / F.lit(86_400_000)).cast("int"))
