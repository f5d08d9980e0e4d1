"""Event time, ISO texts and time differences."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def event_timestamp(millis: Column) -> Column:
    """Epoch milliseconds as a timestamp."""
    return F.timestamp_millis(millis)


def iso_to_millis(text: Column) -> Column:
    """ISO text, with ``Z`` or an offset, as epoch milliseconds."""
    return F.unix_millis(F.to_timestamp(text))


def gap_ms(later: Column, earlier: Column) -> Column:
    """Milliseconds from ``earlier`` to ``later``."""
    return F.unix_millis(later) - F.unix_millis(earlier)


def window_text(start: Column) -> Column:
    """Window start as text with milliseconds, in the session time zone."""
    return F.date_format(start, "yyyy-MM-dd HH:mm:ss.SSS")


def interval_micros(length: str) -> int:
    """Microseconds in a fixed interval such as ``"10 seconds"``."""
    match = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", length.lower())
    if not match or match.group(2) not in _UNIT_MICROS or int(match.group(1)) == 0:
        raise ValueError(f"not a fixed interval: {length!r}")
    return int(match.group(1)) * _UNIT_MICROS[match.group(2)]
