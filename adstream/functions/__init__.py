"""Column expressions shared by the operators."""

from adstream.functions.ratios import click_ratio, smoothed_ratio
from adstream.functions.times import (
    event_timestamp,
    gap_ms,
    interval_micros,
    iso_to_millis,
    window_text,
)

__all__ = [
    "click_ratio",
    "event_timestamp",
    "gap_ms",
    "interval_micros",
    "iso_to_millis",
    "smoothed_ratio",
    "window_text",
]
