"""Running queries on streams."""

from adstream.streaming.batches import drop_repeated, read_once, with_newest, write_once
from adstream.streaming.late import count_late, late_events
from adstream.streaming.listener import ProgressStore
from adstream.streaming.partitions import IdleWatch, with_partition_watermarks
from adstream.streaming.runner import run_available, run_to_table, start
from adstream.streaming.state import open_windows, state_operators

__all__ = [
    "IdleWatch",
    "ProgressStore",
    "count_late",
    "drop_repeated",
    "late_events",
    "open_windows",
    "read_once",
    "run_available",
    "run_to_table",
    "start",
    "state_operators",
    "with_newest",
    "with_partition_watermarks",
    "write_once",
]
