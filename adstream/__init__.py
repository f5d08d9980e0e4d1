"""Click-through rates, latencies and arrival profiles of ad-event streams."""

__version__ = "0.1.0"
