"""End-to-end latency of result records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstream.functions import gap_ms


def window_latency(results: DataFrame) -> DataFrame:
    """Latency of each CTR record.

    That is its append time less the latest record time over all campaigns of
    its window.
    """
    first = _earliest_append(results)
    latest = first.groupBy("window_start").agg(
        F.max("max_kafka_ts").alias("window_max_ts")
    )
    return _beside(first, latest).withColumn(
        "latency_ms", gap_ms(F.col("append_ts"), F.col("window_max_ts"))
    )


def window_latency_smoothed(results: DataFrame) -> DataFrame:
    """As :func:`window_latency`, from the latest production time of the window."""
    first = _earliest_append(results)
    latest = first.groupBy("window_start").agg(
        F.max("max_produce_time").alias("window_max_ms")
    )
    return _beside(first, latest).withColumn(
        "latency_ms", F.unix_millis("append_ts") - F.col("window_max_ms")
    )


def _beside(records: DataFrame, latest: DataFrame) -> DataFrame:
    # An aggregate joined back, not a window function: the maximum is taken
    # partially before the shuffle, and a window with very many campaigns can be
    # split by the join, while a window function would sort it in one task.
    return records.join(latest, "window_start")


def _earliest_append(results: DataFrame) -> DataFrame:
    """Each different record once, with its first append time: sinks may repeat one.

    Records that differ in anything else are all kept. Those of another run must be
    kept apart by the caller, by the bounds of the read or a column of the run.
    """
    rest = [c for c in results.columns if c != "append_ts"]
    first = results.groupBy(*rest).agg(F.min("append_ts").alias("append_ts"))
    return first.select(*results.columns)


def latency_average(latencies: DataFrame) -> DataFrame:
    """Number of samples and their mean, of each run where ``run_id`` tells runs apart.

    Without that column there is one row, with a mean of NULL when there are none.
    """
    runs = [c for c in ("run_id",) if c in latencies.columns]
    return latencies.groupBy(*runs).agg(
        F.count("latency_ms").alias("samples"),
        F.avg("latency_ms").alias("mean_latency_ms"),
    )


def latency_curve(curve: DataFrame) -> DataFrame:
    """The points of a curve by rising throughput, all of them."""
    return curve.select("throughput", "latency").orderBy("throughput", "latency")


def mean_by_throughput(curve: DataFrame) -> DataFrame:
    """One point for each throughput, the mean of its latencies."""
    return curve.groupBy("throughput").agg(F.avg("latency").alias("latency"))
