"""How events arrive: totals, rates, gaps and bursts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adstream.functions import interval_micros


def event_summary(events: DataFrame, ts: str = "event_ts") -> DataFrame:
    """One row: number of events, first and last event time."""
    return events.agg(
        F.count("*").alias("events"),
        F.min(ts).alias("first_event_ts"),
        F.max(ts).alias("last_event_ts"),
    )


def overall_rate(events: DataFrame, ts: str = "event_ts") -> DataFrame:
    """One row: events per second from the first to the last event."""
    seconds = (F.unix_micros("last_event_ts") - F.unix_micros("first_event_ts")) / 1e6
    return event_summary(events, ts).select(
        "events",
        seconds.alias("seconds"),
        F.when(seconds > 0, F.col("events") / seconds).alias("events_per_second"),
    )


def bucket_counts(events: DataFrame, length: str, ts: str = "event_ts") -> DataFrame:
    """Events per time bucket; empty buckets are not listed."""
    return (
        events.groupBy(F.window(ts, length).alias("window"))
        .agg(F.count("*").alias("events"))
        .select(F.col("window.start").alias("bucket_start"), "events")
    )


def arrival_rate(
    events: DataFrame, length: str = "1 second", ts: str = "event_ts"
) -> DataFrame:
    """Events and events per second in each non-empty bucket."""
    seconds = interval_micros(length) / 1e6
    return bucket_counts(events, length, ts).withColumn(
        "events_per_second", F.col("events") / F.lit(seconds)
    )


def burst_profile(
    events: DataFrame,
    length: str = "1 second",
    threshold: float = 2.0,
    ts: str = "event_ts",
) -> DataFrame:
    """Split time into HIGH and LOW buckets, and give each phase's rate.

    Buckets run from the first to the last event, empty ones included; HIGH are
    those with more than ``threshold`` times the mean count. An empty bucket is
    never HIGH, so the empty ones are counted as a difference and not made.
    """
    if threshold < 0:
        raise ValueError("threshold must not be negative")
    micros = interval_micros(length)
    counts = bucket_counts(events, length, ts)
    span = F.unix_micros(F.max("bucket_start")) - F.unix_micros(F.min("bucket_start"))
    buckets = (span / F.lit(micros)).cast("bigint") + 1
    mean = counts.agg((F.sum("events") / buckets).alias("mean")).scalar()
    high = F.col("events") > mean * F.lit(float(threshold))
    phases = counts.withColumn("high", high).agg(
        F.count_if("high").alias("high_buckets"),
        F.sum(F.when(F.col("high"), F.col("events")).otherwise(0)).alias("high_events"),
        buckets.alias("buckets"),
        F.sum("events").alias("events"),
    )
    high_row = F.struct(
        F.lit("HIGH").alias("phase"),
        F.col("high_buckets").alias("buckets"),
        F.col("high_events").alias("events"),
    )
    low_row = F.struct(
        F.lit("LOW").alias("phase"),
        (F.col("buckets") - F.col("high_buckets")).alias("buckets"),
        (F.col("events") - F.col("high_events")).alias("events"),
    )
    rate = F.col("events") / (F.col("buckets") * F.lit(micros / 1e6))
    return (
        phases.select(F.inline(F.array(high_row, low_row)))
        .filter(F.col("buckets") > 0)
        .withColumn("events_per_second", rate)
    )


def arrival_gaps(
    events: DataFrame,
    key: str = "campaign_id",
    ts: str = "event_ts",
    bucket: str = "1 minute",
) -> DataFrame:
    """Mean and deviation of the gaps between neighbouring events of a campaign.

    ``ratio`` is deviation over mean: 1 for Poisson arrivals, more for bursts.

    Sorting a whole campaign in one task would not scale, so gaps are taken
    inside (campaign, bucket), and the gap between the last event of one bucket
    and the first of the next comes from one small row per bucket. Events at the
    same instant are merged first: they add gaps of zero only, and no instant can
    then crowd a task. A bucket holds at most one row per microsecond. All sums
    are whole microseconds, so the result does not depend on the partitioning.
    """
    micros = interval_micros(bucket)
    if micros > 45 * 60_000_000:
        raise ValueError("bucket must not exceed 45 minutes, or squares overflow")
    at = F.col("at")
    instants = (
        events.select(F.col(key), F.unix_micros(ts).alias("at"))
        .filter(at.isNotNull())
        .groupBy(key, "at")
        .agg(F.count("*").alias("events"))
        .withColumn("bucket", F.floor(at / F.lit(micros)))
    )
    inside = Window.partitionBy(key, "bucket").orderBy("at")
    gap = at - F.lag(at).over(inside)
    buckets = (
        instants.withColumn("gap", gap)
        .groupBy(key, "bucket")
        .agg(
            F.sum("events").alias("events"),
            F.min("at").alias("first_at"),
            F.max("at").alias("last_at"),
            F.sum(F.col("gap") * F.col("gap")).alias("squares"),
        )
    )
    across = Window.partitionBy(key).orderBy("bucket")
    step = (F.col("first_at") - F.lag("last_at").over(across)).cast("decimal(19,0)")
    squares = F.sum(
        F.coalesce(F.col("squares"), F.lit(0)).cast("decimal(38,0)")
        + F.coalesce(F.col("step") * F.col("step"), F.lit(0)).cast("decimal(38,0)")
    )
    total = F.col("total").cast("double")
    gaps = F.col("gaps")
    mean = F.when(gaps > 0, total / gaps)
    variance = (F.col("squares").cast("double") - total * total / gaps) / (gaps - 1)
    deviation = F.when(gaps > 1, F.sqrt(F.greatest(variance, F.lit(0.0))))
    return (
        buckets.withColumn("step", step)
        .groupBy(key)
        .agg(
            (F.sum("events") - 1).alias("gaps"),
            (F.max("last_at") - F.min("first_at")).alias("total"),
            squares.alias("squares"),
        )
        .select(
            key,
            "gaps",
            (mean / 1e6).alias("mean_gap_s"),
            (deviation / 1e6).alias("deviation_s"),
            F.when(mean > 0, deviation / mean).alias("ratio"),
        )
    )
