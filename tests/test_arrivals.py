"""Arrival profiles against brute force."""

import math
import statistics
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adstream.functions import interval_micros
from adstream.operators import arrivals
from helpers import BASE, ad_events


def _gaps(rows):
    """campaign -> gaps in seconds, by sorting."""
    times = defaultdict(list)
    for campaign, _, ms in rows:
        times[campaign].append(ms)
    found = {}
    for campaign, values in times.items():
        values.sort()
        found[campaign] = [(b - a) / 1000 for a, b in zip(values, values[1:])]
    return found


def _check_gaps(df, rows):
    got = {r["campaign_id"]: r for r in df.collect()}
    want = _gaps(rows)
    assert set(got) == set(want)
    for campaign, gaps in want.items():
        row = got[campaign]
        assert row["gaps"] == len(gaps)
        if not gaps:
            assert row["mean_gap_s"] is None
            continue
        mean = statistics.fmean(gaps)
        assert math.isclose(row["mean_gap_s"], mean, rel_tol=1e-12, abs_tol=1e-12)
        if len(gaps) < 2:
            assert row["deviation_s"] is None
            continue
        deviation = statistics.stdev(gaps)
        assert math.isclose(row["deviation_s"], deviation, rel_tol=1e-6, abs_tol=1e-6)
        if mean > 0:
            assert math.isclose(row["ratio"], deviation / mean, rel_tol=1e-6, abs_tol=1e-6)
        else:
            assert row["ratio"] is None


event_rows = st.lists(
    st.tuples(
        st.sampled_from(["1", "2", None]),
        st.just("view"),
        st.one_of(st.integers(0, 300_000), st.sampled_from([0, 60_000, 120_000])),
    ),
    min_size=1,
    max_size=60,
)


@settings(
    max_examples=15,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(rows=event_rows, bucket=st.sampled_from(["1 second", "1 minute", "45 minutes"]))
def test_gaps(spark, rows, bucket):
    _check_gaps(arrivals.arrival_gaps(ad_events(spark, rows), bucket=bucket), rows)


def test_gaps_across_empty_buckets(spark):
    rows = [("1", "view", ms) for ms in (0, 10, 600_000, 600_020, 7_200_000)]
    _check_gaps(arrivals.arrival_gaps(ad_events(spark, rows)), rows)


def test_gaps_of_one_crowded_instant(spark):
    many = spark.range(50_000).select(
        F.lit("1").alias("campaign_id"),
        F.timestamp_millis(F.lit(BASE)).alias("event_ts"),
    )
    later = many.limit(1).withColumn("event_ts", F.timestamp_millis(F.lit(BASE + 1000)))
    row = arrivals.arrival_gaps(many.union(later)).first()
    assert row["gaps"] == 50_000
    assert math.isclose(row["mean_gap_s"], 1 / 50_000)
    assert math.isclose(row["ratio"], statistics.stdev([1.0] + [0.0] * 49_999) * 50_000)


def test_gaps_before_the_epoch(spark):
    rows = [("1", "view", -BASE + ms) for ms in (-130_000, -61_000, -60_000, -1, 0, 5)]
    _check_gaps(arrivals.arrival_gaps(ad_events(spark, rows)), rows)


def test_bucket_is_bounded(spark):
    with pytest.raises(ValueError):
        arrivals.arrival_gaps(ad_events(spark, [("1", "view", 0)]), bucket="1 hour")


def _bursts(rows, seconds, threshold):
    counts = Counter((BASE + ms) // (seconds * 1000) for _, _, ms in rows)
    spanned = range(min(counts), max(counts) + 1)
    mean = len(rows) / len(spanned)
    phases = defaultdict(lambda: [0, 0])
    for bucket in spanned:
        phase = "HIGH" if counts[bucket] > threshold * mean else "LOW"
        phases[phase][0] += 1
        phases[phase][1] += counts[bucket]
    return {p: (b, n, n / (b * seconds)) for p, (b, n) in phases.items()}


@settings(
    max_examples=15,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    rows=event_rows,
    seconds=st.sampled_from([1, 10]),
    threshold=st.sampled_from([0.0, 1.0, 2.0]),
)
def test_bursts(spark, rows, seconds, threshold):
    df = arrivals.burst_profile(ad_events(spark, rows), f"{seconds} seconds", threshold)
    got = {r["phase"]: (r["buckets"], r["events"], r["events_per_second"]) for r in df.collect()}
    assert got == _bursts(rows, seconds, threshold)


def test_on_off_phases(spark):
    """Two seconds at 45 a second, eight at 1.25: a mean of ten, split in two."""
    rows = [("1", "view", s * 1000 + i) for s in (0, 1) for i in range(45)]
    rows += [("1", "view", 2000 + 800 * i) for i in range(10)]
    got = {r["phase"]: r for r in arrivals.burst_profile(ad_events(spark, rows)).collect()}
    assert (got["HIGH"]["buckets"], got["HIGH"]["events_per_second"]) == (2, 45.0)
    assert (got["LOW"]["buckets"], got["LOW"]["events_per_second"]) == (8, 1.25)


def test_no_events(spark):
    nothing = ad_events(spark, [("1", "view", 0)]).filter("false")
    assert arrivals.burst_profile(nothing).count() == 0
    assert arrivals.arrival_gaps(nothing).count() == 0
    assert arrivals.arrival_rate(nothing).count() == 0
    assert tuple(arrivals.event_summary(nothing).first()) == (0, None, None)
    assert tuple(arrivals.overall_rate(nothing).first()) == (0, None, None)


def test_summary_and_rates(spark):
    df = ad_events(spark, [("1", "view", 0), ("1", "view", 500), ("2", "click", 4000)])
    row = arrivals.event_summary(df).select("events", F.unix_millis("last_event_ts")).first()
    assert tuple(row) == (3, BASE + 4000)
    assert tuple(arrivals.overall_rate(df).first()) == (3, 4.0, 0.75)
    rates = arrivals.arrival_rate(df, "2 seconds").select("events", "events_per_second")
    assert sorted(tuple(r) for r in rates.collect()) == [(1, 0.5), (2, 1.0)]


def test_overall_rate_of_one_instant(spark):
    assert arrivals.overall_rate(ad_events(spark, [("1", "view", 0)])).first()[2] is None


@pytest.mark.parametrize(
    "text, micros",
    [("10 seconds", 10_000_000), ("1 Hour", 3_600_000_000), ("5 milliseconds", 5_000)],
)
def test_interval(text, micros):
    assert interval_micros(text) == micros


@pytest.mark.parametrize("text", ["", "ten seconds", "0 seconds", "1 month", "1 hour 2 minutes"])
def test_bad_interval(text):
    with pytest.raises(ValueError):
        interval_micros(text)
