"""Latency of results, samples and curves."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adstream.operators import latency
from adstream.plans import ctr_left_join, ctr_smoothed, reports
from adstream.schemas import CTR_RESULT, LATENCY_CURVE, SMOOTHED_RESULT
from adstream.sources import read_latencies, read_latency_curve, write_latency
from helpers import BASE, GOLDEN, ad_events


def _ts(ms):
    return datetime.fromtimestamp(BASE / 1000, timezone.utc) + timedelta(milliseconds=ms)


def _appended(schema):
    return T.StructType(schema.fields + [T.StructField("append_ts", T.TimestampType())])


def _results(spark, rows):
    """Rows of (campaign, window start, latest record, append), in ms."""
    made = [
        (c, _ts(start), _ts(start + 10000), 1, 0, 0.0, _ts(latest), _ts(appended))
        for c, start, latest, appended in rows
    ]
    return spark.createDataFrame(made, _appended(CTR_RESULT))


def test_latency_is_from_the_latest_record_of_the_window(spark):
    results = _results(
        spark,
        [("1", 0, 9000, 12000), ("2", 0, 9500, 12010), ("1", 10000, 11000, 23000)],
    )
    got = {
        (r["campaign_id"], r["latency_ms"]) for r in latency.window_latency(results).collect()
    }
    assert got == {("1", 2500), ("2", 2510), ("1", 12000)}


def test_repeated_records_count_once_with_their_earliest_append(spark):
    results = _results(
        spark, [("1", 0, 9000, 13000), ("1", 0, 9000, 12000), (None, 0, 8000, 12500)]
    )
    got = sorted(r["latency_ms"] for r in latency.window_latency(results).collect())
    assert got == [3000, 3500]


def test_latencies_of_a_window_share_one_maximum(spark):
    ctr = ctr_left_join(ad_events(spark, GOLDEN))
    results = ctr.withColumn("append_ts", F.col("window_end") + F.expr("INTERVAL 2 SECONDS"))
    spread = (
        latency.window_latency(results)
        .withColumn("base", F.unix_millis("append_ts") - F.col("latency_ms"))
        .groupBy("window_start")
        .agg(F.count_distinct("base").alias("n"))
    )
    assert {r["n"] for r in spread.collect()} == {1}


def test_smoothed_latency(spark):
    made = [
        ("2025-11-20 00:00:00.000", 1, 0, 1, 0.0, BASE + 9000, _ts(12000)),
        ("2025-11-20 00:00:00.000", 2, 0, 1, 0.0, BASE + 9700, _ts(12000)),
    ]
    results = spark.createDataFrame(made, _appended(SMOOTHED_RESULT))
    got = latency.window_latency_smoothed(results).select("latency_ms").collect()
    assert [r[0] for r in got] == [2300, 2300]


def test_smoothed_results_as_records(spark):
    ctr = ctr_smoothed(ad_events(spark, GOLDEN))
    row = reports.appended_results(ctr, F.timestamp_millis(F.lit(BASE))).first()
    assert row["key"] is None and bytes(row["value"]).startswith(b'{"window_start"')


def test_average(spark, tmp_path):
    (tmp_path / "samples").write_text("958\n\n  959 \n962\n\n")
    row = latency.latency_average(read_latencies(spark, str(tmp_path / "samples"))).first()
    assert (row["samples"], row["mean_latency_ms"]) == (3, (958 + 959 + 962) / 3)


def test_average_of_nothing(spark, tmp_path):
    (tmp_path / "samples").write_text("\n \n")
    row = latency.latency_average(read_latencies(spark, str(tmp_path / "samples"))).first()
    assert (row["samples"], row["mean_latency_ms"]) == (0, None)


def test_a_bad_number_is_an_error(spark, tmp_path):
    (tmp_path / "samples").write_text("12\ntwelve\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_latencies(spark, str(tmp_path / "samples")).collect()


def test_runs_are_appended_and_stay_apart(spark, tmp_path):
    path = str(tmp_path / "runs")
    write_latency(spark.createDataFrame([(1,), (3,)], "latency_ms bigint"), path, "a")
    write_latency(spark.createDataFrame([(5,)], "latency_ms bigint"), path, "b")
    samples = read_latencies(spark, path)
    assert samples.count() == 3
    only = latency.latency_average(samples.filter("run_id = 'a'")).first()
    assert only["mean_latency_ms"] == 2.0


def test_curve(spark, tmp_path):
    # A recorded curve, with a blank after the comma and unsorted.
    text = "throughput,latency\n40000, 1506.13\n20000, 1323.8\n60000, 3584.47"
    (tmp_path / "curve").write_text(text)
    curve = read_latency_curve(spark, str(tmp_path / "curve"))
    assert curve.schema == LATENCY_CURVE
    assert [tuple(r) for r in latency.latency_curve(curve).collect()] == [
        (20000, 1323.8),
        (40000, 1506.13),
        (60000, 3584.47),
    ]


def test_curve_keeps_every_point_and_its_mean_is_apart(spark):
    rows = [(10, 3.0), (20, 5.0), (10, 1.0)]
    curve = spark.createDataFrame(rows, LATENCY_CURVE)
    assert [tuple(r) for r in latency.latency_curve(curve).collect()] == sorted(rows)
    mean = latency.mean_by_throughput(curve).collect()
    assert sorted(tuple(r) for r in mean) == [(10, 2.0), (20, 5.0)]


def test_repeats_go_and_other_records_stay_without_sorting(spark):
    made = [("1", _ts(0), _ts(10_000), 1, 0, 0.0, _ts(9000), _ts(12_000 + late)) for late in (0, 5000)]
    made.append(("1", _ts(0), _ts(10_000), 2, 0, 0.0, _ts(9500), _ts(13_000)))
    got = latency.window_latency(spark.createDataFrame(made, _appended(CTR_RESULT)))
    assert sorted(r["latency_ms"] for r in got.collect()) == [2500, 3500]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_mean_of_each_run(spark):
    runs = {"a": [(1,), (3,)], "b": [(5,)]}
    frames = {k: spark.createDataFrame(v, "latency_ms bigint") for k, v in runs.items()}
    got = reports.average_of_runs(spark, frames).collect()
    assert sorted((r.run_id, r.samples, r.mean_latency_ms) for r in got) == [("a", 2, 2.0), ("b", 1, 5.0)]


def test_a_run_written_again_takes_the_place_of_its_samples(spark, tmp_path):
    path = str(tmp_path / "samples")
    samples = spark.createDataFrame([(1,), (3,)], "latency_ms bigint")
    for run in ("a", "b", "a"):
        write_latency(samples, path, run)
    write_latency(samples.limit(1), path, "b")
    counts = read_latencies(spark, path).groupBy("run_id").count().collect()
    assert {r["run_id"]: r["count"] for r in counts} == {"a": 2, "b": 1}
