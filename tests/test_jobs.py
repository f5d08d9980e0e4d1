"""The jobs end to end, over folders in place of topics."""

import json

import pytest
from pyspark.sql import functions as F

from adstream.__main__ import main
from adstream.schemas import ENVELOPE
from adstream.sources import FileFolder, KafkaTopic, endpoint, read_latencies
from helpers import BASE, GOLDEN, ad_events, envelopes, payload

ROWS = GOLDEN + [("9", "view", 25000)]


@pytest.fixture
def topic(spark, tmp_path):
    rows = []
    for key, kind, ms in ROWS:
        more = {"campaign_id": key and int(key), "production_timestamp": BASE + ms + 0.25}
        rows.append((key, json.dumps(payload(kind, ms, **more)), ms))
    envelopes(spark, rows).write.parquet(str(tmp_path / "topic"))
    return str(tmp_path / "topic")


@pytest.mark.parametrize("form, expected", [("left-join", 5), ("one-pass", 5), ("smoothed", 7)])
def test_from_events_to_latency(spark, tmp_path, topic, form, expected):
    where = {n: str(tmp_path / n) for n in ("results", "cp", "log", "topic2", "lat", "avg", "lag")}
    stream = ["ctr", "--source", topic, "--sink", where["results"], "--form", form]
    stream += ["--checkpoint", where["cp"], "--available-now"]
    stream += ["--partitions", "2", "--progress", where["log"]]
    main(stream, spark)
    written = spark.read.parquet(where["results"])
    assert written.count() == expected
    main(["watermark-lag", where["log"], "--out", where["lag"]], spark)
    assert spark.read.parquet(where["lag"]).count() >= 1

    # What a topic adds to the records.
    key = F.col("key") if "key" in written.columns else F.lit(None).cast("string")
    written.select(
        key.cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit("results").alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("offset"),
        F.timestamp_millis(F.lit(BASE + 30000)).alias("timestamp"),
        F.lit(1).alias("timestampType"),
    ).write.parquet(where["topic2"])
    assert spark.read.parquet(where["topic2"]).columns == ENVELOPE.fieldNames()

    measured = ["measure", "--results", where["topic2"], "--form", form]
    main(measured + ["--out", where["lat"], "--run-id", "r1"], spark)
    samples = read_latencies(spark, where["lat"])
    assert samples.count() == expected
    # The latest events of the two windows are at 9000 and at 13000; where clicks of
    # no campaign do not count, the first still ends with a view.
    assert {r["latency_ms"] for r in samples.collect()} == {21000.0, 17000.0}
    main(["average", where["lat"], "--out", where["avg"]], spark)
    assert spark.read.parquet(where["avg"]).first()["samples"] == expected
    main(["average", where["lat"], "--run-id", "r2", "--out", where["avg"] + "2"], spark)
    assert spark.read.parquet(where["avg"] + "2").count() == 0


def test_reports(spark, tmp_path):
    (tmp_path / "curve").write_text("throughput,latency\n2, 5.5\n1, 4.0\n")
    with pytest.raises(SystemExit):
        main(["curve", str(tmp_path / "curve")], spark)
    main(["curve", str(tmp_path / "curve"), "--out", str(tmp_path / "sorted")], spark)
    assert spark.read.parquet(str(tmp_path / "sorted")).count() == 2
    line = "[WM] batch=1 wm=2025-11-20T01:57:28.492Z processing_time=2025-11-20T07:27:30.5 rows=1"
    (tmp_path / "log").write_text(line + "\n")
    main(["watermark-log", str(tmp_path / "log"), "--out", str(tmp_path / "wm")], spark)
    assert spark.read.parquet(str(tmp_path / "wm")).count() == 1
    report = {
        "batchId": 3,
        "timestamp": "2025-11-20T01:57:30.000Z",
        "eventTime": {"watermark": "2025-11-20T01:57:28.500Z"},
    }
    (tmp_path / "reports").write_text(json.dumps(report) + "\n")
    main(["watermark-lag", str(tmp_path / "reports"), "--out", str(tmp_path / "lag")], spark)
    assert spark.read.parquet(str(tmp_path / "lag")).first()["lag_ms"] == 1500


def test_publish(spark, tmp_path):
    ad_events(spark, ROWS).write.parquet(str(tmp_path / "table"))
    main(["publish", "--table", str(tmp_path / "table"), "--sink", str(tmp_path / "out")], spark)
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.count() == len(ROWS)
    assert rows.filter(F.col("key").cast("string") == "1").count() == 4


def test_endpoints():
    assert endpoint("kafka://a:1,b:2/ads") == KafkaTopic("a:1,b:2", "ads")
    assert endpoint("/data/ads") == FileFolder("/data/ads")
    with pytest.raises(ValueError):
        endpoint("kafka://a:1")
