"""Endpoints, the mapping table, log lines and the shared folder."""

import pytest
from pyspark.sql import functions as F

from adstream import session
from adstream.operators import mapping, progress
from adstream.schemas import MAPPING
from adstream.sources import FileFolder, JdbcTable, KafkaTopic, read_lines, write_mapping
from helpers import texts


def test_kafka_stream_options():
    topic = KafkaTopic("host:9092", "ad-events", group_id="g", max_offsets_per_trigger=500)
    assert topic.read_options() == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "ad-events",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "kafka.group.id": "g",
        "maxOffsetsPerTrigger": "500",
    }


def test_kafka_bounded_read_covers_the_topic():
    options = KafkaTopic("host:9092", "results", min_partitions=64).read_options(streaming=False)
    assert (options["startingOffsets"], options["endingOffsets"]) == ("earliest", "latest")
    assert options["minPartitions"] == "64"
    assert "maxOffsetsPerTrigger" not in options


def test_kafka_write_options():
    topic = KafkaTopic("host:9092", "results", extra={"kafka.linger.ms": "5"})
    assert topic.write_options() == {
        "kafka.bootstrap.servers": "host:9092",
        "topic": "results",
        "kafka.linger.ms": "5",
    }


def test_jdbc_options():
    table = JdbcTable("jdbc:postgresql://host/ads", "mappings", "org.postgresql.Driver")
    assert table.write_options() == {
        "url": "jdbc:postgresql://host/ads",
        "dbtable": "mappings",
        "truncate": "true",
        "driver": "org.postgresql.Driver",
    }


def test_mapping_is_replaced(spark, tmp_path):
    sink = FileFolder(str(tmp_path / "mapping"))
    ads = spark.createDataFrame(
        [("a", 0), ("b", 99), ("c", 100), ("d", 950)], "ad_id string, ad_index bigint"
    )
    write_mapping(mapping.campaign_mapping(ads.filter("ad_id = 'a'")), sink)
    write_mapping(mapping.campaign_mapping(ads), sink)
    back = spark.read.parquet(sink.path)
    assert [f.dataType for f in back.schema] == [f.dataType for f in MAPPING]
    assert texts(back, "ad_id", "campaign_id") == [
        ("a", "0"),
        ("b", "0"),
        ("c", "1"),
        ("d", "9"),
    ]
    assert mapping.campaign_mapping(ads, 50).filter("campaign_id = 19").count() == 1


def test_lookup_drops_unknown_ads_and_salts_change_nothing(spark):
    events = spark.range(200).select(
        F.when(F.col("id") < 150, "hot").otherwise(F.concat(F.lit("ad"), "id")).alias("ad_id"),
        F.col("id").cast("string").alias("user_id"),
        F.col("id").alias("event_time"),
        F.lit("view").alias("event_type"),
    )
    table = spark.createDataFrame([("hot", 1), ("ad199", 2)], MAPPING)
    plain = mapping.enrich_campaign(events, table)
    salted = mapping.enrich_campaign(events, table, salts=4)
    assert plain.count() == 151
    assert plain.columns == salted.columns
    assert texts(plain, *plain.columns) == texts(salted, *plain.columns)


# Log lines as the watermark reports print them.
LOG = """[WM] batch=3 wm=2025-11-20T01:57:28.492Z processing_time=2025-11-20T07:27:30.123456 rows=10
[SINK] KafkaTopic(results)
[WM] batch=4 wm=not-a-time processing_time=2025-11-20T07:27:31.000001 rows=10
[WM] batch=5 wm=2025-11-20T99:57:28.492Z processing_time=2025-11-20T07:27:31.000001 rows=1
[Query Latency] 1630.00 ms
[WM] batch=6 wm=2025-11-20T01:57:38.000Z processing_time=2025-11-20T07:27:40.5 rows=0
"""


def test_watermark_log(spark, tmp_path):
    (tmp_path / "log").write_text(LOG)
    table = progress.watermark_log(read_lines(spark, str(tmp_path / "log")))
    assert table.dtypes == [("watermark", "timestamp"), ("processing_time", "timestamp_ntz")]
    assert texts(table, *table.columns) == [
        ("2025-11-20 01:57:28.492", "2025-11-20 07:27:30.123456"),
        ("2025-11-20 01:57:38", "2025-11-20 07:27:40.5"),
    ]


REPORTS = [
    '{"runId":"r","batchId":0,"timestamp":"2025-11-20T01:57:30.123Z","numInputRows":7,'
    '"eventTime":{"watermark":"1970-01-01T00:00:00.000Z"},"stateOperators":[]}',
    '{"runId":"r","batchId":1,"timestamp":"2025-11-20T01:57:30.123Z","numInputRows":5,'
    '"eventTime":{"watermark":"2025-11-20T01:57:28.492Z"},"stateOperators":'
    '[{"numRowsDroppedByWatermark":2},{"numRowsDroppedByWatermark":1}],'
    '"sink":{"description":"topic"}}',
    '{"runId":"r","batchId":2,"timestamp":"2025-11-20T01:57:31.000Z","numInputRows":0,'
    '"eventTime":{}}',
]


@pytest.fixture
def reports(spark):
    return progress.progress_rows(spark.createDataFrame([(r,) for r in REPORTS], "value string"))


def test_progress_rows(reports):
    got = reports.orderBy("batch_id").select("batch_id", "input_rows", "rows_dropped", "sink")
    assert [tuple(r) for r in got.collect()] == [
        (0, 7, 0, None),
        (1, 5, 3, "topic"),
        (2, 0, 0, None),
    ]


def test_watermark_lag(reports):
    got = progress.watermark_lag(reports).collect()
    assert [(r["batch_id"], r["lag_ms"]) for r in got] == [(1, 1631)]


def test_watermark_lines_read_back(reports):
    lines = progress.watermark_lines(reports)
    assert lines.count() == 4
    assert progress.watermark_log(lines).count() == 2


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = session.shared_folder(spark, "x"), session.shared_folder(spark, "x")
    assert one.startswith(base) and one != two


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_state_width_follows_the_cluster(spark):
    assert session.state_width(spark) == spark.sparkContext.defaultParallelism == 8
    assert session.state_width(spark, 3) == 24


def test_own_session_leaves_the_other_alone(spark):
    before = spark.conf.getAll
    own = session.own_session(spark, session__timeZone="Asia/Tokyo", shuffle__partitions="7")
    assert own.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    assert own.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert spark.conf.getAll == before


def test_mapping_is_replaced_as_a_whole(spark, tmp_path):
    sink = FileFolder(str(tmp_path / "mapping"))
    one = spark.createDataFrame([("a", 1), ("b", 2)], MAPPING)
    write_mapping(one, sink)
    write_mapping(one.limit(1), sink)
    assert spark.read.parquet(sink.path).count() == 1
    broken = one.withColumn("campaign_id", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception):
        write_mapping(broken, sink)
    assert spark.read.parquet(sink.path).count() == 1


def test_campaigns_of_large_indexes(spark):
    ads = spark.createDataFrame([("a", 90071992547409999 % 199_999_999_999), ("b", -1), ("c", 199)], "ad_id string, ad_index long")
    got = {r.ad_id: r.campaign_id for r in mapping.campaign_mapping(ads).collect()}
    assert got == {"a": 90071992547409999 % 199_999_999_999 // 100, "b": -1, "c": 1}
