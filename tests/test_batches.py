"""Micro-batches delivered once, mappings that are replaced, late events, idle partitions."""

import os
import time

import pytest
from pyspark.sql import functions as F

from adstream.operators.counts import flatten_window, view_counts, with_watermark
from adstream.operators.mapping import enrich_campaign
from adstream.plans import ctr_left_join, ctr_one_pass
from adstream.schemas import ENVELOPE, MAPPING
from adstream.sources import (
    FileFolder,
    KafkaTopic,
    VersionedFolder,
    drop_old,
    files,
    newest,
    read_events,
    read_partitions,
    read_version,
    versions,
    write_mapping,
)
from adstream.streaming import (
    IdleWatch,
    count_late,
    drop_repeated,
    late_events,
    open_windows,
    read_once,
    run_available,
    state_operators,
    with_newest,
    with_partition_watermarks,
    write_once,
)
from helpers import BASE, FileFeed, texts


@pytest.fixture
def feed(tmp_path):
    return FileFeed(tmp_path / "in")


def lost_commit(spark, checkpoint):
    """Take back the newest commit, as if the query had died before it."""
    last = max(files.matching(spark, f"{checkpoint}/commits/*"), key=lambda p: int(p.rsplit("/", 1)[1]))
    files.remove(spark, last)
    return int(last.rsplit("/", 1)[1])


def test_a_batch_run_again_is_there_once(spark, feed, tmp_path):
    out, checkpoint = FileFolder(str(tmp_path / "out")), str(tmp_path / "cp")
    changes = []

    def change(rows, query, batch):
        changes.append(batch)
        return rows

    for ms in (1000, 12000, 25000, 41000):
        feed.add(("1", "view", ms))
        for _ in range(2):
            counted = flatten_window(view_counts(with_watermark(feed.stream(spark))))
            write_once(counted, out, checkpoint, change=change).awaitTermination()
            lost_commit(spark, checkpoint)
    got = read_once(spark, out)
    assert texts(got, "views") == [("1",)] * 3
    assert got.select("query").distinct().count() == 1
    assert len(changes) == len(set(changes))


def test_a_half_written_batch_is_written_again(spark, feed, tmp_path):
    out, checkpoint = FileFolder(str(tmp_path / "out")), str(tmp_path / "cp")
    feed.add(("1", "view", 1000), ("2", "view", 2000))
    rows = feed.stream(spark).select("campaign_id")
    write_once(rows, out, checkpoint).awaitTermination()
    assert read_once(spark, out).count() == 2
    batch = lost_commit(spark, checkpoint)
    (mark,) = files.matching(spark, f"{out.path}/query=*/batch={batch}/_SUCCESS")
    files.remove(spark, mark)
    with pytest.raises(FileNotFoundError):
        read_once(spark, out)
    write_once(feed.stream(spark).select("campaign_id"), out, checkpoint).awaitTermination()
    assert texts(read_once(spark, out), "campaign_id", "batch") == [("1", "0"), ("2", "0")]


def test_two_queries_share_a_folder(spark, feed, tmp_path):
    out = FileFolder(str(tmp_path / "out"), schema="campaign_id string")
    feed.add(("1", "view", 1000))
    for k in range(2):
        write_once(feed.stream(spark).select("campaign_id"), out, str(tmp_path / f"cp{k}")).awaitTermination()
    got = read_once(spark, out)
    assert got.count() == 2
    one = got.first()["query"]
    assert read_once(spark, out, one).count() == 1


def test_records_repeated_by_a_batch_are_dropped(spark):
    def row(key, batch, offset, second):
        headers = [("query", bytearray(b"q")), ("batch", bytearray(str(batch).encode()))]
        return (bytearray(key), bytearray(b"v"), "results", 0, offset, second, 0, headers)

    schema = "key binary, value binary, topic string, partition int, offset long, ts long, timestampType int, headers array<struct<key: string, value: binary>>"
    rows = [row(b"1", 0, 0, 10), row(b"1", 0, 7, 20), row(b"1", 1, 8, 21), row(b"2", 0, 1, 10)]
    records = spark.createDataFrame(rows, schema).withColumn("timestamp", F.timestamp_seconds("ts")).drop("ts")
    got = drop_repeated(records)
    assert set(got.columns) == set(records.columns)
    assert sorted(r.offset for r in got.collect()) == [0, 1, 8]
    with pytest.raises(ValueError):
        write_once(records, KafkaTopic("host:9092", "results"), "nowhere")


def test_one_partition_of_a_source():
    topic = KafkaTopic("host:9092", "ad-events", headers=True).only(3)
    options = topic.read_options()
    assert options["assign"] == '{"ad-events": [3]}' and options["includeHeaders"] == "true"
    assert "subscribe" not in options and topic.topic == "ad-events"
    assert FileFolder("/x/").only(2).path == "/x/partition=2"


def test_versions_outlive_those_who_read_them(spark, tmp_path):
    folder = VersionedFolder(str(tmp_path / "mapping"))
    with pytest.raises(FileNotFoundError):
        newest(spark, folder)
    one = spark.createDataFrame([("a", 1)], MAPPING)
    write_mapping(one, folder)
    old = read_version(spark, folder)
    write_mapping(one.withColumn("campaign_id", F.lit(2)), folder)
    assert old.first()["campaign_id"] == 1 and read_version(spark, folder).first()["campaign_id"] == 2
    assert drop_old(spark, folder) == []  # superseded too short a time ago
    broken = one.withColumn("campaign_id", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception):
        write_mapping(broken, folder)
    assert read_version(spark, folder).first()["campaign_id"] == 2
    assert len(drop_old(spark, folder, hours=0)) == 1 and len(versions(spark, folder)) == 1
    write_mapping(one.withColumn("campaign_id", F.lit(3)), folder)
    assert read_version(spark, folder).first()["campaign_id"] == 3


def test_a_stream_takes_each_new_mapping_and_a_repeated_batch_the_old_one(spark, feed, tmp_path):
    folder = VersionedFolder(str(tmp_path / "mapping"))
    out, checkpoint = FileFolder(str(tmp_path / "out")), str(tmp_path / "cp")
    table = spark.createDataFrame([("1", 10)], MAPPING)

    def run():
        plain = feed.stream(spark).withColumnRenamed("campaign_id", "ad_id").select("ad_id", "event_time")
        change = with_newest(folder, enrich_campaign)
        write_once(plain, out, checkpoint, change=change).awaitTermination()

    write_mapping(table, folder)
    feed.add(("1", "view", 1000))
    run()
    batch = lost_commit(spark, checkpoint)
    (mark,) = files.matching(spark, f"{out.path}/query=*/batch={batch}/_SUCCESS")
    files.remove(spark, mark)
    write_mapping(table.withColumn("campaign_id", F.lit(20)), folder)
    assert drop_old(spark, folder, hours=0) == []  # the batch holds it
    run()
    assert texts(read_once(spark, out), "campaign_id") == [("10",)]
    feed.add(("1", "view", 2000))
    run()
    assert texts(read_once(spark, out), "campaign_id") == [("10",), ("20",)]
    assert len(drop_old(spark, folder, hours=0)) == 1


def test_a_running_lookup_goes_on_when_the_mapping_is_replaced(spark, feed, tmp_path):
    """One version for the life of a query: its files stay where they are."""
    folder = VersionedFolder(str(tmp_path / "mapping"))
    table = spark.createDataFrame([("1", 10)], MAPPING)
    write_mapping(table, folder)
    plain = feed.stream(spark).withColumnRenamed("campaign_id", "ad_id").select("ad_id", "event_time")
    joined = enrich_campaign(plain, read_version(spark, folder))
    feed.add(("1", "view", 1000))
    query = joined.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "cp")
    ).start()
    try:
        query.processAllAvailable()
        write_mapping(table.withColumn("campaign_id", F.lit(20)), folder)
        drop_old(spark, folder)
        feed.add(("1", "view", 2000))
        query.processAllAvailable()
    finally:
        query.stop()
    assert query.exception() is None
    assert texts(spark.read.parquet(str(tmp_path / "out")), "campaign_id") == [("10",)] * 2


def test_late_events_are_counted_one_by_one(spark, feed, tmp_path):
    sink, checkpoint = FileFolder(str(tmp_path / "late")), str(tmp_path / "cp")
    feed.add(("1", "view", 1000), ("1", "view", 32000))
    feed.add(*[("1", "view", 1500)] * 3, ("2", "click", 31999), (None, "view", 2000))
    feed.add(("1", "view", 60000))
    feed.add(("1", "view", 39000), ("1", "view", 31000), ("1", "view", 60001))
    count_late(feed.stream(spark), sink, checkpoint).awaitTermination()
    lost_commit(spark, checkpoint)
    count_late(feed.stream(spark), sink, checkpoint).awaitTermination()
    rows = late_events(spark, sink).orderBy("batch_id").collect()
    assert [(r.batch_id, r.input_rows, r.late_events, r.late_so_far) for r in rows] == [
        (0, 2, 0, 0), (1, 5, 4, 4), (2, 1, 0, 4), (3, 3, 2, 6),
    ]
    marks = [r[0] for r in late_events(spark, sink).orderBy("batch_id").select(F.unix_millis("watermark")).collect()]
    assert marks == [0, BASE + 31000, BASE + 31000, BASE + 59000]


def test_open_windows_and_what_was_given_out(spark, feed, tmp_path):
    feed.add(("1", "view", 1000), ("1", "click", 2000), ("2", "click", 13000), ("1", "view", 25000))
    rates = ctr_one_pass(feed.stream(spark))
    run_available(rates, FileFolder(str(tmp_path / "out")), str(tmp_path / "cp"))
    held = open_windows(spark, str(tmp_path / "cp"), ["views", "clicks", "latest"])
    start = (F.unix_millis("window_start") - BASE).alias("start")
    assert [tuple(r) for r in held.select("campaign_id", start, "views", "clicks").collect()] == [("1", 20000, 1, 0)]
    assert held.columns == ["campaign_id", "window_start", "window_end", "views", "clicks", "latest"]
    with pytest.raises(ValueError):
        open_windows(spark, str(tmp_path / "cp"), ["views"])
    early = open_windows(spark, str(tmp_path / "cp"), ["views", "clicks", "latest"], batch=0)
    assert early.count() == 3


def test_open_windows_of_the_join_form(spark, feed, tmp_path):
    feed.add(("1", "view", 1000), ("1", "click", 22000), ("1", "view", 25000))
    rates = ctr_left_join(feed.stream(spark))
    run_available(rates, FileFolder(str(tmp_path / "out")), str(tmp_path / "cp"))
    kinds = state_operators(spark, str(tmp_path / "cp")).where("operatorName = 'stateStoreSave'")
    sums = [
        open_windows(spark, str(tmp_path / "cp"), ["events", "latest"], operator=r.operatorId).count()
        for r in kinds.collect()
    ]
    assert sums == [1, 1]


def parts_of(spark, path):
    source = FileFolder(path, schema="campaign_id string, event_type string, event_ts timestamp, kafka_ts timestamp")
    return read_partitions(spark, source, [0, 1])


def add_part(spark, path, *rows):
    """Rows of (partition, second)."""
    made = spark.createDataFrame([(p, "1", "view", s) for p, s in rows], "partition int, campaign_id string, event_type string, s long")
    at = F.timestamp_seconds(F.col("s") + BASE // 1000)
    made = made.withColumn("event_ts", at).withColumn("kafka_ts", at).drop("s")
    made.write.mode("append").partitionBy("partition").parquet(path)


def views(spark, path):
    got = spark.read.parquet(path)
    start = F.unix_seconds("window_start") - BASE // 1000
    return sorted(tuple(r) for r in got.groupBy(start).agg(F.sum("views")).collect())


def test_a_lagging_partition_loses_nothing(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    for slice_ in ([(0, 5), (0, 45), (1, 1)], [(0, 95), (1, 6), (1, 44)], [(0, 96), (1, 61), (1, 3)]):
        add_part(spark, source, *slice_)
        rates = ctr_one_pass(with_partition_watermarks(parts_of(spark, source)))
        run_available(rates, FileFolder(str(tmp_path / "out")), checkpoint)
    # The event at second 3 is late: its own partition had gone past it.
    assert views(spark, str(tmp_path / "out")) == [(0, 3), (40, 2)]


def test_an_idle_partition_holds_the_others_no_longer(spark, tmp_path):
    source, out, now = str(tmp_path / "in"), FileFolder(str(tmp_path / "out")), 0.0
    watch = IdleWatch(spark, str(tmp_path / "pulses"), [0, 1], seconds=40, clock=lambda: now)

    def run():
        rates = ctr_one_pass(with_partition_watermarks(parts_of(spark, source), pulses=watch.folder))
        return run_available(rates, out, str(tmp_path / "cp"))

    add_part(spark, source, (0, 1), (1, 2))
    assert watch.step(run()) == {} and watch.idle() == []
    now = 39.0
    add_part(spark, source, (0, 35))
    query = run()
    assert watch.step(query) == {}
    assert files.matching(spark, f"{out.path}/*.parquet") == [] or views(spark, out.path) == []
    now = 50.0
    assert watch.idle() == [1]
    assert list(watch.step(query)) == [1]
    assert watch.step(query) == {}  # given once
    add_part(spark, source, (1, 3))  # too late by then? the pulse comes with it
    run()
    assert views(spark, out.path) == [(0, 3)]
    now = 200.0
    assert watch.idle() == [0, 1] and watch.step(query) == {}


def test_a_watch_follows_a_running_query(spark, tmp_path):
    source, out = str(tmp_path / "in"), FileFolder(str(tmp_path / "out"))
    watch = IdleWatch(spark, str(tmp_path / "pulses"), [0, 1], seconds=1.0)
    add_part(spark, source, (0, 1), (1, 2))
    rates = ctr_one_pass(with_partition_watermarks(parts_of(spark, source), pulses=watch.folder))
    query = rates.writeStream.option("checkpointLocation", str(tmp_path / "cp")).format("parquet").start(out.path)
    thread = watch.start(query, every=0.2)
    try:
        deadline = time.time() + 60
        second = 35
        while time.time() < deadline:
            add_part(spark, source, (0, second))
            second += 1
            if any(f.endswith(".parquet") for f in os.listdir(out.path)) and views(spark, out.path):
                break
            time.sleep(0.3)
        assert views(spark, out.path) == [(0, 2)]
    finally:
        query.stop()
    thread.join(10)
    assert not thread.is_alive()


def test_events_of_a_folder_as_a_stream(spark, tmp_path):
    record = (bytearray(b"1"), bytearray(b'{"event_type": "view"}'), "t", 0, 0, None, 0)
    spark.createDataFrame([record], ENVELOPE).write.parquet(str(tmp_path / "topic"))
    stream = read_events(spark, FileFolder(str(tmp_path / "topic")))
    assert stream.isStreaming and stream.schema == ENVELOPE
    write_once(stream, FileFolder(str(tmp_path / "out")), str(tmp_path / "cp")).awaitTermination()
    assert read_once(spark, FileFolder(str(tmp_path / "out"))).count() == 1
