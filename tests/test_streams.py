"""Streams: what is emitted, what is late, what a restart adds."""

import time
from functools import partial
from types import SimpleNamespace

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as contract

from adstream.operators import mapping
from adstream.operators.counts import flatten_window, view_counts, with_watermark
from adstream.plans import ctr_left_join, ctr_one_pass, ctr_smoothed
from adstream.session import STREAM_CONF
from adstream.sources import FileFolder, console, event_table, write_results
from adstream.streaming import ProgressStore, run_available, run_to_table, start
from helpers import BASE, GOLDEN, FileFeed, ad_events, texts

SF = "/root/testdata/sf0.001"

HDFS_STORE = (
    "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
)

FORMS = [ctr_left_join, ctr_one_pass, ctr_smoothed]


@pytest.fixture
def feed(tmp_path):
    return FileFeed(tmp_path / "in")


def _windows(df, *values):
    start_ms = F.unix_millis(F.col("window_start").cast("timestamp")) - BASE
    return sorted(tuple(r) for r in df.select(start_ms, *values).collect())


@pytest.mark.parametrize("form", FORMS)
def test_stream_equals_batch_before_the_watermark(spark, feed, form):
    rows = GOLDEN + [("9", "view", 25000)]
    feed.add(*rows)
    got = run_to_table(form(feed.stream(spark)), spark, "stream")
    start_text = F.col("window_start").cast("timestamp")
    cut = F.unix_millis(start_text) + 10_000 <= BASE + 24_000
    want = form(ad_events(spark, rows)).filter(cut)
    assert texts(got, *got.columns) == texts(want, *want.columns)
    assert got.count() > 0


def test_late_rows(spark, feed, tmp_path):
    for ms in (1000, 32000, 33000, 34000, 1500, 60000):
        feed.add(("1", "view", ms))
    store = ProgressStore(spark, str(tmp_path / "progress"))
    spark.streams.addListener(store)
    counted = flatten_window(view_counts(with_watermark(feed.stream(spark))))
    out = FileFolder(str(tmp_path / "out"))
    query = run_available(counted, out, str(tmp_path / "cp"))
    store.wait()
    spark.streams.removeListener(store)
    got = spark.read.schema(counted.schema).parquet(out.path)
    assert _windows(got, "views") == [(0, 1), (30000, 3)]
    reports = store.rows(query.runId)
    assert reports.agg(F.sum("rows_dropped")).first()[0] == 1
    assert reports.agg(F.sum("input_rows")).first()[0] == 6
    assert reports.filter("sink like 'FileSink%'").count() == reports.count()


def test_a_late_row_counts_in_the_batch_that_closes_its_window(spark, feed):
    feed.add(("1", "view", 1000)).add(("1", "view", 32000)).add(("1", "view", 1500))
    counted = flatten_window(view_counts(with_watermark(feed.stream(spark))))
    assert _windows(run_to_table(counted, spark, "grace"), "views") == [(0, 2)]


def test_what_moves_the_watermark(spark, feed):
    feed.add(("1", "view", 1000), ("1", "click", 2000)).add(("1", "purchase", 41000))
    joined = run_to_table(ctr_left_join(feed.stream(spark)), spark, "join")
    assert joined.count() == 0
    one_pass = run_to_table(ctr_one_pass(feed.stream(spark)), spark, "one")
    assert _windows(one_pass, "views", "clicks") == [(0, 1, 1)]


@pytest.mark.parametrize("form", FORMS)
def test_restart_goes_on_where_it_stopped(spark, feed, tmp_path, form):
    rows = [("1", "view", s * 1000) for s in range(0, 100, 3)]
    rows += [("1", "click", s * 1000 + 500) for s in range(0, 100, 7)]
    rows.sort(key=lambda r: r[2])
    out = FileFolder(str(tmp_path / "out"))

    def run():
        df = form(feed.stream(spark))
        run_available(df, out, str(tmp_path / "checkpoint"))
        return spark.read.schema(df.schema).parquet(out.path)

    for i in range(0, len(rows) // 2, 8):
        feed.add(*rows[i : i + 8])
    first = run().count()
    assert first > 0
    assert run().count() == first
    for i in range(feed.count * 8, len(rows), 8):
        feed.add(*rows[i : i + 8])
    got = run()
    start_ms = F.unix_millis(F.col("window_start").cast("timestamp"))
    last = max(r[2] for r in rows)
    want = form(ad_events(spark, rows)).filter(start_ms + 10_000 <= BASE + last - 1000)
    assert got.count() > first
    assert texts(got, *got.columns) == texts(want, *want.columns)


def test_default_state_store(spark, feed):
    """The tests' session keeps state in RocksDB; Spark's default must do as well."""
    feed.add(*GOLDEN).add(("9", "view", 25000))
    kept = {key: spark.conf.get(key) for key in STREAM_CONF}
    assert kept == STREAM_CONF
    for key in STREAM_CONF:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", HDFS_STORE)
    spark.conf.set("spark.sql.streaming.join.stateFormatVersion", "2")
    try:
        got = run_to_table(ctr_left_join(feed.stream(spark)), spark, "default")
        assert got.count() == 5
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)


def test_stream_static_lookup(spark, feed):
    feed.add(("1", "view", 1000), ("2", "view", 2000), ("3", "view", 3000))
    stream = feed.stream(spark).drop("campaign_id").withColumn("ad_id", F.lit("a"))
    stream = stream.withColumn("user_id", F.lit("u"))
    table = spark.createDataFrame([("a", 5), ("b", 6)], "ad_id string, campaign_id int")
    for salts in (1, 3):
        joined = mapping.enrich_campaign(stream, table, salts).select("event_time", "campaign_id")
        got = run_to_table(joined, spark, "lookup")
        assert texts(got, "campaign_id") == [("5",)] * 3


def test_continuous_query(spark, feed, tmp_path):
    feed.add(("1", "view", 1000)).add(("1", "view", 32000))
    df = ctr_one_pass(feed.stream(spark))
    out = FileFolder(str(tmp_path / "out"))
    query = start(df, out, str(tmp_path / "cp"), interval="100 milliseconds")
    query.processAllAvailable()
    query.stop()
    rows = spark.read.schema(df.schema).parquet(out.path)
    assert _windows(rows, "views") == [(0, 1)]


def test_streaming_write_needs_a_checkpoint(spark, feed, tmp_path):
    feed.add(("1", "view", 1000))
    with pytest.raises(ValueError):
        write_results(feed.stream(spark), FileFolder(str(tmp_path / "x")))


def test_write_results_starts_a_query(spark, feed, tmp_path):
    feed.add(("1", "view", 1000))
    out = FileFolder(str(tmp_path / "x"))
    df = feed.stream(spark).select("event_type")
    query = write_results(df, out, str(tmp_path / "cp"))
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(out.path).count() == 1


def test_console(spark, feed, tmp_path):
    feed.add(("1", "view", 1000))
    writer = console(feed.stream(spark), str(tmp_path / "cp"))
    query = writer.trigger(availableNow=True).start()
    assert query.awaitTermination(60)


def test_progress_store_of_two_queries(spark, feed, tmp_path):
    feed.add(("1", "view", 1000)).add(("1", "view", 32000))
    store = ProgressStore(spark, str(tmp_path / "progress"), seconds=0.1)
    spark.streams.addListener(store)
    out = [FileFolder(str(tmp_path / f"out{i}")) for i in range(2)]
    queries = [
        start(ctr_one_pass(feed.stream(spark)), out[i], str(tmp_path / f"cp{i}"))
        for i in range(2)
    ]
    for query in queries:
        query.processAllAvailable()
        query.stop()
    store.wait()
    spark.streams.removeListener(store)
    for query in queries:
        assert store.rows(query.runId).agg(F.sum("input_rows")).first()[0] == 2


def test_state_of_the_forms(spark, feed, tmp_path):
    """One pass keeps one state per shuffle partition, the join form three."""
    feed.add(*GOLDEN)
    for form, operators in ((ctr_one_pass, 1), (ctr_smoothed, 1), (ctr_left_join, 3)):
        out = FileFolder(str(tmp_path / form.__name__))
        query = run_available(form(feed.stream(spark)), out, f"{out.path}-cp")
        assert len(query.lastProgress.stateOperators) == operators


def test_progress_store_tells_of_a_failed_write(spark, tmp_path, feed):
    blocked = tmp_path / "file"
    blocked.write_text("")
    store = ProgressStore(spark, str(blocked / "below"), seconds=0.1)
    spark.streams.addListener(store)
    feed.add(("1", "view", 1000))
    run_to_table(ctr_one_pass(feed.stream(spark)), spark, "blocked")
    with pytest.raises(Exception):
        store.wait()
    spark.streams.removeListener(store)


def test_progress_store_is_bounded_and_waits_no_longer_than_asked(spark, tmp_path):
    store = ProgressStore(spark, str(tmp_path / "x"), seconds=60, most=1)
    store._running.add("never ends")
    with pytest.raises(TimeoutError):
        store.wait(0.1)
    for _ in range(2):
        store.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(json="{}")))
    with pytest.raises(RuntimeError):
        store.wait()


@pytest.fixture
def plain(spark):
    """A session without this package's settings."""
    made = spark.newSession()
    made.conf.set("spark.sql.session.timeZone", "UTC")
    made.conf.set("spark.sql.streaming.stateStore.providerClass", HDFS_STORE)
    made.conf.set("spark.sql.streaming.join.stateFormatVersion", "2")
    made.conf.set("spark.sql.shuffle.partitions", "200")
    return made


def test_state_settings_hold_whatever_the_session(plain, feed, tmp_path):
    feed.add(*GOLDEN).add(("9", "view", 25000))
    before = plain.conf.getAll
    out = FileFolder(str(tmp_path / "out"))
    query = run_available(ctr_left_join(feed.stream(plain)), out, str(tmp_path / "cp"), 2)
    operators = query.lastProgress.stateOperators
    assert all("rocksdbCommitFlushLatency" in o.customMetrics for o in operators)
    assert {o.numShufflePartitions for o in operators} == {2}
    assert plain.conf.getAll == before


STREAMED = [n for n in contract.queries() if n.startswith("stream_")] + ["progress_rows"]
# These make batches of their own.
OWN_BATCHES = (
    "stream_restart", "stream_results_once", "stream_late_rows", "stream_late_events", "progress_rows",
)
PLAIN = [n for n in STREAMED if n not in OWN_BATCHES]


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("parts")
    table = spark.read.parquet(f"{SF}/events.parquet")
    for k in range(4):
        ranked = table.withColumn("k", F.ntile(4).over(Window.orderBy("ts")))
        ranked.where(F.col("k") == k + 1).drop("k").coalesce(1).write.mode("append").parquet(
            str(folder / "events.parquet")
        )
        time.sleep(0.05)
    return str(folder)


@pytest.mark.parametrize("name", PLAIN)
def test_streams_over_a_folder_of_files_in_several_batches(spark, parts, name, monkeypatch):
    bounded = partial(event_table.stream_table, files_per_batch=1)
    monkeypatch.setattr(event_table, "stream_table", bounded)
    got = contract.queries()[name](spark, parts)
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{SF}/events.parquet'")
    rel = con.sql(contract.oracle_sql()[name])
    order = sorted(rel.columns)
    mine = sorted(str(tuple(r[c] for c in order)) for r in got.collect())
    columns = [rel.columns.index(c) for c in order]
    assert mine == sorted(str(tuple(r[k] for k in columns)) for r in rel.fetchall())


def test_a_bounded_stream_takes_several_batches(spark, parts, tmp_path):
    stream = event_table.stream_table(spark, parts, files_per_batch=1)
    query = run_available(stream, FileFolder(str(tmp_path / "out")), str(tmp_path / "cp"))
    assert query.lastProgress.batchId == 3
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1000


def test_reports_carry_the_time_of_a_clock(spark, feed, tmp_path):
    feed.add(("1", "view", 1000)).add(("1", "view", 32000))
    store = ProgressStore(
        spark, str(tmp_path / "reports"), clock=lambda r: f"2030-01-01T00:00:0{r['batchId']}.000Z"
    )
    spark.streams.addListener(store)
    try:
        rates = ctr_one_pass(feed.stream(spark))
        query = run_available(rates, FileFolder(str(tmp_path / "out")), str(tmp_path / "cp"))
        store.wait()
    finally:
        spark.streams.removeListener(store)
    rows = store.rows(query.runId).orderBy("batch_id").collect()
    assert [r.timestamp[18] for r in rows] == ["0", "1", "2"]
