
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adstream.functions import click_ratio
from adstream.operators import arrivals, counts, events, latency, mapping, progress, records
from adstream.plans import (
    ctr_from_records,
    ctr_left_join,
    ctr_one_pass,
    ctr_smoothed,
    reports,
)
from adstream.schemas import AD_EVENT
from adstream.session import own_session, shared_folder
from adstream.sources import (
    FileFolder,
    VersionedFolder,
    event_table,
    files,
    read_events,
    read_latencies,
    read_lines,
    read_partitions,
    read_results,
    write_latency,
    write_mapping,
    write_results,
)
from adstream.streaming import (
    IdleWatch,
    ProgressStore,
    count_late,
    late_events,
    open_windows,
    read_once,
    run_available,
    run_to_table,
    with_newest,
    with_partition_watermarks,
    write_once,
)

try:
    import corpus_pipeline
    from adstream.llm import queries as llm_queries
except ImportError:  # the training-data subpackage may be left out
    corpus_pipeline = llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]

WINDOWS = {"": "10 seconds", "_1h": "1 hour"}
SECONDS = {"": 10, "_1h": 3600}


# --- inputs ------------------------------------------------------------------


def _table(spark: SparkSession, sf: str) -> DataFrame:
    return event_table.read_table(spark, sf)


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return event_table.ad_events(_table(spark, sf))


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    return event_table.ad_events(event_table.stream_table(spark, sf))


def _envelopes(spark: SparkSession, sf: str) -> DataFrame:
    return event_table.envelopes(_table(spark, sf))


def _envelope_stream(spark: SparkSession, sf: str) -> DataFrame:
    return event_table.envelopes(event_table.stream_table(spark, sf))


def _run(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    return run_to_table(stream, spark, name)


def _mapping_table(spark: SparkSession, sf: str) -> DataFrame:
    """The mapping, written out and read back."""
    sink = FileFolder(shared_folder(spark, "mapping"))
    write_mapping(event_table.mapping(_table(spark, sf)), sink)
    return spark.read.parquet(sink.path)


def _append_ts(end: Column) -> Column:
    """Append time of a result: a second after its window, plus its campaign in ms."""
    return F.timestamp_millis(
        F.unix_millis(end) + 1000 + F.col("campaign_id").cast("bigint")
    )


def _appended(spark: SparkSession, sf: str, length: str = "1 hour") -> DataFrame:
    ctr = ctr_left_join(_events(spark, sf), length)
    return reports.appended_results(ctr, _append_ts(F.col("window_end")))


def _appended_smoothed(spark: SparkSession, sf: str) -> DataFrame:
    ctr = ctr_smoothed(_events(spark, sf), "1 hour")
    end = F.to_timestamp("window_start") + F.expr("INTERVAL 1 HOUR")
    return reports.appended_results(ctr, _append_ts(end))


def _slices(table: DataFrame, parts: int, at: str | Column = "ts") -> list[DataFrame]:
    """The table in parts of equal length of time, from its first to its last row."""
    micros = F.unix_micros((F.col(at) if isinstance(at, str) else at).cast("timestamp"))
    low, high = table.agg(F.min(micros), F.max(micros)).first()
    if low is None:
        return [table]
    length = (high - low) // parts + 1
    return [table.where(F.floor((micros - low) / length) == k) for k in range(parts)]


def _step(spark: SparkSession, part: DataFrame, folder: str, *by: str) -> None:
    """Add a part to the events of a folder that streams read."""
    part.write.mode("append").partitionBy(*by).parquet(f"{folder}/{event_table.FILE}")


SLICES = 5


def _run_progress(spark: SparkSession, sf: str) -> DataFrame:
    """Stored reports of real runs, one for each fifth of the events' time.

    The reports' clock is a second to the batch, counted from the year 2030.
    """
    folder = shared_folder(spark, "run_progress")

    def clock(report: dict) -> str:
        return f"2030-01-01T00:00:{report['batchId']:02d}.000Z"

    spark = own_session(spark, streaming__noDataMicroBatches__enabled="false")
    store = ProgressStore(spark, f"{folder}/reports", clock=clock)
    spark.streams.addListener(store)
    runs = []
    try:
        for part in _slices(_table(spark, sf), SLICES):
            _step(spark, part, folder)
            rates = ctr_one_pass(_event_stream(spark, folder), "1 hour")
            runs.append(run_available(rates, FileFolder(f"{folder}/rows"), f"{folder}/checkpoint"))
        store.wait()
    finally:
        spark.streams.removeListener(store)
    return store.rows().where(F.col("run_id").isin([str(r.runId) for r in runs]))


# --- queries -----------------------------------------------------------------


def _event_records(spark, sf):
    """Records with all fields, decoded, as engines print a DOUBLE differently."""
    keyed = records.event_records(_events(spark, sf))
    text = F.col("value").cast("string")
    return keyed.select(F.col("key").cast("string"), F.inline(F.array(F.from_json(text, AD_EVENT))))


def _spoiled(spark, sf):
    """Records of which those of kind error have a character too many to be parsed."""
    text = F.col("value").cast("string")
    broken = F.when(text.contains('"error"'), F.concat(F.lit("#"), text)).otherwise(text)
    return _envelopes(spark, sf).withColumn("value", broken.cast("binary"))


def _drop_unparsed(spark, sf):
    parsed = events.parse_ad_events(_spoiled(spark, sf))
    return events.drop_unparsed(parsed).drop(events.CORRUPT)


def _corrupt_records(spark, sf):
    """How many records of each campaign did not parse."""
    return (
        events.parse_ad_events(_spoiled(spark, sf))
        .groupBy("campaign_id")
        .agg(
            F.count("*").alias("records"),
            F.count(events.CORRUPT).alias("corrupt_records"),
        )
    )


def _read_results(spark, sf):
    sink = FileFolder(shared_folder(spark, "results"))
    write_results(_appended(spark, sf), sink)
    return read_results(spark, sink)


def _read_results_smoothed(spark, sf):
    sink = FileFolder(shared_folder(spark, "results"))
    write_results(_appended_smoothed(spark, sf), sink)
    return read_results(spark, sink, smoothed=True)


def _window_latency(spark, sf, length="1 hour"):
    return latency.window_latency(records.parse_results(_appended(spark, sf, length)))


def _window_latency_smoothed(spark, sf):
    results = records.parse_smoothed_results(_appended_smoothed(spark, sf))
    return latency.window_latency_smoothed(results)


def _window_latency_repeated(spark, sf):
    """Each record twice, the second time an hour later, and a second run with other times."""
    once = _appended(spark, sf)
    late = F.col("timestamp") + F.expr("INTERVAL 1 HOUR")
    again = once.withColumn("timestamp", late)
    ctr = ctr_left_join(_events(spark, sf), "1 hour")
    shifted = ctr.withColumn("max_kafka_ts", F.col("max_kafka_ts") - F.expr("INTERVAL 1 SECOND"))
    other = reports.appended_results(shifted, _append_ts(F.col("window_end")))
    both = once.unionByName(again).unionByName(other)
    return latency.window_latency(records.parse_results(both))


def _latency_average(spark, sf):
    """Two runs, the second over half the windows' campaigns."""
    first = _window_latency(spark, sf)
    runs = {"run-1": first, "run-2": first.where("campaign_id < '5'")}
    return reports.average_of_runs(spark, runs)


def _latency_curve(spark, sf):
    """Throughput is a window's events per second, in whole events."""
    points = _window_latency(spark, sf).select(
        F.expr("(views + clicks) div 3600").cast("int").alias("throughput"),
        F.col("latency_ms").cast("double").alias("latency"),
    )
    return reports.curve_of_runs(spark, points)


def _enriched(spark, sf, salts=1):
    plain = _events(spark, sf).drop("campaign_id", events.PAYLOAD_CAMPAIGN)
    joined = mapping.enrich_campaign(plain, event_table.mapping(_table(spark, sf)), salts)
    return joined.select("event_id", "ad_id", "event_type", "campaign_id")


def _stream_enriched(spark, sf, salts=1):
    """Salted, the mapping is not broadcast, so that the salt does its work."""
    if salts > 1:
        spark = own_session(spark, autoBroadcastJoinThreshold="-1")
    plain = _event_stream(spark, sf).drop("campaign_id", events.PAYLOAD_CAMPAIGN)
    joined = mapping.enrich_campaign(plain, _mapping_table(spark, sf), salts)
    picked = joined.select("event_id", "ad_id", "event_type", "campaign_id")
    return _run(spark, picked, "stream_enrich_campaign")


def _reported(spark, name, stream, **bounds):
    """The progress rows of a run of the stream over what is there."""
    folder = shared_folder(spark, name)
    store = ProgressStore(spark, f"{folder}/reports")
    spark.streams.addListener(store)
    try:
        run = run_available(stream, FileFolder(f"{folder}/rows"), f"{folder}/checkpoint")
        store.wait()
    finally:
        spark.streams.removeListener(store)
    return store.rows(run.runId)


def _progress_rows(spark, sf):
    rows = _reported(spark, "progress_rows", ctr_one_pass(_event_stream(spark, sf)))
    return rows.select("batch_id", "watermark", "input_rows", "rows_dropped")


def _stream_restart(spark, sf):
    """The first half of the table, a stop, and all of it on the same checkpoint."""
    folder = shared_folder(spark, "stream_restart")
    out = FileFolder(f"{folder}/rows")
    table = _table(spark, sf)
    half = table.select(F.percentile_approx("ts", 0.5)).first()[0]
    for part in (table.where(F.col("ts") <= half), table.where(F.col("ts") > half)):
        part.write.mode("append").parquet(f"{folder}/{event_table.FILE}")
        rates = ctr_one_pass(_event_stream(spark, folder), "1 hour")
        run_available(rates, out, f"{folder}/checkpoint")
    return spark.read.schema(rates.schema).parquet(out.path)


def _late_parts(table: DataFrame) -> list[DataFrame]:
    """The rows that are in time, a row a day ahead of all, and then three users' rows.

    A user's rows share a file, so that a group of them is counted once.
    """
    late = F.col("user_id") < 3
    last = F.max("ts") + F.expr("INTERVAL 1 DAY")
    ahead = table.agg(last.alias("ts")).select(
        F.lit(-1).cast("bigint").alias("event_id"), "ts", F.lit(0).cast("bigint").alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(0.0).alias("value"), F.lit("{}").alias("props"),
    )
    return [table.where(~late), ahead, table.where(late).repartition("user_id")]


def _stream_late_rows(spark, sf):
    """Input and dropped rows where the events of three users come a day late.

    Spark counts what it drops after the partial aggregate: a row a window and campaign.
    """
    folder = shared_folder(spark, "stream_late_rows")
    store = ProgressStore(spark, f"{folder}/reports")
    spark.streams.addListener(store)
    runs = []
    try:
        for part in _late_parts(_table(spark, sf)):
            _step(spark, part, folder)
            rates = ctr_one_pass(_event_stream(spark, folder))
            runs.append(run_available(rates, FileFolder(f"{folder}/rows"), f"{folder}/checkpoint"))
        store.wait()
    finally:
        spark.streams.removeListener(store)
    rows = store.rows().where(F.col("run_id").isin([str(r.runId) for r in runs]))
    return rows.agg(
        F.sum("input_rows").alias("input_rows"), F.sum("rows_dropped").alias("rows_dropped")
    )


def _stream_late_events(spark, sf):
    """The same feed, with late events counted one by one."""
    folder = shared_folder(spark, "stream_late_events")
    sink = FileFolder(f"{folder}/late")
    for part in _late_parts(_table(spark, sf)):
        _step(spark, part, folder)
        count_late(_event_stream(spark, folder), sink, f"{folder}/checkpoint").awaitTermination()
    return late_events(spark, sink).select("batch_id", "input_rows", "late_events", "late_so_far")


def _by_partition(spark, folder, pulses=None):
    """A folder's events, with a watermark for each of its four partitions."""
    source = FileFolder(f"{folder}/{event_table.FILE}", schema=event_table.TABLE_SCHEMA)
    parts = read_partitions(spark, source, range(PARTITIONS))
    return with_partition_watermarks(
        {k: event_table.ad_events(part) for k, part in parts.items()}, pulses=pulses
    )


PARTITIONS = 4


def _in_partitions(table: DataFrame) -> DataFrame:
    return table.withColumn("partition", (F.col("user_id") % PARTITIONS).cast("int"))


def _stream_partition_watermark(spark, sf):
    """Events of four partitions, of which one comes an hour after the others."""
    folder = shared_folder(spark, "stream_partition_watermark")
    lag = F.when(F.col("partition") == 2, F.expr("INTERVAL 1 HOUR")).otherwise(F.expr("INTERVAL 0 HOUR"))
    out = FileFolder(f"{folder}/rows")
    for part in _slices(_in_partitions(_table(spark, sf)), 4, F.col("ts").cast("timestamp") + lag):
        _step(spark, part, folder, "partition")
        rates = ctr_one_pass(_by_partition(spark, folder), "1 hour")
        run_available(rates, out, f"{folder}/checkpoint")
    return spark.read.schema(rates.schema).parquet(out.path)


def _stream_idle_partition(spark, sf):
    """Events of four partitions, of which one falls silent at half time."""
    folder = shared_folder(spark, "stream_idle_partition")
    out, now = FileFolder(f"{folder}/rows"), 0.0
    watch = IdleWatch(spark, f"{folder}/pulses", list(range(PARTITIONS)), clock=lambda: now)
    first, second = _slices(_in_partitions(_table(spark, sf)), 2)
    for part in (first, second.where("partition <> 3"), None):
        if part is not None:
            _step(spark, part, folder, "partition")
        rates = ctr_one_pass(_by_partition(spark, folder, watch.folder), "1 hour")
        query = run_available(rates, out, f"{folder}/checkpoint")
        watch.step(query)
        now += 45.0
        watch.step(query)
    return spark.read.schema(rates.schema).parquet(out.path)


def _stream_new_mapping(spark, sf):
    """Ads looked up while their mapping is replaced at half time."""
    folder = shared_folder(spark, "stream_new_mapping")
    ads, mappings = event_table.mapping(_table(spark, sf)), VersionedFolder(f"{folder}/mapping")
    moved = ads.withColumn("campaign_id", ((F.col("campaign_id") + 1) % 10).cast("int"))
    out = FileFolder(f"{folder}/rows")
    change = with_newest(mappings, mapping.enrich_campaign)
    for part, table in zip(_slices(_table(spark, sf), 2), (ads, moved), strict=False):
        write_mapping(table, mappings)
        _step(spark, part, folder)
        plain = _event_stream(spark, folder).drop("campaign_id", events.PAYLOAD_CAMPAIGN)
        write_once(plain, out, f"{folder}/checkpoint", change=change).awaitTermination()
    return read_once(spark, out).select("event_id", "ad_id", "event_type", "campaign_id")


def _stream_results_once(spark, sf):
    """Results of two halves, of which the last batch is run a second time."""
    folder = shared_folder(spark, "stream_results_once")
    out, checkpoint = FileFolder(f"{folder}/rows"), f"{folder}/checkpoint"
    for part in _slices(_table(spark, sf), 2):
        _step(spark, part, folder)
        for _ in range(2):
            rates = ctr_one_pass(_event_stream(spark, folder), "1 hour")
            write_once(rates, out, checkpoint).awaitTermination()
            # As if the query had died before the batch was committed.
            files.remove(spark, max(files.matching(spark, f"{checkpoint}/commits/*"), key=len_then_name))
    return read_once(spark, out).select(*rates.columns)


def len_then_name(path: str) -> tuple[int, str]:
    return len(path), path


def _open_state(spark, sf):
    """A run of the one pass, and the windows that it has not closed."""
    folder = shared_folder(spark, "open_windows")
    rates = ctr_one_pass(_event_stream(spark, sf), "1 hour")
    run_available(rates, FileFolder(f"{folder}/rows"), f"{folder}/checkpoint")
    held = open_windows(spark, f"{folder}/checkpoint", ["views", "clicks", "max_kafka_ts"])
    return spark.read.schema(rates.schema).parquet(f"{folder}/rows"), held


def _stream_with_open(spark, sf):
    """The windows given out and those still open, which make up the batch answer."""
    closed, held = _open_state(spark, sf)
    rates = held.where("views > 0").withColumn("ctr", click_ratio(F.col("clicks"), F.col("views")))
    return closed.unionByName(rates)


def _stream_read_events(spark, sf):
    """Results from a folder of record envelopes, read as a topic would be."""
    folder = shared_folder(spark, "stream_read_events")
    _envelopes(spark, sf).write.parquet(f"{folder}/topic")
    source = read_events(spark, FileFolder(f"{folder}/topic"))
    return _run(spark, ctr_from_records(source, ctr_one_pass, "1 hour"), "stream_read_events")


def _latency_average_again(spark, sf):
    """The latencies of one run, measured and written twice."""
    path = shared_folder(spark, "latency_again")
    for _ in range(2):
        write_latency(_window_latency(spark, sf), path, "run-1")
    samples = read_latencies(spark, path)
    return latency.latency_average(samples.withColumn("run_id", F.col("run_id").cast("string")))


def _arrival_gaps(spark, sf):
    """Rounded, as the two engines sum in different orders."""
    gaps = arrivals.arrival_gaps(_events(spark, sf))
    return gaps.select(
        "campaign_id", "gaps", *[F.round(c, 9).alias(c) for c in gaps.columns if c not in ("campaign_id", "gaps")]
    )


def _watermark_log(spark, sf):
    path = shared_folder(spark, "watermark_log")
    progress.watermark_lines(_run_progress(spark, sf)).write.text(path)
    return progress.watermark_log(read_lines(spark, path))


def _windowed_queries(suffix: str, length: str) -> dict[str, Query]:
    def table_query(transform):
        return lambda spark, sf: transform(_events(spark, sf), length)

    def stream_query(name, transform):
        return lambda spark, sf: _run(
            spark, transform(_event_stream(spark, sf), length), name
        )

    def flat_views(df, length):
        timed = counts.with_watermark(df)
        return counts.flatten_window(counts.view_counts(timed, length))

    def flat_clicks(df, length):
        timed = counts.with_watermark(df)
        return counts.flatten_window(counts.click_counts(timed, length))

    forms = {
        "view_counts": flat_views,
        "click_counts": flat_clicks,
        "ctr_left_join": ctr_left_join,
        "ctr_one_pass": ctr_one_pass,
        "ctr_smoothed": ctr_smoothed,
    }
    made = {}
    for name, transform in forms.items():
        made[name + suffix] = table_query(transform)
        made[f"stream_{name}{suffix}"] = stream_query(f"stream_{name}", transform)
    return made


def _ctr_from_records(form):
    return lambda spark, sf: ctr_from_records(_envelopes(spark, sf), form, "1 hour")


def _stream_ctr_from_records(form, encode, name):
    def run(spark, sf):
        ctr = ctr_from_records(_envelope_stream(spark, sf), form, "1 hour")
        return _run(spark, encode(ctr), name)

    return run


def _all_queries() -> dict[str, Query]:
    made: dict[str, Query] = {
        "parse_ad_events": lambda s, sf: events.parse_ad_events(_envelopes(s, sf)).drop(
            events.CORRUPT
        ),
        "drop_unparsed": _drop_unparsed,
        "corrupt_records": _corrupt_records,
        "event_time": lambda s, sf: events.with_event_ts(
            _events(s, sf).select("event_id", "event_time")
        ),
        "event_records": _event_records,
        "filter_views": lambda s, sf: events.filter_views(_events(s, sf)),
        "filter_clicks": lambda s, sf: events.filter_clicks(_events(s, sf)),
        "campaign_event_times": lambda s, sf: events.campaign_event_times(_events(s, sf)),
        "stream_campaign_event_times": lambda s, sf: _run(
            s,
            events.campaign_event_times(counts.with_watermark(_event_stream(s, sf))),
            "stream_campaign_event_times",
        ),
        "ctr_left_join_from_records": _ctr_from_records(ctr_left_join),
        "ctr_one_pass_from_records": _ctr_from_records(ctr_one_pass),
        "ctr_smoothed_from_records": _ctr_from_records(ctr_smoothed),
        "stream_ctr_left_join_from_records": _stream_ctr_from_records(
            ctr_left_join, records.result_records, "stream_ctr_left_join_from_records"
        ),
        "stream_ctr_one_pass_from_records": _stream_ctr_from_records(
            ctr_one_pass, records.result_records, "stream_ctr_one_pass_from_records"
        ),
        "stream_ctr_smoothed_from_records": _stream_ctr_from_records(
            ctr_smoothed, records.smoothed_result_records, "stream_ctr_smoothed_from_records"
        ),
        "result_records": lambda s, sf: records.result_records(
            ctr_left_join(_events(s, sf), "1 hour")
        ),
        "result_records_smoothed": lambda s, sf: records.smoothed_result_records(
            ctr_smoothed(_events(s, sf), "1 hour")
        ),
        "read_results": _read_results,
        "read_results_smoothed": _read_results_smoothed,
        "window_latency": _window_latency,
        "window_latency_smoothed": _window_latency_smoothed,
        "window_latency_repeated": _window_latency_repeated,
        "latency_average": _latency_average,
        "latency_curve": _latency_curve,
        "campaign_mapping": lambda s, sf: mapping.campaign_mapping(
            event_table.ads(_table(s, sf))
        ),
        "write_mapping": _mapping_table,
        "enrich_campaign": _enriched,
        "enrich_campaign_salted": lambda s, sf: _enriched(s, sf, salts=4),
        "stream_enrich_campaign": _stream_enriched,
        "stream_enrich_campaign_salted": lambda s, sf: _stream_enriched(s, sf, salts=4),
        "stream_restart": _stream_restart,
        "stream_late_rows": _stream_late_rows,
        "event_summary": lambda s, sf: arrivals.event_summary(_events(s, sf)),
        "overall_rate": lambda s, sf: arrivals.overall_rate(_events(s, sf)),
        "arrival_rate": lambda s, sf: arrivals.arrival_rate(_events(s, sf)),
        "arrival_gaps": _arrival_gaps,
        "burst_profile": lambda s, sf: arrivals.burst_profile(_events(s, sf), "1 hour"),
        "progress_rows": _progress_rows,
        "watermark_lag": lambda s, sf: progress.watermark_lag(_run_progress(s, sf)),
        "watermark_log": _watermark_log,
        "stream_late_events": _stream_late_events,
        "stream_partition_watermark": _stream_partition_watermark,
        "stream_idle_partition": _stream_idle_partition,
        "stream_new_mapping": _stream_new_mapping,
        "stream_results_once": _stream_results_once,
        "stream_read_events": _stream_read_events,
        "open_windows": lambda s, sf: _open_state(s, sf)[1],
        "stream_ctr_with_open": _stream_with_open,
        "latency_average_again": _latency_average_again,
    }
    for suffix, length in WINDOWS.items():
        made |= _windowed_queries(suffix, length)
    return made


def _without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as plain UTC times, the type DuckDB gives them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def _in_utc(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _without_zone(query(own_session(spark, session__timeZone="UTC"), sf_dir))

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Click-through rate per campaign and 10-second window, the join form."""
    return queries()["ctr_left_join"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """Every query: (spark, folder of the tables) to a DataFrame."""
    made = {name: _in_utc(query) for name, query in _all_queries().items()}
    if llm_queries:
        made |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return made


# --- the same answers in SQL -------------------------------------------------

_AD_EVENTS = """
ad as (select event_id, cast(user_id % 10 as varchar) campaign_id, ts kafka_ts,
         cast(user_id as varchar) user_id, json_extract_string(props, '$.k') page_id,
         cast(user_id as varchar) ad_id, event_type, epoch_us(ts) // 1000 event_time,
         cast(user_id % 10 as int) payload_campaign_id,
         cast(epoch_us(ts) // 1000 as double) production_timestamp, ts event_ts
       from events)"""

_MS = "make_timestamp(epoch_us({0}) // 1000 * 1000)"


def _groups(sec: int, ts: str = "ts") -> str:
    return f"""
w as (select user_id % 10 k, event_type, ts,
        make_timestamp(cast(floor(epoch({ts}) / {sec}) * {sec} * 1000000 as bigint)) ws
      from events),
g as (select k, ws, count(*) filter (event_type = 'view') v,
        count(*) filter (event_type = 'click') c,
        max(ts) filter (event_type = 'view') mv, max(ts) filter (event_type = 'click') mc,
        max(ts) filter (event_type in ('view', 'click')) mk,
        max(epoch_us(ts) // 1000) mall from w group by 1, 2)"""


def _closed(sec: int, kinds: str) -> str:
    """The windows a stream has given out once it has seen every event."""
    where = f"where event_type in ({kinds})" if kinds else ""
    return (
        f"and ws + interval {sec} second <= "
        f"(select max(ts) - interval 1 second from events {where})"
    )


def _counts_sql(sec: int, one: str, latest: str, name: str, cut: str) -> str:
    return f"""with {_groups(sec)}
select cast(k as varchar) campaign_id, ws window_start,
  ws + interval {sec} second window_end, {one} {name}, {latest} last_record_ts
from g where {one} > 0 {cut}"""


def _ctr_select(sec: int) -> str:
    return f"""select cast(k as varchar) campaign_id, ws window_start,
  ws + interval {sec} second window_end, v views, c clicks,
  cast(c as double) / v ctr, mk max_kafka_ts from g where v > 0"""


def _ctr_sql(sec: int, cut: str = "", ts: str = "ts") -> str:
    return f"with {_groups(sec, ts)} {_ctr_select(sec)} {cut}"


_SMOOTHED_SELECT = """select strftime(ws, '%Y-%m-%d %H:%M:%S.%g') window_start,
  cast(k as int) campaign_id, cast(c as int) clicks, cast(v + 1 as int) view_count,
  cast(c as double) / (v + 1) ctr, mall max_produce_time from g where true"""


def _smoothed_sql(sec: int, cut: str = "") -> str:
    return f"with {_groups(sec)} {_SMOOTHED_SELECT} {cut}"


_ISO = "'%Y-%m-%dT%H:%M:%S.%gZ'"

_RESULT_JSON = f"""select campaign_id as key, cast(json_object('campaign_id', campaign_id,
  'window_start', strftime(window_start, {_ISO}), 'window_end', strftime(window_end, {_ISO}),
  'views', views, 'clicks', clicks, 'ctr', ctr,
  'max_kafka_ts', strftime({_MS.format("max_kafka_ts")}, {_ISO})) as varchar) as value from r"""

_SMOOTHED_JSON = """select cast(json_object('window_start', window_start,
  'campaign_id', campaign_id, 'clicks', clicks, 'view_count', view_count, 'ctr', ctr,
  'max_produce_time', max_produce_time) as varchar) as value from r"""

_RESULTS_1H = f"""r as (select * replace ({_MS.format("max_kafka_ts")} as max_kafka_ts),
  window_end + interval 1 second + cast(campaign_id as int) * interval 1 millisecond append_ts
  from ({_ctr_sql(3600)}))"""

_SMOOTHED_1H = f"""r as (select *, strptime(window_start, '%Y-%m-%d %H:%M:%S.%g')
  + interval 3601 second + campaign_id * interval 1 millisecond append_ts
  from ({_smoothed_sql(3600)}))"""

_LATENCY_1H = f"""{_RESULTS_1H},
t as (select *, max(max_kafka_ts) over (partition by window_start) window_max_ts from r),
l as (select *, epoch_us(append_ts) // 1000 - epoch_us(window_max_ts) // 1000 latency_ms from t)"""

# Slices of equal length of time; the watermark of a run is the newest event before it.
_RUNS = f"""b as (select min(epoch_us(ts)) low,
  (max(epoch_us(ts)) - min(epoch_us(ts))) // {SLICES} + 1 len from events),
s as (select (epoch_us(ts) - low) // len k, max(ts) last from events, b group by 1),
p as (select cast(r.k as bigint) batch_id, {_MS.format("max(s.last)")} - interval 1 second wm,
  timestamp '2030-01-01' + r.k * interval 1 second as done
  from range(1, {SLICES}) r(k) join s on s.k < r.k group by r.k)"""

_HALF = "(select (min(epoch_us(ts)) + (max(epoch_us(ts)) - min(epoch_us(ts))) // 2) from events)"

_GAPS = """
with o as (select cast(user_id % 10 as varchar) campaign_id, epoch_us(ts) us, event_id from events),
d as (select campaign_id, us - lag(us) over (partition by campaign_id order by us, event_id) gap
      from o)
select campaign_id, count(gap) gaps, round(avg(gap) / 1e6, 9) mean_gap_s,
  round(stddev_samp(gap) / 1e6, 9) deviation_s, round(stddev_samp(gap) / avg(gap), 9) ratio
from d group by 1"""

_BURSTS = """
with c as (select date_trunc('hour', ts) b, count(*) n from events group by 1),
r as (select unnest(generate_series(min(b), max(b), interval 1 hour)) b from c),
a as (select r.b, coalesce(c.n, 0) n from r left join c on r.b = c.b),
q as (select case when n > (select cast(sum(n) as double) / count(*) from a) * 2.0
             then 'HIGH' else 'LOW' end phase, n from a)
select phase, count(*) buckets, cast(sum(n) as bigint) events,
  cast(sum(n) as double) / (count(*) * 3600.0) events_per_second from q group by 1"""

_ENRICHED = """select event_id, cast(user_id as varchar) ad_id, event_type,
  cast(user_id % 10 as int) campaign_id from events"""

_PARSED_COLUMNS = """campaign_id, kafka_ts, user_id, page_id, ad_id,
  cast(null as varchar) ad_type, event_type, event_time, cast(null as varchar) ip_address,
  payload_campaign_id, production_timestamp, make_timestamp(event_time * 1000) event_ts"""


def oracle_sql() -> dict[str, str]:
    """For each query, SQL for DuckDB over the same tables."""
    events_ms = _MS.format("ts")
    made = {
        "parse_ad_events": f"with {_AD_EVENTS} select {_PARSED_COLUMNS} from ad",
        "drop_unparsed": f"""with {_AD_EVENTS} select {_PARSED_COLUMNS} from ad
            where event_type <> 'error'""",
        "corrupt_records": f"""with {_AD_EVENTS} select campaign_id, count(*) records,
            count(*) filter (event_type = 'error') corrupt_records from ad group by 1""",
        "event_time": f"""with {_AD_EVENTS} select event_id, event_time,
            make_timestamp(event_time * 1000) event_ts from ad""",
        "event_records": f"""with {_AD_EVENTS} select campaign_id as key,
            user_id, page_id, ad_id, cast(null as varchar) ad_type, event_type, event_time,
            cast(null as varchar) ip_address, payload_campaign_id campaign_id,
            production_timestamp from ad""",
        "filter_views": f"with {_AD_EVENTS} select * from ad where event_type = 'view'",
        "filter_clicks": f"with {_AD_EVENTS} select * from ad where event_type = 'click'",
        "campaign_event_times": f"with {_AD_EVENTS} select campaign_id, event_ts from ad",
        "stream_campaign_event_times": f"with {_AD_EVENTS} select campaign_id, event_ts from ad",
        "ctr_left_join_from_records": _ctr_sql(3600, ts=events_ms),
        "ctr_one_pass_from_records": _ctr_sql(3600, ts=events_ms),
        "ctr_smoothed_from_records": _smoothed_sql(3600),
        "stream_ctr_left_join_from_records": f"""with r as (
            {_ctr_sql(3600, _closed(3600, "'view', 'click'"), events_ms)}) {_RESULT_JSON}""",
        "stream_ctr_one_pass_from_records": f"""with r as (
            {_ctr_sql(3600, _closed(3600, ""), events_ms)}) {_RESULT_JSON}""",
        "stream_ctr_smoothed_from_records": f"""with r as (
            {_smoothed_sql(3600, _closed(3600, ""))}) {_SMOOTHED_JSON}""",
        "result_records": f"with r as ({_ctr_sql(3600)}) {_RESULT_JSON}",
        "result_records_smoothed": f"with r as ({_smoothed_sql(3600)}) {_SMOOTHED_JSON}",
        "read_results": f"with {_RESULTS_1H} select * from r",
        "read_results_smoothed": f"with {_SMOOTHED_1H} select * from r",
        "window_latency": f"with {_LATENCY_1H} select * from l",
        "window_latency_smoothed": f"""with {_SMOOTHED_1H},
            t as (select *, max(max_produce_time) over (partition by window_start)
                  window_max_ms from r)
            select *, epoch_us(append_ts) // 1000 - window_max_ms latency_ms from t""",
        "window_latency_repeated": f"""with {_RESULTS_1H}, a as (select * from r union all
            select * replace (max_kafka_ts - interval 1 second as max_kafka_ts) from r),
            t as (select *, max(max_kafka_ts) over (partition by window_start) window_max_ts from a)
            select *, epoch_us(append_ts) // 1000 - epoch_us(window_max_ts) // 1000 latency_ms from t""",
        "latency_average": f"""with {_LATENCY_1H}, u as (select 'run-1' run_id, latency_ms from l
            union all select 'run-2', latency_ms from l where campaign_id < '5')
            select run_id, count(*) samples,
            cast(sum(latency_ms) as double) / count(*) mean_latency_ms from u group by 1""",
        "latency_curve": f"""with {_LATENCY_1H} select cast((views + clicks) // 3600 as int) throughput,
            cast(latency_ms as double) latency from l""",
        "campaign_mapping": """select distinct cast(user_id as varchar) ad_id,
            cast(user_id // 100 as int) campaign_id from events""",
        "write_mapping": """select distinct cast(user_id as varchar) ad_id,
            cast(user_id % 10 as int) campaign_id from events""",
        "enrich_campaign": _ENRICHED,
        "enrich_campaign_salted": _ENRICHED,
        "stream_enrich_campaign": _ENRICHED,
        "stream_enrich_campaign_salted": _ENRICHED,
        "stream_restart": _ctr_sql(3600, _closed(3600, "")),
        "stream_late_rows": """select count(*) + 1 input_rows,
            count(distinct (user_id, epoch_us(ts) // 10000000)) filter (user_id < 3) rows_dropped
            from events""",
        "event_summary": """select count(*) events, min(ts) first_event_ts,
            max(ts) last_event_ts from events""",
        "overall_rate": """with s as (select count(*) events,
              (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 as seconds from events)
            select events, seconds, events / seconds events_per_second from s""",
        "arrival_rate": """select date_trunc('second', ts) bucket_start, count(*) events,
            count(*) / 1.0::double events_per_second from events group by 1""",
        "arrival_gaps": _GAPS,
        "burst_profile": _BURSTS,
        "progress_rows": f"""select cast(0 as bigint) batch_id,
              '1970-01-01T00:00:00.000Z' watermark, count(*) input_rows,
              cast(0 as bigint) rows_dropped from events
            union all select 1, strftime(make_timestamp(epoch_us(max(ts)) // 1000 * 1000)
              - interval 1 second, {_ISO}), 0, 0 from events""",
        "watermark_lag": f"""with {_RUNS} select batch_id, strftime(wm, {_ISO}) watermark,
            epoch_us(done) // 1000 - epoch_us(wm) // 1000 lag_ms from p""",
        "watermark_log": f"""with {_RUNS} select wm watermark, done processing_time from p
            union all select timestamp '1970-01-01', timestamp '2030-01-01'""",
        "stream_late_events": """with n as (select count(*) filter (user_id >= 3) a,
              count(*) filter (user_id < 3) c from events)
            select 0::bigint batch_id, a input_rows, 0::bigint late_events, 0::bigint late_so_far from n
            union all select 1, 1, 0, 0 union all select 2, c, c, c from n""",
        "stream_partition_watermark": _ctr_sql(3600, """and ws + interval 1 hour <=
            (select min(m) - interval 1 second from
              (select max(ts) m from events group by user_id % 4))"""),
        "stream_idle_partition": f"""with heard as (select * from events
            where user_id % 4 <> 3 or epoch_us(ts) <= {_HALF}),
            {_groups(3600).replace("from events", "from heard")} {_ctr_select(3600)}
            and ws + interval 1 hour <= (select min(m) - interval 1 second from
              (select max(ts) m from heard where user_id % 4 <> 3 group by user_id % 4))""",
        "stream_new_mapping": f"""select event_id, cast(user_id as varchar) ad_id, event_type,
            cast((user_id % 10 + case when epoch_us(ts) <= {_HALF} then 0 else 1 end) % 10 as int)
            campaign_id from events""",
        "stream_results_once": _ctr_sql(3600, _closed(3600, "")),
        "stream_read_events": _ctr_sql(3600, _closed(3600, ""), events_ms),
        "open_windows": f"""with {_groups(3600)} select cast(k as varchar) campaign_id,
            ws window_start, ws + interval 1 hour window_end, v views, c clicks, mk max_kafka_ts from g
            where ws + interval 1 hour > (select max(ts) - interval 1 second from events)""",
        "stream_ctr_with_open": _ctr_sql(3600),
        "latency_average_again": f"""with {_LATENCY_1H} select 'run-1' run_id, count(*) samples,
            cast(sum(latency_ms) as double) / count(*) mean_latency_ms from l""",
    }
    for suffix, sec in SECONDS.items():
        both = "'view', 'click'"
        made |= {
            f"view_counts{suffix}": _counts_sql(sec, "v", "mv", "views", ""),
            f"stream_view_counts{suffix}": _counts_sql(
                sec, "v", "mv", "views", _closed(sec, "'view'")
            ),
            f"click_counts{suffix}": _counts_sql(sec, "c", "mc", "clicks", ""),
            f"stream_click_counts{suffix}": _counts_sql(
                sec, "c", "mc", "clicks", _closed(sec, "'click'")
            ),
            f"ctr_left_join{suffix}": _ctr_sql(sec),
            f"stream_ctr_left_join{suffix}": _ctr_sql(sec, _closed(sec, both)),
            f"ctr_one_pass{suffix}": _ctr_sql(sec),
            f"stream_ctr_one_pass{suffix}": _ctr_sql(sec, _closed(sec, "")),
            f"ctr_smoothed{suffix}": _smoothed_sql(sec),
            f"stream_ctr_smoothed{suffix}": _smoothed_sql(sec, _closed(sec, "")),
        }
    if llm_queries:
        made |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            made["pipeline"] = corpus_pipeline.ORACLE_SQL
    return made
