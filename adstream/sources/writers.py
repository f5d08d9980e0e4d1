"""Sinks: keyed records, the ad-to-campaign table, latencies, a console."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from adstream.operators.records import event_records
from adstream.session import state_width, stream_settings
from adstream.sources.endpoints import FileFolder, JdbcTable, KafkaTopic
from adstream.sources.versions import VersionedFolder, write_version

Sink = KafkaTopic | FileFolder


def stream_writer(df: DataFrame, sink: Sink, checkpoint: str) -> DataStreamWriter:
    """An append-mode writer: each window goes out once, when it has closed."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if isinstance(sink, KafkaTopic):
        return writer.format("kafka").options(**sink.write_options())
    return writer.format(sink.format).options(**sink.options).option("path", sink.path)


def write_results(
    records: DataFrame, sink: Sink, checkpoint: str | None = None
) -> StreamingQuery | None:
    """Append records to a topic or a folder; starts a query if they stream.

    Spark's Kafka sink delivers at least once: read results back with
    ``window_latency``, which takes each different record once, or write them with
    ``streaming.write_once``. State of a stream is kept as by ``streaming.start``.
    """
    if records.isStreaming:
        if not checkpoint:
            raise ValueError("a streaming write needs a checkpoint folder")
        with stream_settings(records.sparkSession, state_width(records.sparkSession)):
            return stream_writer(records, sink, checkpoint).start()
    writer = records.write.mode("append")
    if isinstance(sink, KafkaTopic):
        writer.format("kafka").options(**sink.write_options()).save()
    else:
        writer.format(sink.format).options(**sink.options).save(sink.path)
    return None


def write_events(
    events: DataFrame, sink: Sink, checkpoint: str | None = None
) -> StreamingQuery | None:
    """Publish ad events as JSON records keyed by campaign, from a table or a stream."""
    return write_results(event_records(events), sink, checkpoint)


def write_mapping(mapping: DataFrame, sink: FileFolder | VersionedFolder | JdbcTable) -> None:
    """Replace the ad-to-campaign table.

    A versioned folder gets one more version: whoever reads an older one goes on with
    it, so this is the form for streams that look ads up. A plain folder is written
    beside the old one and then takes its name; a query that still reads the old files
    fails, and for a moment there are none. A JDBC table is emptied, not dropped, and
    filled again, in two transactions.
    """
    if isinstance(sink, VersionedFolder):
        write_version(mapping, sink)
        return
    if isinstance(sink, JdbcTable):
        mapping.write.mode("overwrite").format("jdbc").options(**sink.write_options()).save()
        return
    beside = f"{sink.path.rstrip('/')}-{uuid.uuid4().hex}"
    mapping.write.format(sink.format).options(**sink.options).save(f"{beside}-new")
    hadoop = mapping.sparkSession._jvm.org.apache.hadoop.fs
    new, old, path = (hadoop.Path(p) for p in (f"{beside}-new", f"{beside}-old", sink.path))
    files = path.getFileSystem(mapping.sparkSession._jsc.hadoopConfiguration())
    had_one = files.exists(path)
    if had_one and not files.rename(path, old):
        raise OSError(f"{sink.path} cannot be replaced")
    if not files.rename(new, path):
        raise OSError(f"{sink.path} is in {beside}-new")
    if had_one:
        files.delete(old, True)


def write_latency(latencies: DataFrame, path: str, run_id: str) -> None:
    """One latency per line, in a folder per run, so that runs stay apart.

    A run that is written again takes the place of what it had; other runs stay. Without
    any latency nothing is written, and what the run had stays too.
    """
    lines = latencies.select(
        F.lit(run_id).alias("run_id"), F.col("latency_ms").cast("string").alias("value")
    )
    once = lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    once.partitionBy("run_id").text(path)


def console(df: DataFrame, checkpoint: str | None = None) -> DataStreamWriter:
    """Print a stream's rows, for debugging."""
    writer = df.writeStream.outputMode("append").format("console")
    return writer.option("checkpointLocation", checkpoint) if checkpoint else writer
