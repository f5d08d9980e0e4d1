"""Start streaming queries and run them to the end of what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from adstream.session import shared_folder, state_width, stream_settings
from adstream.sources.endpoints import FileFolder
from adstream.sources.writers import Sink, stream_writer


def start(
    df: DataFrame,
    sink: Sink,
    checkpoint: str,
    interval: str | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """A continuous query; ``interval`` sets a fixed trigger, such as ``"1 second"``.

    State of a new checkpoint is kept in RocksDB in ``partitions`` parts (by default
    those of ``state_width``), whatever the session has set. Restarting with the
    same checkpoint goes on where the query stopped, with the checkpoint's settings.
    """
    writer = stream_writer(df, sink, checkpoint)
    if interval:
        writer = writer.trigger(processingTime=interval)
    with stream_settings(df.sparkSession, partitions or state_width(df.sparkSession)):
        return writer.start()


def run_available(
    df: DataFrame, sink: Sink, checkpoint: str, partitions: int | None = None
) -> StreamingQuery:
    """Process all rows there are now, emit the windows that closed, and stop."""
    writer = stream_writer(df, sink, checkpoint).trigger(availableNow=True)
    with stream_settings(df.sparkSession, partitions or state_width(df.sparkSession)):
        query = writer.start()
    query.awaitTermination()
    return query


def run_to_table(
    df: DataFrame, spark: SparkSession, name: str, partitions: int | None = None
) -> DataFrame:
    """Run a stream over what is there into a new table, and read that table."""
    folder = shared_folder(spark, name)
    out = FileFolder(f"{folder}/rows")
    run_available(df, out, f"{folder}/checkpoint", partitions)
    return spark.read.schema(df.schema).format(out.format).load(out.path)
