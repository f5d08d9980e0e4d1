"""Late events, counted one by one.

A windowed query tells how many groups it dropped, after its partial aggregate. This
counts the events: those whose window had closed by the watermark of their batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adstream.operators.counts import DELAY, WINDOW, tumbling
from adstream.sources import files
from adstream.sources.endpoints import FileFolder
from adstream.streaming.batches import batch_path, read_once, write_once

EPOCH = "timestamp '1970-01-01 00:00:00'"


def _watermark_before(spark: SparkSession, sink: FileFolder, query: str, batch: int):
    """The watermark that the newest batch before this one left behind."""
    if not batch:
        return None
    path = batch_path(sink, query, batch - 1)
    if not files.exists(spark, f"{path}/_SUCCESS"):
        raise FileNotFoundError(f"batch {batch - 1} of query {query} is not in {sink.path}")
    return spark.read.format(sink.format).load(path).first()["next_watermark"]


def count_late(
    events: DataFrame,
    sink: FileFolder,
    checkpoint: str,
    length: str = WINDOW,
    delay: str = DELAY,
    interval: str | None = None,
) -> StreamingQuery:
    """Start a query that writes, for each micro-batch, its events and its late events.

    ``events`` is a stream with ``event_ts`` and without a watermark. An event is late
    if its window ended at or before the watermark in force, which is the newest event
    of all batches before, less ``delay``, in whole milliseconds; an event without a
    time is not. Started over the same source and bounds as a windowed query it sees
    the same batches. Each batch is kept once, so its watermark outlives restarts and
    a batch that is run again counts once. Read it with ``late_events``.
    """

    def count(rows: DataFrame, query: str, batch: int) -> DataFrame:
        spark = rows.sparkSession
        watermark = F.lit(_watermark_before(spark, sink, query, batch)).cast("timestamp")
        newest = F.date_trunc("millisecond", F.max("event_ts")) - F.expr(f"INTERVAL {delay}")
        return (
            rows.select("event_ts", tumbling(length))
            .agg(
                F.count("*").alias("input_rows"),
                F.count_if(F.col("window.end") <= watermark).alias("late_events"),
                F.greatest(newest, watermark).alias("next_watermark"),
            )
            .withColumn("watermark", watermark)
        )

    return write_once(events, sink, checkpoint, interval=interval, change=count)


def late_events(spark: SparkSession, sink: FileFolder) -> DataFrame:
    """(query, batch_id, watermark, input_rows, late_events, late_so_far), a row each batch."""
    so_far = Window.partitionBy("query").orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    return read_once(spark, sink).select(
        "query",
        F.col("batch").cast("bigint").alias("batch_id"),
        F.coalesce("watermark", F.expr(EPOCH)).alias("watermark"),
        "input_rows",
        "late_events",
        F.sum("late_events").over(so_far).alias("late_so_far"),
    )
