"""Sinks that take a stream's micro-batches one by one.

A query that fails between a batch and its commit runs that batch again. Here a batch
has a place of its own, by query and batch number, so that running it again changes
nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adstream.session import state_width, stream_settings
from adstream.sources import files
from adstream.sources.endpoints import FileFolder, KafkaTopic
from adstream.sources.versions import VersionedFolder, hold, read_version

Sink = KafkaTopic | FileFolder
Change = Callable[[DataFrame, str, int], DataFrame]


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a query keeps over all restarts from its checkpoint."""
    return json.loads(files.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def batch_path(sink: FileFolder, query: str, batch: int) -> str:
    return f"{sink.path.rstrip('/')}/query={query}/batch={batch}"


def _mark(sink: Sink, checkpoint: str, query: str, batch: int) -> str:
    """The file that says that a batch has been delivered in full."""
    if isinstance(sink, FileFolder):
        return f"{batch_path(sink, query, batch)}/_SUCCESS"
    return f"{checkpoint.rstrip('/')}/delivered/{batch}"


def _deliver(rows: DataFrame, sink: Sink, query: str, batch: int) -> None:
    if isinstance(sink, FileFolder):
        path = batch_path(sink, query, batch)
        rows.write.mode("overwrite").format(sink.format).options(**sink.options).save(path)
        return
    known = [("query", query), ("batch", str(batch))]
    headers = [
        F.struct(F.lit(k).alias("key"), F.lit(v).cast("binary").alias("value")) for k, v in known
    ]
    tagged = rows.withColumn("headers", F.array(*headers))
    tagged.write.format("kafka").options(**sink.write_options(), includeHeaders="true").save()


def write_once(
    df: DataFrame,
    sink: Sink,
    checkpoint: str,
    interval: str | None = None,
    partitions: int | None = None,
    change: Change | None = None,
) -> StreamingQuery:
    """Start a query that delivers each micro-batch once, whatever is run again.

    A folder gets one folder a query and batch; a batch that is there in full is not
    written again, and one that is not is overwritten. Read it with ``read_once``.
    A topic cannot be written in one transaction with the checkpoint: records carry
    their query and batch as headers, a batch known to be delivered is skipped, and
    ``drop_repeated`` takes out what a crash in the midst of a batch left twice.

    ``change`` makes something else of a batch first, given the query's id and the
    batch's number. Without ``interval`` the query takes what there is and stops.
    """
    if isinstance(sink, KafkaTopic) and "headers" in df.columns:
        raise ValueError("the sink adds headers of its own")

    def deliver(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        query = query_id(spark, checkpoint)
        mark = _mark(sink, checkpoint, query, batch)
        if files.exists(spark, mark):
            # Its rows are still computed, as the query's state is made from them.
            rows.write.format("noop").mode("overwrite").save()
            return
        _deliver(change(rows, query, batch) if change else rows, sink, query, batch)
        if not files.exists(spark, mark):  # where the committer leaves none
            files.write_text(spark, mark, "")

    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    how = {"processingTime": interval} if interval else {"availableNow": True}
    writer = writer.foreachBatch(deliver).trigger(**how)
    with stream_settings(df.sparkSession, partitions or state_width(df.sparkSession)):
        return writer.start()


def read_once(spark: SparkSession, sink: FileFolder, query: str | None = None) -> DataFrame:
    """All rows of whole batches, with ``query`` and ``batch``; of one query, if given."""
    marks = files.matching(spark, f"{sink.path.rstrip('/')}/query={query or '*'}/batch=*/_SUCCESS")
    if not marks:
        raise FileNotFoundError(f"{sink.path} has no whole batch")
    reader = spark.read.format(sink.format).options(**sink.options).option("basePath", sink.path)
    if sink.schema is not None:
        reader = reader.schema(sink.schema)
    return reader.load([m.removesuffix("/_SUCCESS") for m in marks])


def drop_repeated(records: DataFrame) -> DataFrame:
    """Records of a topic, each query's batch once.

    What came twice has the same key, value and headers; the earliest stays. Records
    of equal content in one batch count as one, as a query gives out a group once.
    """
    same = [F.col("key"), F.col("value"), F.transform("headers", lambda h: h["value"])]
    first = F.min(F.struct("timestamp", "partition", "offset", F.struct(*records.columns).alias("row")))
    return records.groupBy(*same).agg(first.alias("first")).select("first.row.*")


def with_newest(folder: VersionedFolder, join: Callable[[DataFrame, DataFrame], DataFrame]) -> Change:
    """A change for ``write_once``: each batch joined with the version that is new then.

    A batch that is run again joins the version it had the first time.
    """

    def change(rows: DataFrame, query: str, batch: int) -> DataFrame:
        spark = rows.sparkSession
        return join(rows, read_version(spark, folder, hold(spark, folder, query, batch)))

    return change
