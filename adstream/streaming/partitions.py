"""A watermark for each partition of a source, and partitions that fall silent.

Spark's watermark follows the newest event of all, so a partition that lags behind the
others loses its rows. Here each partition has a watermark of its own, and the least
of them holds, as long as ``spark.sql.streaming.multipleWatermarkPolicy`` is ``min``,
which is Spark's default. A partition without events would hold all back for ever: when
one has been silent for a while, a pulse row moves its watermark to that of the others.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adstream.operators.counts import DELAY, with_watermark

PULSE = "partition int, event_ts timestamp"
IDLE_SECONDS = 40.0


def _metric(partition: int) -> str:
    return f"partition_{partition}"


def with_partition_watermarks(
    parts: Mapping[int, DataFrame], delay: str = DELAY, pulses: str | None = None
) -> DataFrame:
    """The streams of a source's partitions as one, held by the slowest of them.

    Each stream reads its own partition and nothing else (``KafkaTopic.only``, or a
    folder cut by a partition column), so the source is read once. ``pulses`` is the
    folder of an ``IdleWatch``, if partitions may fall silent. A plan has one branch a
    partition, so this is for hundreds of partitions, not for many thousands.
    """
    branches = []
    for partition, events in sorted(parts.items()):
        seen = events.observe(
            _metric(partition), F.unix_micros(F.max("event_ts")).alias("newest"), F.count(F.lit(1)).alias("rows")
        )
        if pulses:
            beats = events.sparkSession.readStream.schema(PULSE).parquet(pulses)
            beats = beats.where(F.col("partition") == partition).select("event_ts", F.lit(True).alias("_pulse"))
            seen = seen.withColumn("_pulse", F.lit(False)).unionByName(beats, allowMissingColumns=True)
        branches.append(with_watermark(seen, delay))
    every = branches[0]
    for branch in branches[1:]:
        every = every.unionByName(branch)
    if not pulses:
        return every
    # It names the event time, so it is not moved below the watermarks.
    return every.where(F.when(~F.col("_pulse"), F.col("event_ts")).isNotNull()).drop("_pulse")


class IdleWatch:
    """Gives pulses to partitions that have had no event for ``seconds``.

    ``step`` looks at a query's progress and writes what is due; ``start`` does so every
    few seconds while the query runs. The pulse of a silent partition is the least of
    the newest events of the others, so its watermark goes where theirs is. While all
    are silent nothing moves. An event that comes after such a pulse, and is older, is
    late, as it would be anywhere. The clock, in seconds, can be set.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        partitions: list[int],
        seconds: float = IDLE_SECONDS,
        clock: Callable[[], float] = time.time,
    ):
        self._spark, self.folder, self._seconds, self._clock = spark, folder, seconds, clock
        self._heard = dict.fromkeys(partitions, clock())
        self._newest: dict[int, int] = {}
        self._given: dict[int, int] = {}
        self._read: set[tuple[str, int]] = set()
        spark.createDataFrame([], PULSE).write.mode("append").parquet(folder)

    def idle(self) -> list[int]:
        """Partitions that have been silent for long enough."""
        now = self._clock()
        return [p for p, at in self._heard.items() if now - at >= self._seconds]

    def step(self, query: StreamingQuery) -> dict[int, int]:
        """Take in the query's progress; write and give the pulses due, in epoch microseconds."""
        for progress in query.recentProgress:
            if (str(progress.runId), progress.batchId, progress.numInputRows) in self._read:
                continue
            self._read.add((str(progress.runId), progress.batchId, progress.numInputRows))
            for partition in self._heard:
                seen = progress.observedMetrics.get(_metric(partition))
                if seen is not None and seen["rows"]:
                    self._heard[partition] = self._clock()
                    newest = seen["newest"]
                    if newest is not None:
                        self._newest[partition] = max(newest, self._newest.get(partition, newest))
        idle = self.idle()
        active = [self._newest[p] for p in self._heard if p not in idle and p in self._newest]
        if not active or any(p not in self._newest for p in self._heard if p not in idle):
            return {}
        least = min(active)
        known = {p: max(self._given.get(p, least - 1), self._newest.get(p, least - 1)) for p in idle}
        due = {p: least for p in idle if least > known[p]}
        if due:
            # The others too, where they are: a query that has been restarted knows the
            # watermark of no partition until it has seen a row of it.
            every = {p: at for p, at in self._newest.items() if p not in idle} | due
            rows = self._spark.createDataFrame(list(every.items()), "partition int, micros long")
            at = F.timestamp_micros("micros").alias("event_ts")
            rows.select("partition", at).coalesce(1).write.mode("append").parquet(self.folder)
            self._given |= due
        return due

    def start(self, query: StreamingQuery, every: float = 5.0) -> threading.Thread:
        """Watch in a thread of its own until the query ends."""

        def watch():
            while query.isActive:
                self.step(query)
                time.sleep(every)

        thread = threading.Thread(target=watch, name=f"idle-{uuid.uuid4().hex[:8]}", daemon=True)
        thread.start()
        return thread
