"""A listener that keeps progress reports as a table."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from adstream.operators.progress import progress_rows


class ProgressStore(StreamingQueryListener):
    """Appends each query's progress reports to a folder of JSON lines.

    A thread of its own writes what has come in, by Spark, every few ``seconds``, and
    at once when a query ends; the listener's calls only hand reports over. Should the
    folder refuse ``most`` reports, the store stops taking more and ``wait`` raises.
    ``clock`` gives the time of a report, by its fields, in place of the wall clock's.
    Register with ``spark.streams.addListener``.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        seconds: float = 10.0,
        most: int = 10_000,
        clock: Callable[[dict], str] | None = None,
    ):
        self._clock = clock
        self._spark = spark
        self._path = path
        self._seconds = seconds
        self._most = most
        self._reports: list[str] = []
        self._running: set[str] = set()
        self._changed = threading.Condition()
        self._ended = False
        self._failure: Exception | None = None
        threading.Thread(target=self._write_on, daemon=True).start()

    def onQueryStarted(self, event):
        with self._changed:
            self._running.add(str(event.runId))

    def onQueryProgress(self, event):
        text = event.progress.json
        if self._clock:
            report = json.loads(text)
            text = json.dumps(report | {"timestamp": self._clock(report)})
        with self._changed:
            if len(self._reports) < self._most:
                self._reports.append(text)
            else:
                self._failure = self._failure or RuntimeError(f"{self._path} takes no reports")

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self._changed:
            self._running.discard(str(event.runId))
            self._ended = True
            self._changed.notify_all()

    def _write_on(self) -> None:
        while True:
            with self._changed:
                self._changed.wait_for(lambda: self._ended, self._seconds)
                reports = list(self._reports)
                ended, self._ended = self._ended, False
            try:
                self._append(reports)
            except Exception as failure:
                with self._changed:
                    self._failure = failure
                    self._changed.notify_all()
                continue
            with self._changed:
                del self._reports[: len(reports)]
                if ended:
                    self._changed.notify_all()

    def _append(self, reports: list[str]) -> None:
        if reports:
            rows = self._spark.createDataFrame([(r,) for r in reports], "value string")
            rows.coalesce(1).write.mode("append").text(self._path)

    def wait(self, seconds: float | None = None) -> None:
        """Wait until all queries seen have ended and their reports are written.

        Raises what kept them from being written, or TimeoutError if they are not
        within ``seconds``; by default there is no limit.
        """
        def settled():
            return self._failure or not (self._running or self._reports or self._ended)

        with self._changed:
            if not self._changed.wait_for(settled, seconds):
                raise TimeoutError(f"reports are not all in {self._path} yet")
            if self._failure:
                raise self._failure

    def rows(self, run_id: str | None = None) -> DataFrame:
        """The reports written so far, one row each; of one run, if given.

        A listener hears all queries of its session, also the last reports of
        queries that ended shortly before it was registered.
        """
        lines = self._spark.read.schema("value string").text(self._path)
        rows = progress_rows(lines)
        return rows if run_id is None else rows.filter(F.col("run_id") == str(run_id))
