"""The log of a stream's batches as a table that a listener writes, however many batches there are."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

SCHEMA = "batch long, rows long, rows_per_s double, seconds double, started string"


class BatchLog(StreamingQueryListener):
    """Writes a row for each batch of the session's streams to the table at ``path``.

    A stream is known by its id, which its checkpoint keeps, and a batch has a folder of its own: one that is reported again, by
    this run or a later one, replaces its row. Register with ``spark.streams.addListener``; reports come a little after the
    batches, so readers call :meth:`wait` first.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.ended: dict[str, threading.Event] = {}
        self.failures: list[Exception] = []

    def _run(self, run_id) -> threading.Event:
        return self.ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._run(event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        try:
            row = (p.batchId, p.numInputRows, float(p.processedRowsPerSecond or 0), p.durationMs.get("triggerExecution", 0) / 1000, p.timestamp)
            self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("overwrite").json(f"{self.path}/stream={p.id}/number={p.batchId}")
        except Exception as e:  # the callback's caller drops what it raises; wait() tells
            self.failures.append(e)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._run(event.runId).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all batches of a query that has ended are in the table."""
        if not self._run(query.runId).wait(seconds):
            raise TimeoutError(f"no report of the end of {query.runId} within {seconds} s")
        if self.failures:
            raise self.failures[0]


def batch_log(spark: SparkSession, path: str) -> DataFrame:
    """stream, batch, rows, rows_per_s, seconds and started of every batch that a :class:`BatchLog` has seen."""
    return spark.read.schema(f"{SCHEMA}, stream string, number long").json(path).drop("number")
