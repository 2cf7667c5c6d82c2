"""Totals of a stream over its whole life, restarts included.

Spark holds the last progress records of a running query only. A listener writes each record to a file
of its own in a shared folder, and the totals are one aggregation over them.
"""

from __future__ import annotations

import itertools
import threading

from pyspark.sql import SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from millrace.storage import write_new
from millrace.streaming.files import StreamReport

_PROGRESS = (
    "id string, runId string, batchId bigint, numInputRows bigint, sink struct<numOutputRows:bigint>,"
    "stateOperators array<struct<numRowsTotal:bigint,numRowsDroppedByWatermark:bigint>>,"
    "durationMs struct<triggerExecution:bigint>"
)


class ProgressLog(StreamingQueryListener):
    """Writes the progress of every query of the session, while registered, under ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._number = itertools.count()
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end_of(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress
        # One line a file; a run of a query has a number of its own, so nothing is overwritten.
        name = f"{found.runId}-{found.batchId:012d}-{next(self._number):012d}.json"
        write_new(self.spark, f"{self.folder}/{name}", " ".join(found.json.splitlines()))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()  # behind all progress of the run

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def finish(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until the query has ended and all its progress is written."""
        query.awaitTermination()
        if not self._end_of(str(query.runId)).wait(seconds):
            raise TimeoutError(f"the progress of {query.runId} did not arrive within {seconds} s")


def whole_report(spark: SparkSession, folder: str, query_id: str | None = None) -> StreamReport:
    """Totals of all micro-batches written under ``folder``, or of those of one query (its ``id`` outlives restarts)."""
    found = spark.read.schema(_PROGRESS).json(folder.rstrip("/"))
    if query_id is not None:
        found = found.where(F.col("id") == query_id)

    def state(name: str):
        return F.aggregate(
            F.transform("stateOperators", lambda s: F.coalesce(s[name], F.lit(0))), F.lit(0).cast("bigint"), lambda a, b: a + b
        )

    row = found.select(
        "*", state("numRowsTotal").alias("held"), state("numRowsDroppedByWatermark").alias("late")
    ).agg(
        F.count_if(F.col("numInputRows") > 0).alias("batches"),
        F.sum("numInputRows").alias("rows_in"),
        F.sum(F.greatest(F.coalesce("sink.numOutputRows", F.lit(0)), F.lit(0))).alias("rows_out"),
        F.max_by("held", "batchId").alias("state_rows"),
        F.sum("late").alias("dropped_late"),
        F.sum("durationMs.triggerExecution").alias("ms"),
    ).first()
    return StreamReport(
        batches=row.batches,
        rows_in=row.rows_in or 0,
        rows_out=row.rows_out or 0,
        state_rows=row.state_rows or 0,
        dropped_late=row.dropped_late or 0,
        seconds=(row.ms or 0) / 1000,
    )
