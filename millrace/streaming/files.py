"""Directories of Parquet files as unbounded tables."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.defaults import READ_AT, TRIGGER
from millrace.functions.columns import stamp
from millrace.schema import as_schema, review_schema


def trigger_for(every: str | None) -> dict:
    """Trigger arguments: an interval, ``"once"`` for what is there now, None for at once."""
    if every is None:
        return {}
    return {"availableNow": True} if every == "once" else {"processingTime": every}


def stream_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Files as they arrive. The schema is declared; ``max_files`` bounds a micro-batch.

    Declared columns a file lacks read as null.
    """
    declared = review_schema() if schema is None else as_schema(schema)
    reader = spark.readStream.schema(declared)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def start_parquet_sink(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = TRIGGER
) -> StreamingQuery:
    """Append each micro-batch as Parquet, exactly once under the checkpoint; does not block."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(**trigger_for(every))
        .start()
    )


def start_stamped_copy(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    schema: T.StructType | str | None = None,
    every: str | None = TRIGGER,
    max_files: int | None = None,
    stamped: str = READ_AT,
) -> StreamingQuery:
    """The stateless stream: read, add the read time, write."""
    rows = stream_parquet(spark, source, schema, max_files)
    return start_parquet_sink(stamp(rows, stamped), sink, checkpoint, every)


def wait(query: StreamingQuery, seconds: float | None = None) -> bool:
    """Block until the query ends, or for ``seconds``. False when it still runs.

    An error inside the query is raised here.
    """
    if seconds is None:
        query.awaitTermination()
        return True
    return bool(query.awaitTermination(seconds))


@dataclass(frozen=True)
class StreamReport:
    """Totals of a streaming query over the micro-batches whose progress the session still holds."""

    batches: int
    rows_in: int
    rows_out: int
    state_rows: int
    dropped_late: int
    seconds: float


def stream_report(query: StreamingQuery) -> StreamReport:
    """Rows read, written, held as state and dropped as late, and the time of the micro-batches.

    Spark holds the last ``spark.sql.streaming.numRecentProgressUpdates`` of them. A sink that does
    not count its rows adds nothing to ``rows_out``.
    """
    found = [json.loads(progress.json) for progress in query.recentProgress]
    states = [p.get("stateOperators", []) for p in found]
    return StreamReport(
        batches=sum(p["numInputRows"] > 0 for p in found),
        rows_in=sum(p["numInputRows"] for p in found),
        rows_out=sum(max(0, p.get("sink", {}).get("numOutputRows", 0)) for p in found),
        state_rows=sum(s["numRowsTotal"] for s in states[-1]) if states else 0,
        dropped_late=sum(s.get("numRowsDroppedByWatermark", 0) for held in states for s in held),
        seconds=sum(p.get("durationMs", {}).get("triggerExecution", 0) for p in found) / 1000,
    )
