"""JSON lines cleaned as they arrive, a bad line never costing its micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.defaults import HASH_SALT, KEY_COLUMN, PROCESSED_AT, TRIGGER
from millrace.functions.columns import add_constants, stamp
from millrace.functions.keys import add_key_hash
from millrace.operators.records import parse_lines, rejected_lines
from millrace.schema import as_schema, require_columns
from millrace.sinks.tables import Target, append_once
from millrace.streaming.files import start_parquet_sink, trigger_for


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).selectExpr("value", "_metadata.file_path AS file")


def clean_stream(
    lines: DataFrame,
    schema: T.StructType | str,
    key: str | None = KEY_COLUMN,
    constants: Mapping[str, object] | None = None,
    salt: str = HASH_SALT,
    event_time: str | None = None,
    late_by: str | None = None,
    required: Sequence[str] = (),
    strict_types: bool = False,
    reject_mismatch: bool = False,
) -> DataFrame:
    """Parse, one row per key across all micro-batches, constants, audit time, key hash.

    Seen keys are kept as state for ever, unless ``event_time`` and ``late_by``, which go
    together, bound it. Repeats further apart than ``late_by`` may then survive, and rows that
    come later than that are dropped; :func:`stream_report` counts them. Large state belongs in
    the RocksDB state store (a session setting of the caller).
    """
    if (event_time is None) != (late_by is None):
        raise ValueError("event_time and late_by go together")
    parsed = parse_lines(
        lines, schema, strict_types=strict_types, reject_mismatch=reject_mismatch
    )
    rows = require_columns(parsed, required)
    if key is not None and event_time is not None:
        rows = rows.withWatermark(event_time, late_by)
        rows = rows.dropDuplicatesWithinWatermark([key])
    elif key is not None:
        rows = rows.dropDuplicates([key])
    rows = stamp(add_constants(rows, constants), PROCESSED_AT)
    return add_key_hash(rows, key, salt=salt, fallback="content") if key else rows


def start_clean_stream(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    schema: T.StructType | str,
    rejects: str | None = None,
    every: str | None = TRIGGER,
    max_files: int | None = None,
    strict_types: bool = False,
    reject_mismatch: bool = True,
    **options,
) -> list[StreamingQuery]:
    """Start the cleaning stream and, with ``rejects``, a second one for bad lines.

    Lines with a value that does not convert are rejected, unless ``reject_mismatch`` is off.
    Each has its own checkpoint below ``checkpoint`` and is exactly-once alone.
    """
    lines = stream_lines(spark, source, max_files)
    types = {"strict_types": strict_types, "reject_mismatch": reject_mismatch}
    good = clean_stream(lines, as_schema(schema), **types, **options)
    started = [start_parquet_sink(good, sink, f"{checkpoint}/records", every)]
    if rejects is not None:
        bad = rejected_lines(lines, keep=["file"], schema=schema, **types)
        started.append(start_parquet_sink(bad, rejects, f"{checkpoint}/rejects", every))
    return started


def batch_loader(
    target: Target, keys: Sequence[str], name: str, new_table: bool = False
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that loads a table without doubling on replay.

    After a failure Spark runs the last micro-batch again with the same number
    and the same rows; rows already stored under that number are left out.
    ``new_table=True`` lets batch 0 create the table.
    """

    def load(batch: DataFrame, number: int) -> None:
        create = new_table and number == 0
        append_once(batch, target, f"{name}-{number}", keys, new_table=create)

    return load


def start_table_stream(
    stream: DataFrame,
    target: Target,
    keys: Sequence[str],
    name: str,
    checkpoint: str,
    every: str | None = TRIGGER,
    new_table: bool = False,
) -> StreamingQuery:
    """Load every micro-batch into ``target``."""
    return (
        stream.writeStream.foreachBatch(batch_loader(target, keys, name, new_table))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_for(every))
        .start()
    )
