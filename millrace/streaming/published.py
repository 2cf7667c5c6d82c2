"""Streams whose micro-batches are published runs: several outputs at once, and nothing twice.

Every micro-batch is parsed once, and its outputs appear in one log entry under the batch's number. A batch that
runs again after a failure replaces what it had published, or publishes it for the first time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.defaults import HASH_SALT, KEY_COLUMN, TRIGGER
from millrace.functions.columns import free_prefix
from millrace.functions.json_text import PROBLEM
from millrace.operators.records import records_with_problems
from millrace.plans.clean import clean_records
from millrace.schema import as_schema, require_columns
from millrace.scratch import drop_staged, stage
from millrace.sinks.known_keys import append_better, append_new
from millrace.sinks.runs import prepare_run, read_runs
from millrace.streaming.clean import stream_lines
from millrace.streaming.files import trigger_for

REJECTS = "rejects"
_REJECT = f"file string, {PROBLEM} string, line string"


def run_of(number: int) -> str:
    """The run id of a micro-batch."""
    return f"batch-{number:010d}"


def batch_cleaner(
    table: str,
    schema: T.StructType | str,
    key: str | Sequence[str] = KEY_COLUMN,
    order_by: Sequence[str] | None = None,
    constants: Mapping[str, object] | None = None,
    salt: str = HASH_SALT,
    required: Sequence[str] = (),
    strict_types: bool = False,
    reject_mismatch: bool = True,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function from raw lines (``value``, ``file``) to records and rejects.

    The lines are parsed once, into a scratch table that both outputs are read from. Of the records one per key
    is stored that no earlier batch has; the keys are known by the filter kept with the table, not by state.
    """
    schema = as_schema(schema)
    prefix = free_prefix(schema.fieldNames())
    file, problem, text = (f"{prefix}{name}" for name in ("file", "problem", "text"))

    def clean(batch: DataFrame, number: int) -> None:
        parsed = records_with_problems(
            batch.withColumnRenamed("file", file),
            schema,
            keep=[file],
            strict_types=strict_types,
            reject_mismatch=reject_mismatch,
            problem_column=problem,
            line_column=text,
        )
        stored = stage(require_columns(parsed, required), "batch")
        try:
            good = F.col(problem).isNull()
            bad = stored.where(~good).select(
                F.col(file).alias("file"), F.col(problem).alias(PROBLEM), F.col(text).alias("line")
            )
            rejects = prepare_run(bad, table, run_of(number), REJECTS)
            records = stored.where(good).select(*[F.col(f"`{f}`") for f in schema.fieldNames()])
            rows = clean_records(records, key, required, order_by, constants, salt)
            append_new(rows, table, run_of(number), key, also=[rejects], unique=True)
        finally:
            drop_staged(stored)

    return clean


def start_published_clean(
    spark: SparkSession,
    source: str,
    table: str,
    checkpoint: str,
    schema: T.StructType | str,
    every: str | None = TRIGGER,
    max_files: int | None = None,
    **options,
) -> StreamingQuery:
    """One query from JSON lines to the records (``read_new``) and rejects (:func:`read_rejects`) of ``table``."""
    lines = stream_lines(spark, source, max_files)
    return _start(lines, batch_cleaner(table, schema, **options), checkpoint, every)


def read_rejects(spark: SparkSession, table: str) -> DataFrame:
    return read_runs(spark, table, _REJECT, output=REJECTS)


def start_first_per_key(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    keys: str | Sequence[str],
    order_by: Sequence[str],
    every: str | None = TRIGGER,
) -> StreamingQuery:
    """Keep the first row of each key under ``order_by``, in whatever order the rows arrive.

    A micro-batch stores its first rows where they come before those stored; ``read_best`` gives the
    same rows as the batch operator over everything that has arrived.
    """

    def merge(batch: DataFrame, number: int) -> None:
        append_better(batch, table, run_of(number), keys, order_by)

    return _start(stream, merge, checkpoint, every)


def _start(
    stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, every: str | None
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_for(every))
        .start()
    )
