"""A table landed as ordered, equally sized chunks that a stream can replay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from millrace.defaults import CHUNK_ROWS, INGESTED_AT
from millrace.functions.columns import stamp
from millrace.operators.chunks import chunk_by_rows
from millrace.sinks.files import write_chunks


def land_in_chunks(
    df: DataFrame,
    path: str,
    order_by: Sequence[str | Column],
    rows: int = CHUNK_ROWS,
    chunk: str = "batch_id",
    stamped: str = INGESTED_AT,
) -> None:
    """Cut ``df`` in key order, stamp it and write one file per chunk.

    Unlike paging by offset, the source is read once and no row is missed or
    repeated. Replay with ``stream_parquet(..., max_files=1)``.
    """
    chunks = chunk_by_rows(df, order_by, rows, into=chunk)
    write_chunks(stamp(chunks, stamped), path, chunk, order_by)
