"""File outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def append_parquet(df: DataFrame, path: str) -> None:
    """Plain append. Running it twice stores the rows twice."""
    df.write.mode("append").parquet(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists", compression: str | None = None) -> None:
    """One JSON object per line, null fields written out.

    Every reader here takes files compressed by ``gzip``; each is read by one task, as it was written by one.
    """
    df.write.mode(mode).option("ignoreNullFields", "false").json(path, compression=compression)


def write_shards(df: DataFrame, text: str, path: str, shard: str, order_by) -> None:
    """One text file per shard, under ``shard=000000000``, … (name order is shard order) with rows in order.

    A shard is bounded in size, so no task receives more than a few shards' worth.
    The sort starts with the very column the writer partitions by; otherwise
    Spark would replace it with a sort of its own and lose the order of rows.
    """
    named = df.withColumn(shard, F.format_string("%09d", F.col(shard)))
    (
        named.repartition(shard)
        .sortWithinPartitions(shard, *order_by)
        .select(shard, F.col(f"`{text}`").alias("value"))
        .write.partitionBy(shard)
        .text(path)
    )


def write_chunks(
    df: DataFrame, path: str, chunk: str = "batch_id", order_by=(), mode: str = "append"
) -> None:
    """One Parquet file per chunk under ``chunk=<n>``, for replay a chunk at a time.

    The writer sorts by chunk in any case; ``order_by`` orders the rows inside.
    """
    ordered = df.repartition(chunk).sortWithinPartitions(chunk, *order_by)
    ordered.write.mode(mode).partitionBy(chunk).parquet(path)
