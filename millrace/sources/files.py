"""Which files an input consists of, without reading them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def file_inventory(spark: SparkSession, paths) -> DataFrame:
    """One row per file: ``path``, ``length`` in bytes, ``modificationTime``.

    The file content is pruned from the scan. A path that does not exist raises.
    """
    return (
        spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime")
    )


def total_bytes(spark: SparkSession, paths) -> int:
    """Input size; feeds :func:`millrace.operators.shard_mb_for`."""
    row = file_inventory(spark, paths).agg(F.sum("length").alias("bytes")).first()
    return int(row["bytes"] or 0)
