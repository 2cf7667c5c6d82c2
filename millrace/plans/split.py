"""Large JSON inputs to size-bounded files of valid lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.json_text import is_json, strip_space
from millrace.defaults import SHARD_MB
from millrace.operators.chunks import MB, chunk_by_bytes
from millrace.sinks.files import write_shards
from millrace.sources.text import array_elements, read_documents, read_lines


def valid_lines(lines: DataFrame) -> DataFrame:
    """Stripped lines that hold one complete JSON value; blank and broken ones go."""
    stripped = lines.withColumn("value", strip_space(F.col("value")))
    return stripped.where((F.col("value") != "") & is_json(F.col("value")))


def split_lines(lines: DataFrame, path: str, target_bytes: int) -> None:
    """Shard ``read_lines`` rows in file order. No line is cut at a boundary."""
    placed = chunk_by_bytes(
        valid_lines(lines),
        "value",
        target_bytes,
        segments=["file", "block"],
        keep_place=True,
    )
    write_shards(placed, "value", path, "shard_id", ["file", "block", "_row"])


def split_to_shards(
    spark: SparkSession,
    paths,
    output: str,
    shard_mb: int = SHARD_MB,
    layout: str = "lines",
) -> int:
    """Write ``output/shard_id=000000000``, … and return the shard target in MB.

    ``layout="array"`` reads each file as one JSON array and shards its
    elements. A target that follows the input size is the caller's choice:
    ``shard_mb=shard_mb_for(total_bytes(spark, paths))``.
    """
    if layout == "array":
        found = array_elements(read_documents(spark, paths), keep=["file"])
        lines = found.where(F.col("problem").isNull()).select(
            "value", "file", F.lit(0).cast("bigint").alias("block")
        )
    elif layout == "lines":
        lines = read_lines(spark, paths)
    else:
        raise ValueError(f"unknown layout {layout!r}")
    split_lines(lines, output, shard_mb * MB)
    return shard_mb
