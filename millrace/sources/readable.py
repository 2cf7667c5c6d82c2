"""Files that cannot be read, found before a job relies on them.

Spark either stops at such a file or, told to ignore it, leaves its rows out without a word, or some of them. The probe
opens every file on an executor: a Parquet file's footer and all its pages, a gzip file to its end and checksum.
It gives the reason for each that fails, and readers get the paths of the others only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.sources.files import file_inventory

_MAGIC = b"PAR1"


def _problem(path: str, content: bytes) -> str | None:
    if path.endswith(".parquet"):
        if len(content) < 12 or content[:4] != _MAGIC or content[-4:] != _MAGIC:
            return "no_footer"
        try:
            file = pq.ParquetFile(pa.BufferReader(content))
            for group in range(file.num_row_groups):
                for _ in file.iter_batches(row_groups=[group]):
                    pass
        except (pa.ArrowException, OSError, ValueError):
            return "broken_block"
    elif path.endswith(".gz"):
        left = content
        while left:
            unpack = zlib.decompressobj(wbits=31)
            try:
                while left and not unpack.eof:
                    unpack.decompress(left, 1 << 20)
                    left = unpack.unconsumed_tail
            except zlib.error:
                return "broken_block"
            if not unpack.eof:
                return "cut_short"
            left = unpack.unused_data
    return None


def probe_files(spark: SparkSession, paths) -> DataFrame:
    """``path`` and ``reason`` of every file; the reason is null if the file can be read to its end.

    Files that are neither Parquet nor gzip by name have nothing to probe, and empty files are not listed. A file passes through one task and its
    content must be below 2 GB, as an unsplittable file's must for its reader.
    """

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                reason = _problem(path, content.as_buffer().to_pybytes() if content.is_valid else b"")
                yield pa.RecordBatch.from_pydict({"path": pa.array([path]), "reason": pa.array([reason], pa.string())})

    # A file whose bytes the file system itself refuses is left out here, so it is missed in the list.
    content = spark.read.format("binaryFile").option("ignoreCorruptFiles", "true").load(paths)
    probed = content.select("path", "content").mapInArrow(probe, "path string, reason string")
    opened = probed.withColumn("opened", F.lit(True))
    reason = F.when(F.col("opened"), F.col("reason")).otherwise(F.lit("unreadable"))
    return file_inventory(spark, paths).select("path").join(opened, "path", "left").select("path", reason.alias("reason"))


def split_readable(probed: DataFrame) -> tuple[list[str], DataFrame]:
    """The paths that can be read, for a reader, and (path, reason) of the others."""
    good = [r.path for r in probed.where("reason is null").select("path").orderBy("path").collect()]
    return good, probed.where("reason is not null")
