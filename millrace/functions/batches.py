"""Arrow batches of bounded size between the JVM and Python."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Bytes of an Arrow batch between the JVM and Python, for both sides' memory; one longer row is alone.
BATCH_BYTES = 8 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, with its session's Arrow batches bounded to ``BATCH_BYTES`` unless already smaller."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = df.sparkSession.conf.get(key)
    if not held.rstrip("b").isdigit() or not 0 < int(held.rstrip("b")) <= BATCH_BYTES:
        df.sparkSession.conf.set(key, str(BATCH_BYTES))
    return df
