"""Keeping an expensive expression from being copied by the optimizer."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def evaluated_once(df: DataFrame) -> DataFrame:
    """The same rows, with every column computed once per row.

    A later filter on a column is normally moved below the projection that
    computes it, which repeats the computation in the filter. Filters on the
    output of a generator stay above it, so the row is sent through one.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.explode(F.array(row)).alias("_row")).select("_row.*")
