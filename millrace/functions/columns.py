"""Constant and audit columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F


def add_constants(df: DataFrame, values: Mapping[str, object] | None) -> DataFrame:
    """One literal column per entry; a column of the same name is replaced."""
    if not values:
        return df
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def stamp(df: DataFrame, name: str) -> DataFrame:
    """Audit time: one value per batch query, one per micro-batch in a stream."""
    return df.withColumn(name, F.current_timestamp())


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def free_prefix(names: Iterable[str]) -> str:
    """A prefix that none of ``names`` starts with, for columns that live inside an operator only."""
    taken, prefix = [n.lower() for n in names], "_"
    while any(n.startswith(prefix) for n in taken):
        prefix += "_"
    return prefix
