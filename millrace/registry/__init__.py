"""Queries over the shared tables, one or more per operator, with their SQL twins.

Every query reads whole tables. A query is ``(spark, folder) -> DataFrame``; its
SQL twin, where one exists, gives the same columns and rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.registry import batch, lines, nested, stream, tables

Query = Callable[[SparkSession, str], DataFrame]

_FAMILIES = (batch, lines, nested, tables, stream)


def all_queries() -> dict[str, Query]:
    return {name: query for family in _FAMILIES for name, query in family.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for family in _FAMILIES for name, sql in family.ORACLES.items()}
