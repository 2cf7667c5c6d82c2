"""Ordered pages and samples."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.defaults import SAMPLE_ROWS
from millrace.functions.columns import free_prefix
from millrace.operators.chunks import content_hashes, numbered_contents
from millrace.sources.tables import quantile_bounds


def page(df: DataFrame, order_by: Sequence[str | Column], offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in the given order; ties are split by content.

    Rows are numbered by their order columns and a hash of their content alone; the page's hashes,
    at most ``limit`` of them, then pick the rows. The rule is the same at every size and
    depth. Rows come in their order within the page. To read every page use
    :func:`chunk_by_rows` once.
    """
    prefix = free_prefix(df.columns)
    hashes, position, times, copy = [f"{prefix}a", f"{prefix}b"], f"{prefix}position", f"{prefix}times", f"{prefix}copy"
    wanted = (
        numbered_contents(df, order_by, hashes, position)
        .where(F.col(position).between(offset, offset + limit - 1))
        .groupBy(*hashes)
        .agg(F.count(F.lit(1)).alias(times), F.min(position).alias(position))
    )
    # Equal rows are interchangeable: as many as the page holds of them stay.
    number = F.row_number().over(Window.partitionBy(*hashes).orderBy(F.lit(1)))
    found = df.withColumns(content_hashes(df, hashes)).join(wanted, hashes).withColumn(copy, number)
    return found.where(F.col(copy) <= F.col(times)).orderBy(position).select(*[F.col(f"`{c}`") for c in df.columns])


def sample_rows(df: DataFrame, order_by: Sequence[str | Column], n: int = SAMPLE_ROWS) -> DataFrame:
    """The first ``n`` rows under an order, so the sample repeats."""
    return df.orderBy(*order_by).limit(n)


@dataclass(frozen=True)
class KeyPages:
    """Pages of a table by ranges of a key: after ``bounds[i - 1]``, up to and with ``bounds[i]``."""

    key: str
    bounds: tuple

    def __len__(self) -> int:
        return len(self.bounds) + 1

    def read(self, df: DataFrame, number: int) -> DataFrame:
        """One page: two comparisons that a source evaluates itself, no sort. Null keys come with the first page."""
        if not 0 <= number < len(self):
            raise ValueError(f"there are pages 0 to {len(self) - 1}")
        key, wanted = F.col(f"`{self.key}`"), F.lit(True)
        if number:
            wanted = wanted & (key > F.lit(self.bounds[number - 1]))
        if number < len(self.bounds):
            wanted = wanted & (key <= F.lit(self.bounds[number]))
        return df.where(wanted if number or not self.bounds else wanted | key.isNull())

    def after(self, df: DataFrame, cursor) -> DataFrame:
        """The page that begins behind ``cursor``, the last key a reader has got; the rest of it if it lies inside one."""
        key = F.col(f"`{self.key}`")
        later = [b for b in self.bounds if b > cursor]
        rest = df.where(key > F.lit(cursor))
        return rest.where(key <= F.lit(later[0])) if later else rest


def key_pages(df: DataFrame, key: str, rows: int) -> KeyPages:
    """Cut a table into pages of about ``rows`` rows at quantiles of a numeric key.

    One scan of the key gives all bounds, and reading a page costs that page, not the pages before it. Rows with equal
    keys share a page, so no border parts them and none is missed or read twice; a key with many rows makes a
    long page.
    """
    total = df.select(F.col(f"`{key}`")).count()
    slices = -(-total // rows)
    bounds = quantile_bounds(df.select(F.col(f"`{key}`")), key, slices) if slices > 1 else []
    return KeyPages(key, tuple(bounds))
