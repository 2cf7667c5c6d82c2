"""Dense row numbers and size-bounded chunks over a global order.

A single window over all rows would run in one task. Here every row is placed
as (segment, row in segment), the placed table is written once, and only totals
per segment are added up across the cluster. A segment is one sorted range of
the order key, or one input file block when the order is the file order.

* Row chunks need no second shuffle: the row's place inside its segment comes
  from the task that wrote it.
* Byte chunks shuffle (segment, row, size) only. The wide rows then find their
  chunk through the few (segment, first row, last row) spans of each segment.

The tables of totals and spans are written too, so their true size decides
whether Spark broadcasts them or falls back to a shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.defaults import (
    CHUNK_ROWS,
    LARGE_INPUT_MB,
    SHARD_MB,
    SHARD_MB_LARGE_INPUT,
    SHARD_MB_SMALL_INPUT,
    SMALL_INPUT_MB,
)
from millrace.errors import SchemaError
from millrace.functions.columns import free_prefix
from millrace.scratch import stage

MB = 1024 * 1024


class Names(NamedTuple):
    """Columns of an operator's own, none of which the rows have."""

    tie: str
    place: str
    id: str
    part: str
    row: str
    size: str
    block: str
    first: str
    total: str
    range: str
    held: str
    base: str
    offset: str
    before: str
    low: str
    high: str
    position: str

    @classmethod
    def beside(cls, df: DataFrame, *more: str) -> Names:
        prefix = free_prefix([*df.columns, *more])
        return cls(*[prefix + name for name in cls._fields])


# Salt of the second content hash.
_SECOND = 0x5EED

# monotonically_increasing_id keeps the task number above this many bits.
_ROW_BITS = 33


def shard_mb_for(total_bytes: int) -> int:
    """Shard target in MB for an input of ``total_bytes``."""
    size_mb = total_bytes / MB
    if size_mb > LARGE_INPUT_MB:
        return SHARD_MB_LARGE_INPUT
    if size_mb < SMALL_INPUT_MB:
        return SHARD_MB_SMALL_INPUT
    return SHARD_MB


def _place(
    df: DataFrame,
    names: Names,
    order_by: Sequence[str | Column] | None,
    segments: Sequence[str],
    size: Column | None,
    keep: Sequence[str] | None = None,
) -> tuple[DataFrame, list[str]]:
    """Write ``df``, or its columns ``keep``, with the segment and the row number inside it."""
    extra = {} if size is None else {names.size: F.coalesce(size.cast("bigint"), F.lit(0))}
    if order_by:
        # Rows that share a key still spread over several ranges and tasks: they
        # are told apart by content, and equal rows by their place in the scan.
        full = [*order_by, F.col(names.tie), F.col(names.place)]
        tied = df.withColumns(
            {names.tie: _content_hash(df), names.place: F.monotonically_increasing_id()}
        )
        ranged = tied.repartitionByRange(*full).sortWithinPartitions(*full)
        numbered = ranged.withColumn(names.id, F.monotonically_increasing_id())
        placed = numbered.withColumns(
            {
                names.part: F.shiftright(names.id, _ROW_BITS),
                names.row: F.col(names.id).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
                **extra,
            }
        ).drop(names.id, names.tie, names.place)
        if keep is not None:
            placed = placed.select(*keep, names.part, names.row, *extra)
        return stage(placed, "placed"), [names.part]
    if not segments:
        raise ValueError("give order_by, or segments that name the file and block of each row")
    placed = df.withColumns({names.row: F.monotonically_increasing_id(), **extra})
    return stage(placed, "placed"), list(segments)


def _content_hash(df: DataFrame, *salt: Column) -> Column:
    """Hash of all columns Spark can hash (maps and variants are left out)."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    hashed = [n for n, kind in kinds.items() if "map<" not in kind and "variant" not in kind]
    return F.xxhash64(*salt, *[F.col(f"`{n}`") for n in hashed]) if hashed else F.lit(0).cast("bigint")


def _offsets(placed: DataFrame, names: Names, segments: list[str], total: Column) -> DataFrame:
    """Per segment: its first row number and the total of all segments before it.

    Segments are as many as input blocks, so they are added up in sorted ranges, and only the
    totals of the ranges, one row per task, meet in one place.
    """
    totals = placed.groupBy(*segments).agg(
        F.min(names.row).alias(names.first), total.cast("bigint").alias(names.total)
    )
    ranged = totals.repartitionByRange(*segments).withColumn(names.range, F.spark_partition_id())
    ranged = stage(ranged, "segment-totals")
    earlier = Window.orderBy(names.range).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranged.groupBy(names.range).agg(F.sum(names.total).alias(names.held))
    ranges = ranges.select(
        names.range, F.coalesce(F.sum(names.held).over(earlier), F.lit(0)).alias(names.base)
    )
    inside = (
        Window.partitionBy(names.range).orderBy(*segments).rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.col(names.base) + F.coalesce(F.sum(names.total).over(inside), F.lit(0))
    running = ranged.join(ranges, names.range).select(
        *segments, names.first, offset.cast("bigint").alias(names.offset)
    )
    return stage(running, "offsets")


def _positions(
    df: DataFrame, order_by: Sequence[str | Column] | None, segments: Sequence[str], into: str, keep=None
) -> DataFrame:
    names = Names.beside(df, into)
    placed, segs = _place(df, names, order_by, segments, None, keep)
    offsets = _offsets(placed, names, segs, F.count(F.lit(1)))
    position = F.col(names.offset) + F.col(names.row) - F.col(names.first)
    own = df.columns if keep is None else keep
    return placed.join(offsets, segs).select(*[F.col(f"`{c}`") for c in own], position.alias(into))


def _refuse(df: DataFrame, into: str) -> None:
    if into.lower() in {c.lower() for c in df.columns}:
        raise SchemaError(f"the rows already have a column {into!r}")


def number_rows(
    df: DataFrame,
    order_by: Sequence[str | Column] | None = None,
    into: str = "position",
    segments: Sequence[str] = (),
) -> DataFrame:
    """Add a dense number 0, 1, 2, … in the global order of ``order_by``.

    Without ``order_by`` the order is (``segments``, order inside a block), for
    rows of :func:`millrace.sources.read_lines`. Rows with equal keys are
    ordered by content. A column ``into`` must not exist; any other name may.
    """
    _refuse(df, into)
    return _positions(df, order_by, segments, into)


def numbered_contents(df: DataFrame, order_by: Sequence[str | Column], hashes: Sequence[str], into: str) -> DataFrame:
    """Two hashes of a row, named by ``hashes``, and its number ``into`` in the order.

    The same numbers as :func:`number_rows` gives, without a copy of the other columns.
    """
    named = df.withColumns(content_hashes(df, hashes))
    return _positions(named, order_by, (), into, keep=list(hashes))


def content_hashes(df: DataFrame, names: Sequence[str]) -> dict[str, Column]:
    """Two hashes that stand for a row's content."""
    return dict(zip(names, (_content_hash(df), _content_hash(df, F.lit(_SECOND))), strict=True))


def chunk_by_rows(
    df: DataFrame,
    order_by: Sequence[str | Column] | None = None,
    rows: int = CHUNK_ROWS,
    into: str = "batch_id",
    first: int = 1,
    segments: Sequence[str] = (),
) -> DataFrame:
    """Number consecutive chunks of exactly ``rows`` rows (the last may be shorter)."""
    _refuse(df, into)
    position = Names.beside(df, into).position
    numbered = number_rows(df, order_by, position, segments)
    chunk = F.expr(f"`{position}` div {int(rows)}") + F.lit(first)
    return numbered.withColumn(into, chunk).drop(position)


def chunk_by_bytes(
    df: DataFrame,
    text: str,
    target_bytes: int,
    order_by: Sequence[str | Column] | None = None,
    into: str = "shard_id",
    segments: Sequence[str] = (),
    keep_place: bool = False,
) -> DataFrame:
    """Number consecutive chunks of about ``target_bytes`` bytes of ``text``.

    A row goes to chunk ``bytes before it div target_bytes``, so every chunk but
    the last is within one row of the target. ``keep_place`` keeps the columns
    that order rows inside a chunk, after ``into``.
    """
    _refuse(df, into)
    names = Names.beside(df, into)
    placed, segs = _place(df, names, order_by, segments, F.octet_length(F.col(f"`{text}`")))
    offsets = _offsets(placed, names, segs, F.sum(names.size))
    earlier = (
        Window.partitionBy(*segs).orderBy(names.row).rowsBetween(Window.unboundedPreceding, -1)
    )
    narrow = placed.select(*segs, names.row, names.size).withColumn(
        names.before, F.coalesce(F.sum(names.size).over(earlier), F.lit(0))
    )
    chunk = F.expr(f"(`{names.offset}` + `{names.before}`) div {int(target_bytes)}")
    spans = (
        narrow.join(offsets.drop(names.first), segs)
        .groupBy(*segs, chunk.alias(into))
        .agg(F.min(names.row).alias(names.low), F.max(names.row).alias(names.high))
    )
    spans = stage(spans, "spans")
    # Rows and spans meet in blocks of about one span's rows, so a row is compared
    # with a few spans only, however many its segment has.
    sizes = spans.agg(
        F.count(F.lit(1)).alias("spans"), F.sum(F.col(names.high) - F.col(names.low) + 1).alias("rows")
    ).first()
    block_rows = max(1, (sizes["rows"] or 0) // max(1, sizes["spans"]))
    spans = spans.withColumn(
        names.block,
        F.explode(F.expr(f"sequence(`{names.low}` div {block_rows}, `{names.high}` div {block_rows})")),
    )
    blocked = placed.withColumn(names.block, F.expr(f"`{names.row}` div {block_rows}"))
    condition = blocked[names.row].between(spans[names.low], spans[names.high])
    for name in (*segs, names.block):
        condition = (blocked[name] == spans[name]) & condition
    joined = blocked.join(spans, condition)
    place = [blocked[c] for c in (*segs, names.row) if c not in df.columns] if keep_place else []
    return joined.select(*[blocked[f"`{c}`"] for c in df.columns], spans[into], *place)
