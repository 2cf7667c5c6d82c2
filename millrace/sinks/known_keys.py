"""Append only rows whose key no earlier run has stored.

A table of runs (see :mod:`millrace.sinks.runs`) keeps a Bloom filter of its keys beside its rows: bitmaps of
32,768 bits, one to about 3,000 keys, in which each key sets four bits of the bitmap its hash names. New rows meet
the bitmaps of their keys, not the stored rows. A key whose bits are not all set is new for certain; the
few others are compared with the stored keys exactly, and of the table only the key columns are read for that.

Rows and filter are published in one entry, so none of them gets ahead of the other. A filter that is more than half full
is built again, twice as large, from the stored keys.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.errors import LoadError
from millrace.functions.columns import free_prefix
from millrace.operators.dedup import first_per_key
from millrace.operators.quality import watch
from millrace.schema import as_schema
from millrace.scratch import drop_staged, stage
from millrace.sinks.runs import Pending, last_version, prepare_run, publish, read_runs

ROWS, FILTER = "rows", "keys"
#: Keys a new filter is made for; it grows by itself.
CAPACITY = 1_000_000

_BITMAP_BITS = 32_768
_BITS_PER_KEY = 10
_PROBES = 4
_FILTER = "buckets bigint, bucket bigint, bits binary"
_SECOND = 0x0B100F


def _hashes(keys: Sequence[str], named: str) -> dict[str, Column]:
    columns = [F.col(f"`{k}`") for k in keys]
    return {f"{named}one": F.xxhash64(*columns), f"{named}two": F.xxhash64(F.lit(_SECOND), *columns)}


def _probes(hash_name: str) -> list[Column]:
    return [F.shiftrightunsigned(hash_name, 15 * i).bitwiseAND(F.lit(_BITMAP_BITS - 1)) for i in range(_PROBES)]


def key_filter(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """buckets, bucket and bits: the Bloom filter of the rows' keys."""
    hashed = rows.select(*[c.alias(n) for n, c in _hashes(keys, "").items()])
    placed = hashed.select(
        F.pmod("one", F.lit(buckets)).alias("bucket"), F.explode(F.array(*_probes("two"))).alias("at")
    )
    bitmaps = placed.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits"))
    return bitmaps.select(F.lit(buckets).cast("bigint").alias("buckets"), "bucket", "bits")


def merge_filters(one: DataFrame, two: DataFrame) -> DataFrame:
    """The filter of the keys of both, which must have as many buckets."""
    return one.union(two).groupBy("buckets", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def maybe_known(rows: DataFrame, keys: Sequence[str], known: DataFrame, buckets: int, into: str) -> DataFrame:
    """Add ``into``: false if the key is in none of the bitmaps for certain."""
    prefix = free_prefix([*rows.columns, into])
    one, two, bits = f"{prefix}one", f"{prefix}two", f"{prefix}bits"
    bitmaps = known.select(F.col("bucket").alias(f"{prefix}bucket"), F.col("bits").alias(bits))
    hashed = rows.withColumns(_hashes(keys, prefix))
    met = hashed.join(bitmaps, F.pmod(F.col(one), F.lit(buckets)) == F.col(f"{prefix}bucket"), "left")
    is_set = F.col(bits).isNotNull()
    for at in _probes(two):
        byte = F.conv(F.hex(F.substring(bits, F.expr("1") + F.shiftright(at, 3).cast("int"), F.lit(1))), 16, 10)
        is_set = is_set & (F.getbit(byte.cast("int"), at.bitwiseAND(F.lit(7)).cast("int")) == 1)
    return met.select(*[F.col(f"`{c}`") for c in rows.columns], F.coalesce(is_set, F.lit(False)).alias(into))


def not_stored(rows: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key (null is one key) is not among the stored; reads their key columns only."""
    held = stored.select(*[F.col(f"`{k}`").alias(f"_stored_{i}") for i, k in enumerate(keys)])
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_stored_{i}")) for i, k in enumerate(keys)]
    return rows.join(held, same, "left_anti")


@dataclass(frozen=True)
class NewRows:
    """What an append did: rows stored, keys the filter could not rule out, and rows that were left out."""

    added: int
    candidates: int
    left_out: int


def append_new(
    df: DataFrame,
    table: str,
    run_id: str,
    keys: str | Sequence[str],
    order_by: Sequence[str | Column] | None = None,
    capacity: int = CAPACITY,
    also: Sequence[Pending] = (),
    unique: bool = False,
) -> NewRows:
    """Store the first row of each key of ``df`` that no other run of ``table`` holds, as run ``run_id``.

    A run that is repeated is compared with the others only and replaces its former rows. Of two writers at
    the same time the later one is refused, since it has not seen the keys of the other. ``also`` are
    runs of other outputs of the table that are published in the same entry. ``unique`` says that no
    key of ``df`` repeats. Read the rows with :func:`read_new`.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    first = df if unique else first_per_key(df, keys, order_by)
    return _store(first, table, run_id, keys, capacity, also, lambda rows, stored: not_stored(rows, stored, keys))


def append_better(
    df: DataFrame,
    table: str,
    run_id: str,
    keys: str | Sequence[str],
    order_by: Sequence[str],
    capacity: int = CAPACITY,
    also: Sequence[Pending] = (),
) -> NewRows:
    """Store the first row of each key of ``df``, if it comes before all that other runs hold of its key.

    A later run may correct an earlier one, so a key has a row in every run that improved it;
    :func:`read_best` keeps the last of them, whatever the order in which the runs came. ``order_by`` are columns that
    order the rows of a key fully (ascending, nulls first). Of the stored rows only they and the keys are read.
    """
    keys, order_by = [keys] if isinstance(keys, str) else list(keys), list(order_by)
    first = first_per_key(df, keys, order_by)
    return _store(first, table, run_id, keys, capacity, also, lambda rows, stored: better(rows, stored, keys, order_by))


def better(rows: DataFrame, stored: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Rows that come before every stored row of their key, or whose key is not stored."""
    prefix = free_prefix(rows.columns)
    place = [F.col(f"`{c}`") for c in order_by]
    named = [F.col(f"`{k}`").alias(f"{prefix}{i}") for i, k in enumerate(keys)]
    best = stored.groupBy(*named).agg(F.min(F.struct(*place)).alias(f"{prefix}best"))
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"{prefix}{i}")) for i, k in enumerate(keys)]
    met = rows.join(best, same, "left")
    first = F.col(f"{prefix}best").isNull() | (F.struct(*place) < F.col(f"{prefix}best"))
    return met.where(first).select(*[F.col(f"`{c}`") for c in rows.columns])


def _store(
    rows: DataFrame,
    table: str,
    run_id: str,
    keys: list[str],
    capacity: int,
    also: Sequence[Pending],
    choose: Callable[[DataFrame, DataFrame], DataFrame],
) -> NewRows:
    """Store ``rows`` whose key is new for certain, and those of the others that ``choose`` leaves."""
    spark, schema, staged = rows.sparkSession, rows.schema, []
    version = last_version(spark, table)
    known = read_runs(spark, table, _FILTER, output=FILTER).drop("run_id") if version else None
    head = known.select("buckets").first() if version else None
    buckets = head.buckets if head else max(1, math.ceil(capacity * _BITS_PER_KEY / _BITMAP_BITS))
    flag = f"{free_prefix(rows.columns)}maybe"
    flagged = maybe_known(rows, keys, known, buckets, flag) if head else rows.withColumn(flag, F.lit(False))
    watched, seen = watch(flagged, "maybe", F.count_if(F.col(flag)).alias("maybe"), F.count(F.lit(1)).alias("rows"))
    try:
        staged.append(stage(watched, "flagged"))
        candidates, offered = int(seen.get["maybe"]), int(seen.get["rows"])
        new = staged[0].drop(flag)
        others = read_runs(spark, table, schema, output=ROWS, without=run_id) if version else new.limit(0)
        if candidates:
            sure, maybe = staged[0].where(~F.col(flag)).drop(flag), staged[0].where(F.col(flag)).drop(flag)
            new = sure.unionByName(choose(maybe, others.drop("run_id")))
        watched, written = watch(new, "new")
        run = prepare_run(watched, table, run_id, ROWS)
        added = int(written.get["rows"])
        stored = spark.read.schema(schema).parquet(f"{run.table}/{run.folder}")
        merged = key_filter(stored, keys, buckets)
        staged.append(stage(merge_filters(known, merged) if head else merged, "filter"))
        merged = staged[1]
        set_bits = merged.agg(F.sum(F.bitmap_count("bits")).alias("n")).first().n or 0
        if 2 * set_bits > buckets * _BITMAP_BITS:
            only = [F.col(f"`{k}`") for k in keys]
            merged = key_filter(others.select(*only).unionByName(stored.select(*only)), keys, _room_for(set_bits, buckets))
        publish(spark, run, prepare_run(merged, table, "all", FILTER), *also, after=version)
    finally:
        drop_staged(*staged)
    return NewRows(added, candidates, offered - added)


def _room_for(set_bits: int, buckets: int) -> int:
    """Buckets for twice the keys that have set so many bits."""
    filled = min(set_bits / (buckets * _BITMAP_BITS), 1 - 1e-6)
    keys = -math.log(1 - filled) * buckets * _BITMAP_BITS / _PROBES
    return max(2 * buckets, math.ceil(2 * keys * _BITS_PER_KEY / _BITMAP_BITS))


def read_new(spark: SparkSession, table: str, schema: T.StructType | str) -> DataFrame:
    """The rows stored by :func:`append_new`, with ``run_id``."""
    if not last_version(spark, table):
        raise LoadError(f"{table} holds no published run")
    return read_runs(spark, table, as_schema(schema), output=ROWS)


def read_best(
    spark: SparkSession, table: str, schema: T.StructType | str, keys: str | Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """The first row of each key over all runs stored by :func:`append_better`, with the ``run_id`` that brought it."""
    return first_per_key(read_new(spark, table, schema), keys, order_by)
