"""Removal of byte strings that repeat anywhere, by a hash-compared sort of sampled suffixes.

Every string of ``length`` bytes is assigned to its anchor: the place of the least k-gram hash inside it. Equal
strings have equal anchors, so they meet under the hash of their anchor's k-gram, and only one suffix in
about seventy, those at anchors, takes part. An anchor stands for a block of neighbouring strings.

* Anchors whose k-gram occurs once are dropped; blocks equal as a whole, by a 128-bit hash of their bytes, are settled
  by counting.
* Blocks that share an anchor but differ are told apart by sorting. The text behind the anchor and the
  text before it (backwards) are each sorted by mergesort; two suffixes are compared through prefix
  polynomial hashes, where a binary search finds their common extension in a logarithm of its
  length. The bytes of neighbours in the order are compared with the claimed extension; a group with a
  collision is sorted by its bytes. Two strings of a group at the same place before the anchor are equal
  exactly if they share a run of both orders with long enough extensions.
* A group of very many blocks is split: its strings are counted one by one under a 128-bit hash of their own bytes.

Removed are the bytes of all strings found twice; matches do not cross documents. Texts are known by a 128-bit hash
of their bytes, so copies of a text share their spans. Polynomial hashes only choose anchors, bring strings together
and steer the sort, whose result is compared byte by byte; no two strings count as equal because such hashes are.

Defined results: null is the empty text. Texts shorter than ``length`` lose nothing. Repeated rows are copies
of each other, so they lose all their strings. No rows give no rows. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.llm.arrow_text import (
    bounded_batches,
    digests,
    flat_bytes,
    mix64,
    prefix_hashes,
    ragged,
    slices,
    span_hashes,
    texts_of,
)
from millrace.scratch import stage

LENGTH = 200
#: Bytes of the k-gram at an anchor.
ANCHOR_BYTES = 64
#: Groups of more blocks are counted string by string.
GROUP_BLOCKS = 1000
#: Blocks sorted together in a task, in whole groups.
SORT_BLOCKS = 20_000

#: Both halves of the hash that stands for a text, and for a block with the place of its anchor.
TEXT = ["text_id", "text_mark"]
HULL = ["hull", "hull_mark"]

_PLACE_BITS = 23


def _least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes the place of the least; of equal ones the first."""
    count = len(hashes) - width + 1
    places = np.empty(max(0, count), np.int64)
    step = (1 << _PLACE_BITS) - width
    for first in range(0, max(0, count), step):
        part = hashes[first : first + step + width - 1]
        low = np.uint64((1 << _PLACE_BITS) - 1)
        least = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        span = 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if width > span:
            least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
        places[first : first + len(least)] = first + (least & low).astype(np.int64)
    return places


def blocks_of(
    data: np.ndarray, offsets: np.ndarray, sums: np.ndarray, length: int, anchor: int
) -> tuple[np.ndarray, ...]:
    """Blocks as text number, first string, number of strings, anchor behind the first and key.

    Places count from the first byte of ``data``.
    """
    if len(data) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    at = np.arange(len(data) - anchor + 1)
    grams = mix64(span_hashes(sums, at, at + anchor))
    least = _least_places(grams, length - anchor + 1)
    first = ragged(offsets[:-1], np.maximum(np.diff(offsets) - length + 1, 0))  # where a string begins
    if not len(first):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    place = least[first]
    new = np.ones(len(first), bool)
    new[1:] = (place[1:] != place[:-1]) | (first[1:] != first[:-1] + 1)
    begin = np.flatnonzero(new)
    low, many = first[begin], np.diff(np.append(begin, len(first)))
    where = place[begin]
    text = np.searchsorted(offsets, low, side="right") - 1
    return text, low, many, where - low, grams[where].view(np.int64)


def _pair(hashes: np.ndarray) -> list[pa.Array]:
    return [pa.array(np.ascontiguousarray(hashes[:, k])) for k in range(2)]


def _longs(names: list[str]) -> str:
    return ", ".join(f"{n} long" for n in names)


def _anchored(documents: DataFrame, length: int, anchor: int, keys_only: bool) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = flat_bytes(texts_of(part, "text"))
                text, low, many, behind, key = blocks_of(data, offsets, prefix_hashes(data), length, anchor)
                if keys_only:
                    yield pa.RecordBatch.from_arrays([pa.array(key)], ["key"])
                    continue
                ids = digests(data, offsets[:-1], offsets[1:])[text]
                hulls = digests(data, low, low + many - 1 + length, behind)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key),
                        *_pair(hulls),
                        *_pair(ids),
                        pa.array((low - offsets[text]).astype(np.int32)),
                        pa.array(many.astype(np.int16)),
                        pa.array(behind.astype(np.int16)),
                    ],
                    ["key", *HULL, *TEXT, "low", "many", "behind"],
                )

    schema = "key long" if keys_only else f"key long, {_longs(HULL)}, {_longs(TEXT)}, low int, many short, behind short"
    return bounded_batches(documents).select("text").mapInArrow(find, schema)


def _named(documents: DataFrame) -> DataFrame:
    """Add the hash of the text to the columns of ``documents``."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = flat_bytes(texts_of(part, "text"))
                ids = digests(data, offsets[:-1], offsets[1:])
                yield pa.RecordBatch.from_arrays([*part.columns, *_pair(ids)], [*part.schema.names, *TEXT])

    fields = [*documents.schema.fields, *[T.StructField(c, T.LongType()) for c in TEXT]]
    return bounded_batches(documents).mapInArrow(name, T.StructType(fields))


class Suffixes:
    """Strings in a row with prefix hashes; sorts them inside groups by hash comparisons."""

    def __init__(self, pieces: list[bytes]):
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(pieces), np.uint8)
        self.sums = prefix_hashes(self.data)
        self.steps = [1 << k for k in range(int(self.lengths.max(initial=1)).bit_length() - 1, -1, -1)]

    def common(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Length of the common extension, by binary search on prefix hashes."""
        limit = np.minimum(self.lengths[one], self.lengths[two])
        a, b = self.starts[one], self.starts[two]
        found = np.zeros(len(one), np.int64)
        for step in self.steps:
            longer = found + step
            fits = np.flatnonzero(longer <= limit)
            same = span_hashes(self.sums, a[fits], a[fits] + longer[fits]) == span_hashes(
                self.sums, b[fits], b[fits] + longer[fits]
            )
            found[fits[same]] = longer[fits[same]]
        return found

    def before(self, one: np.ndarray, two: np.ndarray, equal: np.ndarray) -> np.ndarray:
        """Whether each first string stands before the second (or is equal to it, where ``equal`` is set)."""
        shared = self.common(one, two)
        ended_one, ended_two = shared == self.lengths[one], shared == self.lengths[two]
        inside = ~(ended_one | ended_two)
        less = np.where(ended_one, ~ended_two | equal, False)
        at = np.flatnonzero(inside)
        less[at] = self.data[self.starts[one[at]] + shared[at]] < self.data[self.starts[two[at]] + shared[at]]
        return less

    def sort(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order inside each run of equal ``group`` by mergesort, and each row's extension with the row before."""
        n = len(group)
        new = np.ones(n, bool)
        new[1:] = group[1:] != group[:-1]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, n))
        of = np.repeat(np.arange(len(first)), size)
        begin, end = first[of], (first + size)[of]
        order, place, width = np.arange(n), np.arange(n), 1
        while width < size.max(initial=0):
            rows = np.flatnonzero(size[of] > width)  # places whose group still has two runs
            inner = place[rows] - begin[rows]
            run = inner // width
            left = run % 2 == 0
            pair = begin[rows] + (run // 2) * 2 * width
            low = np.where(left, pair + width, pair)
            high = np.minimum(np.where(left, pair + 2 * width, pair + width), end[rows])
            low = np.minimum(low, high)
            start, mine = low.copy(), order[rows]
            while len(at := np.flatnonzero(low < high)):
                middle = (low[at] + high[at]) // 2
                # A row of the left run stands before its equals of the right one.
                less = self.before(order[middle], mine[at], ~left[at])
                low[at] = np.where(less, middle + 1, low[at])
                high[at] = np.where(less, high[at], middle)
            merged = pair + inner % width + (low - start)
            after = order.copy()
            after[merged] = mine
            order, width = after, width * 2
        shared = np.zeros(n, np.int64)
        inside = np.flatnonzero(~new)
        shared[inside] = self.common(order[inside - 1], order[inside])
        for g in np.unique(of[self._collisions(order, inside, shared)]):  # of a hash; sort these by their bytes
            rows = np.arange(first[g], first[g] + size[g])
            texts = {r: self.data[self.starts[r] : self.starts[r] + self.lengths[r]].tobytes() for r in rows}
            order[rows] = sorted(rows, key=texts.get)
            for a, b in zip(rows[:-1], rows[1:], strict=True):
                one, two = texts[order[a]], texts[order[b]]
                alike = [x != y for x, y in zip(one, two, strict=False)] + [True]
                shared[b] = alike.index(True)
        return order, shared

    def _collisions(self, order: np.ndarray, rows: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """Rows that do not share the claimed extension with the row before, byte by byte, or stand before it."""
        one, two, length = order[rows - 1], order[rows], shared[rows]
        a, b = ragged(self.starts[one], length), ragged(self.starts[two], length)
        owner = np.repeat(np.arange(len(rows)), length)
        wrong = np.zeros(len(rows), bool)
        wrong[owner[self.data[a] != self.data[b]]] = True
        # Behind what they share, the first ends or has the smaller byte; a collision may also have misled the merge.
        goes_on, ended = length < self.lengths[one], length >= self.lengths[two]
        wrong |= goes_on & ended
        at = np.flatnonzero(goes_on & ~ended)
        wrong[at] |= self.data[self.starts[one[at]] + length[at]] >= self.data[self.starts[two[at]] + length[at]]
        return rows[wrong]


def repeated_strings(rows: pa.Table, length: int) -> np.ndarray:
    """Which strings of each block are found in another block of its group.

    A row of flags for each block, by the place of the string before the anchor.
    """
    _, group = np.unique(rows["key"].to_numpy(), return_inverse=True)
    texts, behind = rows["context"].to_pylist(), rows["behind"].to_numpy().astype(np.int64)
    many = rows["many"].to_numpy().astype(np.int64)
    width = int(behind.max()) + 1
    classes = []
    for pieces in (
        [t[b:] for t, b in zip(texts, behind, strict=True)],
        [t[:b][::-1] for t, b in zip(texts, behind, strict=True)],
    ):
        classes.append(Suffixes(pieces).sort(group))
    flags = np.zeros((len(texts), width), bool)
    labels = np.empty((2, len(texts)), np.int64)
    for before in range(width):  # the string begins so many bytes before the anchor
        valid = np.flatnonzero((before <= behind) & (before > behind - many))
        if len(valid) < 2:
            continue
        for side, ((order, shared), least) in enumerate(zip(classes, (length - before, before), strict=True)):
            breaks = shared < least
            if least == 0:  # nothing before the anchor: one run for each group
                breaks = np.diff(group[order], prepend=-1) != 0
            labels[side, order] = np.cumsum(breaks)
        code = labels[0, valid] * (len(texts) + 1) + labels[1, valid]
        _, which, held = np.unique(code, return_inverse=True, return_counts=True)
        flags[valid, before] = held[which] > 1
    return flags


_CONTEXT = f"key long, {_longs(TEXT)}, low int, many short, behind short, n long, blocks long, context binary"
_SPAN = f"{_longs(TEXT)}, low int, many int"


def _contexts(documents: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of one block of each (key, hull) in ``wanted``."""
    texts = _named(documents.select("text")).groupBy(*TEXT).agg(F.first("text").alias("text"))
    of_text = wanted.groupBy(*TEXT).agg(
        F.collect_list(F.struct("key", "low", "many", "behind", "n", "blocks")).alias("open")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                lists, texts_here = part.column("open"), texts_of(part, "text")
                blocks = pc.list_flatten(lists)
                of = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
                data, offsets = flat_bytes(texts_here)
                low, many = (blocks.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("low", "many"))
                start = offsets[of] + low
                held = [data[a:b].tobytes() for a, b in zip(start, start + many - 1 + length, strict=True)]
                parents = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [
                        blocks.field("key"),
                        *[part.column(c).take(parents) for c in TEXT],
                        *[blocks.field(c) for c in ("low", "many", "behind", "n", "blocks")],
                        pa.array(held, pa.binary()),
                    ],
                    ["key", *TEXT, "low", "many", "behind", "n", "blocks", "context"],
                )

    return texts.join(of_text, TEXT).mapInArrow(cut, _CONTEXT)


def _sorted_spans(contexts: DataFrame, length: int) -> DataFrame:
    """Spans of strings of single blocks that other blocks of the group hold too."""

    def settle(rows: pa.Table) -> pa.RecordBatch:
        flags = repeated_strings(rows, length)
        flags[rows["n"].to_numpy() > 1] = False  # settled by counting
        edge = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, first = np.nonzero(edge == 1)
        _, stop = np.nonzero(edge == -1)
        begin = rows["low"].to_numpy()[row] + rows["behind"].to_numpy()[row] - (stop - 1)
        return pa.RecordBatch.from_arrays(
            [
                *[rows[c].combine_chunks().take(pa.array(row)) for c in TEXT],
                pa.array(begin.astype(np.int32)),
                pa.array((stop - first).astype(np.int32)),
            ],
            [*TEXT, "low", "many"],
        )

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < SORT_BLOCKS:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            key = rows["key"].to_numpy()
            whole = int(np.searchsorted(key, key[-1]))  # the last group may go on
            if whole:
                yield settle(rows.slice(0, whole))
            held = rows.slice(whole).to_batches()
            n = len(rows) - whole
        if n:
            yield settle(pa.Table.from_batches(held).combine_chunks())

    return contexts.repartition("key").sortWithinPartitions("key").mapInArrow(sort, _SPAN)


def _counted_spans(contexts: DataFrame, length: int) -> DataFrame:
    """The same for groups of very many blocks: each string is counted under its own hash."""
    name = ["name", "name_mark"]

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "context"):
                data, offsets = flat_bytes(part.column("context").cast(pa.large_binary()))
                many = part.column("many").to_numpy().astype(np.int64)
                row, inner = np.repeat(np.arange(len(many)), many), ragged(np.zeros(len(many), np.int64), many)
                start = offsets[row] + inner
                names = digests(data, start, start + length)
                rows = pa.array(row)
                low = part.column("low").to_numpy()[row] + inner
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key").take(rows),
                        *_pair(names),
                        *[part.column(c).take(rows) for c in TEXT],
                        pa.array(low.astype(np.int32)),
                        part.column("n").take(rows),
                    ],
                    ["key", *name, *TEXT, "low", "n"],
                )

    strings = contexts.mapInArrow(explode, f"key long, {_longs(name)}, {_longs(TEXT)}, low int, n long")
    counted = strings.groupBy(*name).agg(F.sum("n").alias("all"))
    twice = stage(counted.where("all > 1").drop("all"), "strings")
    return strings.where("n = 1").join(twice, name).select(*TEXT, "low", F.lit(1).alias("many"))


def repeated_spans(documents: DataFrame, length: int = LENGTH, anchor: int = ANCHOR_BYTES) -> DataFrame:
    """The hash of each text and the starts of its repeated strings as ``spans`` of (low, many)."""
    keys = _anchored(documents, length, anchor, keys_only=True).groupBy("key").agg(F.count("*").alias("times"))
    # Written first: Spark splits a hot key of a join only if no aggregation stands under it.
    twice = stage(keys.where("times > 1").select("key"), "keys")
    blocks = _anchored(documents, length, anchor, keys_only=False)
    shared = stage(blocks.join(twice, "key"), "blocks")
    place = F.min(F.struct(*TEXT, "low", "many", "behind")).alias("place")
    hulls = stage(shared.groupBy("key", *HULL).agg(F.count("*").alias("n"), place), "hulls")
    whole = shared.join(hulls.where("n > 1").select("key", *HULL), ["key", *HULL])
    groups = hulls.groupBy("key").agg(F.count("*").alias("blocks"), F.min("n").alias("least"))
    wanted = hulls.join(stage(groups.where("blocks > 1 and least = 1").drop("least"), "groups"), "key")
    contexts = stage(_contexts(documents, wanted.select("key", "n", "blocks", "place.*"), length), "contexts")
    found = whole.select(*TEXT, "low", F.col("many").cast("int").alias("many"))
    found = found.union(_sorted_spans(contexts.where(F.col("blocks") <= GROUP_BLOCKS), length))
    found = found.union(_counted_spans(contexts.where(F.col("blocks") > GROUP_BLOCKS), length))
    # Copies of a text find the same strings, so a text has no more of them than bytes.
    once = found.groupBy(*TEXT, "low").agg(F.max("many").alias("many"))
    return once.groupBy(*TEXT).agg(F.collect_list(F.struct("low", "many")).alias("spans"))


def without_repeats(documents: DataFrame, length: int = LENGTH, anchor: int = ANCHOR_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed ``spans`` (first, end) in bytes."""
    spans = stage(repeated_spans(documents, length, anchor), "repeats")
    named = _named(documents.select("doc_id", "text")).join(spans, TEXT, "left")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = flat_bytes(texts_of(part, "text"))
                lists = part.column("spans")
                found = pc.list_flatten(lists)
                of = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
                low, many = (found.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("low", "many"))
                covered = np.zeros(len(data) + 1, np.int64)
                np.add.at(covered, offsets[of] + low, 1)
                np.add.at(covered, offsets[of] + low + many - 1 + length, -1)
                gone = np.cumsum(covered[:-1]) > 0
                rows = []
                for first, end in zip(offsets[:-1], offsets[1:], strict=True):
                    mine = gone[first:end]
                    edge = np.diff(np.concatenate(([0], mine.view(np.int8), [0])))
                    cuts = np.stack((np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)), axis=1)
                    rest = hashlib.sha256(data[first:end][~mine].tobytes()).hexdigest()
                    rows.append((int(end - first), int(mine.sum()), len(cuts), rest, cuts.tolist()))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
                pairs = pa.list_(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        *[pa.array(c, pa.int64()) for c in columns[:3]],
                        pa.array(columns[3], pa.string()),
                        pa.array(columns[4], pairs),
                    ],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
                )

    fields = T.StructType.fromDDL(
        "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<int>>"
    ).fields
    schema = T.StructType([T.StructField("doc_id", documents.schema["doc_id"].dataType), *fields])
    return named.select("doc_id", "text", "spans").mapInArrow(remove, schema)


def suffixes_query(spark, sf_dir: str) -> DataFrame:
    """What every document loses and keeps."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return without_repeats(documents).drop("spans")
