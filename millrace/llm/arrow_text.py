"""Small helpers for text inside Arrow batches: slices of bounded size, flat bytes, words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

from millrace.functions.batches import bounded_batches  # noqa: F401

#: Text bytes handled at once inside a task; one longer text is handled alone.
SLICE_BYTES = 2 << 20


def texts_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """The text column with empty strings for nulls."""
    return compact(batch.column(column))


def compact(texts: pa.Array) -> pa.Array:
    """A large_string array with empty strings for nulls, its bytes counted from 0.

    Arrow's string functions misread offsets that a cast of a slice leaves beyond 0.
    """
    data, offsets = flat_bytes(pc.fill_null(texts.cast(pa.large_string()), ""))
    return pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))
    )


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of at most ``limit`` text bytes, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for row, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(first, row - first)
            first, held = row, 0
        held += int(size)
    if first < len(sizes):
        yield batch.slice(first)


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a large_string array in a row, and the offset of each text (one more than texts)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def spaced_words(texts: pa.Array, is_space: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words between bytes for which ``is_space`` (256 flags) holds, and how many each text has.

    The words come as one large_string array in reading order.
    """
    words, counts, _ = placed_words(texts, is_space)
    return words, counts


def placed_words(
    texts: pa.Array, is_space: np.ndarray, kinds: np.ndarray | None = None
) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """As :func:`spaced_words`, with the byte at which each word begins, counted over all texts.

    With ``kinds``, a number for each byte value, words are also cut where 1 and 2 stand side by side.
    """
    data, offsets = flat_bytes(texts)
    inside = ~is_space[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    begins[cuts] = inside[cuts]  # a text's first byte begins a word even if the text before ends in one
    if kinds is not None:
        kind = kinds[data]
        begins[1:] |= (kind[1:] + kind[:-1] == 3) & (kind[1:] != 0) & (kind[:-1] != 0)
    starts = np.flatnonzero(begins)
    ends_at = inside.copy()
    ends_at[:-1] &= begins[1:] | ~inside[1:]
    ends = np.flatnonzero(ends_at) + 1
    counts = np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])
    lengths = ends - starts
    packed = data[inside]
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    words = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(packed)
    )
    return words, counts, starts


def byte_flags(*ranges: tuple[int, int]) -> np.ndarray:
    """256 flags that are set in the given inclusive ranges."""
    flags = np.zeros(256, bool)
    for low, high in ranges:
        flags[low : high + 1] = True
    return flags


#: What parts words of the form [^\x20\x09-\x0D]+.
BLANKS = byte_flags((0x20, 0x20), (0x09, 0x0D))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, … of every run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def cut_strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The strings data[start:end] as a large_binary array."""
    sizes = ends - starts
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data[ragged(starts, sizes)])]
    )


def digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seeds: np.ndarray | None = None) -> np.ndarray:
    """XXH3-128 of the bytes of each string data[start:end], as two columns of 64-bit integers."""
    view, digest = memoryview(np.ascontiguousarray(data)), xxhash.xxh3_128_digest
    spans = zip(starts.tolist(), ends.tolist(), strict=True)
    if seeds is None:
        found = [digest(view[a:b]) for a, b in spans]
    else:
        found = [digest(view[a:b], seed) for (a, b), seed in zip(spans, seeds.tolist(), strict=True)]
    return np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit integers (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores in front until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


#: Base of the polynomial hashes; odd, so it has an inverse modulo 2 ** 64.
POLY_BASE = 0x5851F42D4C957F2D
_POLY_INVERSE = pow(POLY_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers_of(base: int, count: int) -> np.ndarray:
    """base ** 0 … base ** (count - 1) modulo 2 ** 64; kept for the next call."""
    known = _powers.get(base)
    if known is None or len(known) < count:
        held = 0 if known is None else len(known)
        known = np.full(max(count, 1 << 16, min(2 * held, SLICE_BYTES + 1)), np.uint64(base), np.uint64)
        known[0] = 1
        _powers[base] = known = np.multiply.accumulate(known)
    return known[:count]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes modulo 2 ** 64 of all prefixes of ``data`` (one more than bytes)."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers_of(POLY_BASE, len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], equal for equal bytes wherever they stand."""
    inverse = powers_of(_POLY_INVERSE, len(sums))
    return (sums[ends] - sums[starts]) * inverse[starts]


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string."""
    data, offsets = flat_bytes(words)
    return mix64(span_hashes(prefix_hashes(data), offsets[:-1], offsets[1:]) + np.diff(offsets).astype(np.uint64))
