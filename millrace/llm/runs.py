"""Periodic runs of words, found by common extensions over a difference cover.

A run is a stretch of words with smallest period q, at least ``max(MIN_WORDS, MIN_EXPONENT * q)`` words long,
that no neighbouring word extends. All documents of a slice are searched together:

* Words get numbers. Of the suffixes only those at places whose remainder modulo 31 lies in a difference cover
  are sorted (6 of 31), apart for each document: by their first 31 words, then by prefix doubling among
  what is still tied. The names of each doubling give the common extension of neighbours in the order.
* The common extension of any two places: a shift of at most 30 words brings both into the cover, so up to so
  many words are compared, and what is equal that far goes on with the least neighbour extension between the
  two, from a sparse table over blocks.
* Harmonic grid: for every period q the places 0, 2q, 4q, … are compared with those q words later, n / 2q
  comparisons each. A run agrees with itself q words later for at least 3q words, so its first grid place
  agrees for more than q words from there on; the run's begin is found by binary search over
  extensions. A stretch that has a smaller period is found under it with the same bounds; the smallest stays.

Defined results: a null text has no words; texts without words or runs keep all. Repeated rows are documents
each. No rows give no rows. A text beyond the slice size is searched alone, in memory in proportion to it.
Other columns are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.llm.arrow_text import BLANKS, bounded_batches, flat_bytes, placed_words, ragged, slices, texts_of

#: Fewest words of a run, and how many times its period it holds at least.
MIN_WORDS = 6
MIN_EXPONENT = 4

#: Remainders whose differences give every remainder modulo COVER_STEP.
COVER_STEP = 31
COVER = np.array([0, 1, 3, 8, 12, 18])
#: Grid places compared at once.
GRID_POINTS = 1 << 20
_BLOCK = 16


def _shifts() -> np.ndarray:
    """For two remainders the least shift that brings both into the cover."""
    covered = np.isin(np.arange(2 * COVER_STEP) % COVER_STEP, COVER)
    both = covered[np.arange(COVER_STEP)[:, None] + np.arange(COVER_STEP)]  # remainder, shift
    return np.argmax(both[:, None, :] & both[None, :, :], axis=2)


_SHIFT = _shifts()
_SLOT = np.zeros(COVER_STEP, np.int64)
_SLOT[COVER] = np.arange(len(COVER))


class RangeMin:
    """Least value of any range: a sparse table over blocks, and running minima inside them."""

    def __init__(self, values: np.ndarray):
        whole = -(-max(1, len(values)) // _BLOCK) * _BLOCK
        self.values = np.full(whole, np.iinfo(np.int32).max, np.int32)
        self.values[: len(values)] = values
        blocks = self.values.reshape(-1, _BLOCK)
        self.left = np.minimum.accumulate(blocks, axis=1).ravel()
        self.right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [blocks.min(axis=1)]
        while len(self.table[-1]) > 1 << len(self.table) - 1:
            below, span = self.table[-1], 1 << len(self.table) - 1
            self.table.append(np.minimum(below[:-span], below[span:]))

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minima of values[low] … values[high], both included."""
        one, two = low // _BLOCK, high // _BLOCK
        least = np.minimum(self.right[low], self.left[high])
        same = np.flatnonzero(one == two)
        least[same] = self.values[low[same]]
        for step in range(1, _BLOCK):
            same = same[low[same] + step <= high[same]]
            least[same] = np.minimum(least[same], self.values[low[same] + step])
        apart = np.flatnonzero(two - one > 1)
        wide = two[apart] - one[apart] - 1
        level = np.frexp(wide)[1] - 1
        for k in np.unique(level):
            at = apart[level == k]
            inner = np.minimum(self.table[k][one[at] + 1], self.table[k][two[at] - (1 << k)])
            least[at] = np.minimum(least[at], inner)
        return least


class Extensions:
    """Common extensions of places inside documents.

    ``codes`` are the words as numbers from 1 on, with a 0 behind each document; ``ends`` are the places of the 0s.
    """

    def __init__(self, codes: np.ndarray, ends: np.ndarray):
        self.codes = codes
        blocks = -(-len(codes) // COVER_STEP)
        places = (np.arange(blocks)[:, None] * COVER_STEP + COVER).ravel()
        self.places = places[places < len(codes)]
        document = np.searchsorted(ends, self.places)
        self.ends = ends[document]
        self.rank, levels = self._sorted(document)
        self.least = RangeMin(self._neighbours(document, levels))

    def _sorted(self, document: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Rank of each covered suffix by document and words, and the names of each doubling."""
        rank = np.searchsorted(document, document).astype(np.int64)  # of the first with this name
        bits = max(1, int(self.codes.max(initial=0)).bit_length())
        at_once = max(1, 32 // bits)
        tied = self._tied(np.arange(len(rank)), rank)
        for offset in range(0, COVER_STEP, at_once):
            key = np.zeros(len(tied), np.int64)
            for word in range(offset, min(COVER_STEP, offset + at_once)):
                key = key << bits | self.codes[np.minimum(self.places[tied] + word, self.ends[tied])]
            tied = self._parted(tied, rank, key)
            if not len(tied):
                break
        levels = [rank.astype(np.int32)]
        while len(tied):
            span = COVER_STEP << len(levels) - 1
            later = tied + (len(COVER) << len(levels) - 1)
            inside = self.places[tied] + span <= self.ends[tied]
            key = np.where(inside, rank[np.where(inside, later, 0)] + 1, 0)
            tied = self._parted(tied, rank, key)
            levels.append(rank.astype(np.int32))
        return rank, levels

    @staticmethod
    def _tied(ids: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Those of ``ids``, in order of rank, that share it with a neighbour."""
        same = rank[ids[1:]] == rank[ids[:-1]]
        return ids[np.concatenate((same, [False])) | np.concatenate(([False], same))] if len(ids) else ids

    def _parted(self, tied: np.ndarray, rank: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Part equal ranks by ``key``; returns what is still tied, in order."""
        joint = rank[tied] << 32 | key
        order = np.argsort(joint, kind="stable")
        tied, joint = tied[order], joint[order]
        old, at = rank[tied], np.arange(len(tied))
        first_old = np.maximum.accumulate(np.where(np.diff(old, prepend=-1) != 0, at, 0))
        first_new = np.maximum.accumulate(np.where(np.diff(joint, prepend=-1) != 0, at, 0))
        rank[tied] = old + first_new - first_old
        return self._tied(tied, rank)

    def _neighbours(self, document: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common extension of each covered suffix with the one before it in order."""
        order = np.empty(len(self.rank), np.int64)
        order[self.rank] = np.arange(len(order))
        shared = np.zeros(len(order), np.int32)
        at = np.flatnonzero(document[order[1:]] == document[order[:-1]]) + 1
        one, two = order[at - 1], order[at]
        for k in range(len(levels) - 1, -1, -1):
            same = np.flatnonzero(levels[k][one] == levels[k][two])
            one[same] += len(COVER) << k
            two[same] += len(COVER) << k
            shared[at[same]] += COVER_STEP << k
        one, two = self.places[one], self.places[two]
        live = np.arange(len(at))
        for word in range(COVER_STEP):
            live = live[self.codes[one[live] + word] == self.codes[two[live] + word]]
            if not len(live):
                break
            shared[at[live]] += 1
        return shared

    def __call__(self, one: np.ndarray, two: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Words that agree from ``one`` and ``two`` on; ``one`` < ``two`` < ``end``, the end of their document."""
        found = np.zeros(len(one), np.int64)
        shift = _SHIFT[one % COVER_STEP, two % COVER_STEP]
        limit = np.minimum(shift, end - two)
        live = np.arange(len(one))
        for word in range(COVER_STEP):
            live = live[limit[live] > word]
            live = live[self.codes[one[live] + word] == self.codes[two[live] + word]]
            if not len(live):
                break
            found[live] += 1
        on = np.flatnonzero((found == shift) & (two + shift < end))
        first, second = (
            self.rank[(x // COVER_STEP) * len(COVER) + _SLOT[x % COVER_STEP]]
            for x in (one[on] + shift[on], two[on] + shift[on])
        )
        found[on] += self.least(np.minimum(first, second) + 1, np.maximum(first, second))
        return found


def find_runs(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Document, start, length and period of every run, by document, start and period.

    ``codes`` are the words of all documents in a row as numbers from 0 on, ``sizes`` the words of each.
    """
    begins = np.cumsum(sizes) - sizes + np.arange(len(sizes))
    padded = np.zeros(len(codes) + len(sizes), np.int64)
    padded[ragged(begins, sizes)] = codes + 1
    extensions = Extensions(padded, begins + sizes)
    most = np.where(sizes >= MIN_WORDS, sizes // MIN_EXPONENT, 0)
    document = np.repeat(np.arange(len(sizes)), most)
    period = ragged(np.ones(len(sizes), np.int64), most)
    points = np.cumsum((sizes[document] - period - 1) // (2 * period) + 1)
    total, found = int(points[-1]) if len(points) else 0, []
    for first in range(0, total, GRID_POINTS):
        point = np.arange(first, min(total, first + GRID_POINTS))
        row = np.searchsorted(points, point, side="right")
        held = points[row] - np.concatenate(([0], points))[row]
        q, begin = period[row], begins[document[row]]
        place = begin + 2 * q * (point - points[row] + held)
        alike = (padded[place] == padded[place + q]) & (padded[place + 1] == padded[place + q + 1])
        at = np.flatnonzero(alike)
        row, q, begin, place = row[at], q[at], begin[at], place[at]
        end = begin + sizes[document[row]]
        agree = extensions(place, place + q, end)
        # The grid place before must not lie in the same stretch.
        before = np.maximum(place - 2 * q, begin)
        fresh = (place == begin) | (extensions(before, before + q, end) < 2 * q)
        at = np.flatnonzero((agree > q) & fresh)
        row, q, begin, place, end, agree = row[at], q[at], begin[at], place[at], end[at], agree[at]
        low, high = np.maximum(place - 2 * q + 1, begin), place.copy()
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_]) // 2
            reach = extensions(middle, middle + q[open_], end[open_]) >= place[open_] - middle
            high[open_] = np.where(reach, middle, high[open_])
            low[open_] = np.where(reach, low[open_], middle + 1)
        length = place + agree + q - low
        at = np.flatnonzero(length >= np.maximum(MIN_WORDS, MIN_EXPONENT * q))
        found.append(np.stack((document[row[at]], low[at] - begin[at], length[at], q[at])))
    runs = np.concatenate([np.zeros((4, 0), np.int64), *found], axis=1)
    runs = runs[:, np.lexsort((runs[3], runs[2], runs[1], runs[0]))]
    fresh = np.ones(runs.shape[1], bool)  # of equal stretches the smallest period comes first
    fresh[1:] = (runs[:3, 1:] != runs[:3, :-1]).any(axis=0)
    runs = runs[:, fresh]
    return tuple(runs[:, np.lexsort((runs[3], runs[1], runs[0]))])


_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def periodic_runs(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, ``runs`` (start, length, period; by start, then period) and the ``collapsed`` text: its words
    joined by a blank, without those that a run holds after its first period."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words, sizes, _ = placed_words(texts_of(part, "text"), BLANKS)
                codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
                document, start, length, period = find_runs(codes, sizes)
                firsts = np.cumsum(sizes) - sizes
                depth = np.zeros(len(codes) + 1, np.int64)
                np.add.at(depth, firsts[document] + start + period, 1)
                np.add.at(depth, firsts[document] + start + length, -1)
                kept = np.cumsum(depth[:-1]) == 0
                bounds = np.concatenate(([0], np.cumsum(np.bincount(document, minlength=len(sizes)))))
                runs = pa.StructArray.from_arrays(
                    [pa.array(x) for x in (start, length, period)], ["start", "length", "period"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(sizes),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs),
                        _joined(words, kept, firsts, sizes),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    fields = T.StructType.fromDDL(f"n_words long, runs {_RUNS}, collapsed string").fields
    schema = T.StructType([T.StructField("doc_id", documents.schema["doc_id"].dataType), *fields])
    return bounded_batches(documents).select("doc_id", "text").mapInArrow(search, schema)


def _joined(words: pa.Array, kept: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The kept words of each document, joined by a blank."""
    data, offsets = flat_bytes(words)
    chosen = np.flatnonzero(kept)
    lengths = offsets[chosen + 1] - offsets[chosen]
    before = np.concatenate(([0], np.cumsum(kept)))
    many = before[firsts + sizes] - before[firsts]
    # A blank follows each word but the last of its document.
    last = np.zeros(len(chosen), bool)
    last[np.cumsum(many)[many > 0] - 1] = True
    ends = np.cumsum(lengths + ~last)
    flat = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    flat[ragged(ends - lengths - ~last, lengths)] = data[ragged(offsets[chosen], lengths)]
    bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(many)))]
    texts = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(flat))
    return texts.cast(pa.string())


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """doc_id and text, where about one document in ten repeats its words from some place on.

    With h the crc32 of doc_id as text and g = h div 10: if h mod 10 is 0, each of the n words from a = g mod n on
    becomes word a + (i - a) mod p, where p = 1 + (n - a) div (3 + g mod 8). A null doc_id changes nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = documents.select("doc_id", "text", h.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w != '')"))
    )
    a, n, g = F.col("a"), F.size("words"), F.expr("h div 10")
    placed = chosen.withColumn("a", F.when(n > 0, g % n)).withColumn(
        "p", F.when(n > 0, 1 + F.call_function("div", (n - a).cast("long"), 3 + g % 8))
    )
    planted = F.expr(
        "array_join(transform(sequence(0, size(words) - 1),"
        " i -> element_at(words, cast(if(i < a, i, a + (i - a) % p) + 1 as int))), ' ')"
    )
    return placed.select("doc_id", F.when(F.size("words") > 0, planted).otherwise(F.col("text")).alias("text"))


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def runs_query(spark, sf_dir: str) -> DataFrame:
    """The runs of every document, as counts and digests."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    best = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start as start, -r.period as period)))")
    lines = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\\n'), '')")
    found = periodic_runs(with_planted_runs(documents)).withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        _digest(lines).alias("runs_sha256"),
        _digest(F.col("collapsed")).alias("collapsed_sha256"),
    )
