"""Benchmark decontamination with an FM-index of every shard of training text.

A shard is a run of documents of a few MB. Its words become symbols of the alphabet that the test
phrases use; all other words are breaks, and stretches between breaks that are shorter than the
shortest phrase hold none and are left out. The rest is sorted by suffixes, its Burrows-Wheeler
transform is kept as a wavelet tree, and every suffix position divisible by a step, and the first
of each stretch, is sampled. All phrases are searched backwards at once, occurrences are located by
walking to a sampled position, and the words they cover are merged to spans.

Phrases are the windows of 13 words of each item, or the whole item if it has fewer. They reach the
tasks in parts of bounded size; a document passes from part to part, so no row is matched by id.

Defined results: words are runs of ASCII letters (A-Z lower-cased), digits and non-ASCII
characters. Null and empty texts have no words. An item without words has no phrase; an item
without id covers words but is not listed; items with the same id are one. Repeated documents are
judged each. Without benchmark rows nothing is hit. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.llm.arrow_text import bounded_batches, byte_flags, compact, flat_bytes, free_name, placed_words, ragged, slices, texts_of
from millrace.scratch import stage

WINDOW_WORDS = 13
#: Text bytes of benchmark items in one broadcast part.
PART_BYTES = 8 << 20
#: Text bytes of documents under one index.
SHARD_BYTES = 8 << 20
#: Every so manieth suffix position is kept.
SAMPLE_STEP = 8
#: Parts that are searched in one pass over the documents.
PARTS_A_PASS = 4

_SEPARATORS = ~byte_flags((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling. 0 is a break; no two breaks are equal, and the last symbol is one."""
    n = len(symbols)
    breaks = symbols == 0
    key = symbols.astype(np.int64) + int(breaks.sum())
    key[breaks] = np.arange(int(breaks.sum()))
    order = np.argsort(key, kind="stable")
    rank, step = np.empty(n, np.int64), 1

    def settle(order: np.ndarray, new: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Give each run of equal keys the place of its first row; return what is still tied."""
        at = np.flatnonzero(new)
        lengths = np.diff(np.append(at, len(order)))
        rank[order] = np.repeat(first[at], lengths)
        return np.repeat(lengths > 1, lengths)

    new = np.ones(n, bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    places = np.arange(n)
    tied = settle(order, new, places)
    rows, places = order[tied], places[tied]
    while len(rows):
        major, minor = rank[rows], rank[rows + step]
        by = np.lexsort((minor, major))
        rows, major, minor = rows[by], major[by], minor[by]
        new = np.ones(len(rows), bool)
        new[1:] = (major[1:] != major[:-1]) | (minor[1:] != minor[:-1])
        tied = settle(rows, new, places)
        rows, places, step = rows[tied], places[tied], step * 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    return suffixes


class WaveletTree:
    """Ranks of symbols in a sequence, one bit of the symbols on each level."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.bits = max(1, int(symbols - 1).bit_length())
        self.ones: list[np.ndarray] = []
        row = sequence
        for level in range(self.bits - 1, -1, -1):
            bit = (row >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int32))
            row = np.concatenate((row[bit == 0], row[bit == 1]))

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each end."""
        first = np.zeros(len(symbol), np.int64)
        end = end.astype(np.int64)
        for depth, ones in enumerate(self.ones):
            zeros = len(ones) - 1 - int(ones[-1])
            up = ((symbol >> (self.bits - 1 - depth)) & 1).astype(bool)
            first = np.where(up, zeros + ones[first], first - ones[first])
            end = np.where(up, zeros + ones[end], end - ones[end])
        return end - first


class FMIndex:
    """Search and location of phrases in symbols between breaks (0); begins and ends with a break."""

    def __init__(self, symbols: np.ndarray, alphabet: int, step: int = SAMPLE_STEP):
        suffixes = suffix_order(symbols)
        self.last = symbols[suffixes - 1]  # the symbol before each suffix; before the first, a break
        self.tree = WaveletTree(self.last, alphabet)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=alphabet))))
        kept = suffixes % step == 0
        kept |= self.last == 0
        self.sampled = np.where(kept, suffixes, -1)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end row of the suffixes that begin with each phrase (rows padded with 0 in front)."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), len(self.last), np.int64)
        for k in range(phrases.shape[1] - 1, -1, -1):
            at = np.flatnonzero((phrases[:, k] > 0) & (high > low))
            if not len(at):
                continue
            symbol = phrases[at, k]
            low[at] = self.before[symbol] + self.tree.rank(symbol, low[at])
            high[at] = self.before[symbol] + self.tree.rank(symbol, high[at])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text position of each suffix row."""
        position, walked = np.empty(len(rows), np.int64), 0
        left = np.arange(len(rows))
        while len(left):
            known = self.sampled[rows]
            here = known >= 0
            position[left[here]] = known[here] + walked
            left, rows = left[~here], rows[~here]
            symbol = self.last[rows]
            rows = self.before[symbol] + self.tree.rank(symbol, rows)
            walked += 1
        return position


@dataclass(frozen=True)
class Phrases:
    """Distinct phrases as symbol rows, the items of each, and the words of the symbols 1, 2, …"""

    words: pa.Array
    rows: np.ndarray
    items: np.ndarray
    item_ends: np.ndarray
    names: list[str | None]

    @staticmethod
    def of(ids: pa.Array, texts: pa.Array, window: int) -> Phrases:
        texts = compact(texts)
        words, counts, _ = placed_words(pc.ascii_lower(texts), _SEPARATORS)
        coded = words.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1
        held = np.where(counts >= window, counts - window + 1, (counts > 0).astype(np.int64))
        firsts = np.cumsum(counts) - counts
        at, owner = ragged(firsts, held), np.repeat(np.arange(len(counts)), held)
        length = np.minimum(counts, window)[owner]
        rows = np.zeros((len(at), window), np.int32)
        for k in range(window):
            there = k >= window - length
            rows[there, k] = codes[(at + k - window + length)[there]]
        distinct, which = np.unique(rows, axis=0, return_inverse=True)
        which = which.reshape(-1)
        order = np.argsort(which, kind="stable")
        ends = np.concatenate(([0], np.cumsum(np.bincount(which, minlength=len(distinct)))))
        return Phrases(coded.dictionary, distinct, owner[order], ends, ids.cast(pa.string()).to_pylist())


def _hits(texts: pa.Array, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[str]]]:
    """Words of each text, a covered flag and first byte and end of every word, and each text's items."""
    words, counts, starts = placed_words(pc.ascii_lower(texts), _SEPARATORS)
    ends = starts + pc.binary_length(words).to_numpy(zero_copy_only=False)
    covered, items = np.zeros(len(words) + 1, np.int64), [[] for _ in range(len(counts))]
    if len(words) and len(phrases.rows):
        found = pc.index_in(words, value_set=phrases.words)
        symbols = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        text_of = np.repeat(np.arange(len(counts)), counts)
        lengths = (phrases.rows > 0).sum(axis=1)
        known = symbols > 0
        begins = known.copy()
        begins[1:] &= ~known[:-1] | (text_of[1:] != text_of[:-1])
        run_at = np.flatnonzero(begins)
        run = np.cumsum(begins)[known] - 1
        run_length = np.bincount(run, minlength=len(run_at))
        long_enough = run_length >= lengths.min()
        run_at, run_length = run_at[long_enough], run_length[long_enough]
        if len(run_at):
            # One break in front and one after each stretch.
            sizes = run_length + 1
            text = np.zeros(1 + int(sizes.sum()), np.int64)
            place = np.full(len(text), -1, np.int64)
            inside = ragged(1 + np.cumsum(sizes) - sizes, run_length)
            place[inside] = ragged(run_at, run_length)
            text[inside] = symbols[place[inside]]
            index = FMIndex(text, len(phrases.words) + 1)
            low, high = index.search(phrases.rows)
            phrase = np.repeat(np.arange(len(low)), high - low)
            first = place[index.locate(ragged(low, high - low))]
            np.add.at(covered, first, 1)
            np.add.at(covered, first + lengths[phrase], -1)
            many = phrases.item_ends[phrase + 1] - phrases.item_ends[phrase]
            item = phrases.items[ragged(phrases.item_ends[phrase], many)]
            pairs = np.unique(np.stack((np.repeat(text_of[first], many), item)), axis=1)
            for text_number, number in pairs.T:
                if phrases.names[number] is not None:
                    items[text_number].append(phrases.names[number])
    return counts, np.cumsum(covered[:-1]) > 0, np.stack((starts, ends)), items


_SPANS = "array<struct<first:int,end:int>>"


def _search_part(documents: DataFrame, phrases: Phrases, names: tuple[str, ...]) -> DataFrame:
    """Add the columns ``names``, or widen them by the hits of one part."""
    shared = documents.sparkSession.sparkContext.broadcast(phrases)
    n_words, n_hit, spans, items = names
    again = spans in documents.columns
    kept = [c for c in documents.columns if c not in names]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SHARD_BYTES):
                texts = texts_of(part, "text")
                counts, covered, where, found = _hits(texts, shared.value)
                _, offsets = flat_bytes(texts)
                bounds = np.concatenate(([0], np.cumsum(counts)))
                old_spans = part.column(spans).to_pylist() if again else [[]] * len(texts)
                old_items = part.column(items).to_pylist() if again else [[]] * len(texts)
                hits = part.column(n_hit).to_pylist() if again else [0] * len(texts)
                new_spans, new_items = [], []
                for i in range(len(texts)):
                    mine = covered[bounds[i] : bounds[i + 1]].copy()
                    if not mine.any() and not found[i]:
                        new_spans.append(old_spans[i]), new_items.append(old_items[i])
                        continue
                    begin, end = where[:, bounds[i] : bounds[i + 1]] - offsets[i]
                    for span in old_spans[i]:
                        mine |= (begin >= span["first"]) & (end <= span["end"])
                    edge = np.diff(np.concatenate(([0], mine.astype(np.int8), [0])))
                    firsts, lasts = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
                    new_spans.append([{"first": begin[a], "end": end[b]} for a, b in zip(firsts, lasts, strict=True)])
                    hits[i] = int(mine.sum())
                    new_items.append(sorted({*old_items[i], *found[i]}))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c) for c in kept],
                        pa.array(counts, pa.int64()),
                        pa.array(hits, pa.int64()),
                        pa.array(new_spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
                        pa.array(new_items, pa.list_(pa.string())),
                    ],
                    [*kept, n_words, n_hit, spans, items],
                )

    fields = [documents.schema[c] for c in kept]
    added = T.StructType.fromDDL(f"`{n_words}` bigint, `{n_hit}` bigint, `{spans}` {_SPANS}, `{items}` array<string>")
    return bounded_batches(documents).mapInArrow(look, T.StructType([*fields, *added.fields]))


def find_phrases(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, part_bytes: int = PART_BYTES
) -> tuple[DataFrame, tuple[str, ...]]:
    """``documents`` with four columns more, and their names.

    They hold the number of words and of covered words, the merged spans of covered words in UTF-8 bytes of the text, and
    the sorted ids of the items with an occurring phrase.
    """
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // part_bytes) or 1
    names = tuple(free_name(documents, base) for base in ("n_words", "n_hit", "spans", "items"))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for number in range(parts):
        # Holds about part_bytes of text, one longer item apart.
        held = benchmark.where(part == number).select(F.col("item_id").cast("string"), "text").toArrow()
        ids, texts = (held[c].combine_chunks() for c in ("item_id", "text"))
        documents = _search_part(documents, Phrases.of(ids, texts, window), names)
        if number % PARTS_A_PASS == PARTS_A_PASS - 1 and number + 1 < parts:
            documents = stage(documents, "searched")
    return documents, names


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and spans of each document."""
    found, (n_words, n_hit, spans, items) = find_phrases(documents.select("doc_id", "text"), benchmark, window)
    return found.select(
        "doc_id",
        F.col(n_words).alias("n_words"),
        F.col(n_hit).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"),
        _contaminated(n_words, n_hit).alias("contaminated"),
        F.col(spans).alias("spans"),
    )


def _contaminated(n_words: str, n_hit: str) -> Column:
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """Documents of which less than a twentieth of the words, or none, is covered by phrases."""
    found, (n_words, n_hit, _, _) = find_phrases(documents, benchmark, window)
    return found.where(~_contaminated(n_words, n_hit)).select(*documents.columns)


def fmindex_query(spark, sf_dir: str) -> DataFrame:
    """The contamination columns of every document; spans stay with the operator."""
    documents, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contamination(documents, benchmark).drop("spans")


def decontaminate(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the contamination rule names go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
