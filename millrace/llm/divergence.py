"""Quality by distribution divergence: character classes and common words against language references.

The reference of a language is counted over all its documents: a histogram of character classes and one
of common words (those with at least a given share of the language's words; all others are one bin more).
A document is compared with the reference of its language by the Jensen-Shannon distance (base 2, 0 to
1), with the nearest reference if its language is null. Documents of a language without a reference are not
judged by the method. A guard keeps short texts, whose
histograms are noise, from being judged: each histogram counts only from a minimum length on.

Common words are found exactly in two passes. A word with the share s in a language has that share in at
least one slice of the text; every slice reports its words of half that share, and words whose
reports reach half the share of the language are candidates, at most 2 / s of them. The second pass counts
just the candidates of its language in all texts, and those that fall short of the share are left out. Languages need a least number of words to have a reference, whatever
else the corpus holds. Each keeps its own words only, at most 1 / s of them. All references reach every task, so
their size there grows with the number of languages.

Base rules (words are [^\\x20\\x09-\\x0D]+): too few words, or too many in repeated windows of five.

Defined results: a null or empty text has no words and fails the base rules. A null language has no
reference of its own. Without any reference the method keeps all. Repeated rows count as often as they
stand. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.llm.arrow_text import (
    bounded_batches,
    BLANKS,
    byte_flags,
    cut_strings,
    flat_bytes,
    mix64,
    placed_words,
    ragged,
    slices,
    texts_of,
)
from millrace.scratch import stage

MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
#: A word is common in a language from this share of its words on.
COMMON_SHARE = 0.002
#: A language has a reference from so many words on; fewer are no reference.
LANGUAGE_WORDS = 10_000
#: Histograms are judged from so many characters and words on.
GUARD_CHARS = 400
GUARD_WORDS = 100
#: Largest distances of a kept document.
MAX_CHAR_DISTANCE = 0.28
MAX_WORD_DISTANCE = 0.41

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))

#: Class of each byte that begins a character; the bytes behind it in UTF-8 have none (-1).
CHAR_CLASSES = ("vowel", "consonant", "capital", "digit", "blank", "stop", "sign", "control", "latin", "other")


def _class_table() -> np.ndarray:
    table = np.full(256, CHAR_CLASSES.index("sign"), np.int8)
    for name, found in (
        ("control", byte_flags((0x00, 0x1F), (0x7F, 0x7F))),
        ("blank", byte_flags((0x09, 0x0D), (0x20, 0x20))),
        ("digit", byte_flags((0x30, 0x39))),
        ("capital", byte_flags((0x41, 0x5A))),
        ("consonant", byte_flags((0x61, 0x7A))),
        ("vowel", np.isin(np.arange(256), np.frombuffer(b"aeiou", np.uint8))),
        ("stop", np.isin(np.arange(256), np.frombuffer(b".,;:!?'\"-", np.uint8))),
        ("latin", byte_flags((0xC3, 0xC9))),
        ("other", byte_flags((0xC2, 0xC2), (0xCA, 0xFF))),
    ):
        table[found] = CHAR_CLASSES.index(name)
    table[0x80:0xC0] = -1
    return table


_CLASS = _class_table()


def _char_histograms(texts: pa.Array) -> np.ndarray:
    """A row of class counts for each text."""
    data, offsets = flat_bytes(texts)
    kinds = _CLASS[data]
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    seen = kinds >= 0
    width = len(CHAR_CLASSES)
    return np.bincount(owner[seen] * width + kinds[seen], minlength=len(texts) * width).reshape(-1, width)


def _plain_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Lower-cased words without the punctuation at their ends, coded, and how many each text has."""
    words, counts, _ = placed_words(pc.utf8_lower(texts), BLANKS)
    coded = words.dictionary_encode()
    trimmed = pc.utf8_trim(coded.dictionary, ".,;:!?'\"()[]").dictionary_encode()
    indices = pc.take(trimmed.indices, coded.indices)
    return pa.DictionaryArray.from_arrays(indices, trimmed.dictionary), counts


def _repeats(key: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which rows have an equal (owner, key) elsewhere; and which have one before them."""
    order = np.lexsort((np.arange(len(key)), key, owner))
    key, owner = key[order], owner[order]
    again = np.zeros(len(key) + 1, bool)
    again[1:-1] = (key[1:] == key[:-1]) & (owner[1:] == owner[:-1])
    found = np.empty((2, len(key)), bool)
    found[0, order] = again[:-1] | again[1:]
    found[1, order] = again[:-1]
    return found


def base_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    many = len(texts)
    data, offsets = flat_bytes(texts)
    words, counts, _ = placed_words(texts, BLANKS)
    owner = np.repeat(np.arange(many), np.diff(offsets))
    inside = ~BLANKS[data]
    chars = np.bincount(owner[inside & ((data & 0xC0) != 0x80)], minlength=many)
    symbols = np.bincount(owner[_SYMBOLS[data]], minlength=many)
    # Lines: cut at each \n and at each text's end.
    cuts = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate((offsets[:-1], cuts + 1)), kind="stable")
    line_text = np.searchsorted(offsets[1:], starts, side="right")
    behind = np.append(starts[1:], len(data))
    newline = np.zeros(len(data) + 1, bool)
    newline[cuts] = True
    ends = np.where((behind > starts) & newline[np.maximum(behind - 1, 0)], behind - 1, behind)
    worded = np.concatenate(([0], np.cumsum(inside)))
    real = (worded[ends] > worded[starts]) & (line_text < many)
    lines = cut_strings(data, starts[real], ends[real]).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    twice = np.bincount(line_text[real][_repeats(lines, line_text[real])[1]], minlength=many)
    # Windows of five words.
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.uint64)
    held = np.maximum(counts - 4, 0)
    at = ragged(np.cumsum(counts) - counts, held)
    window = np.zeros(len(at), np.uint64)
    for k in range(5):
        window = mix64(window * _GOLDEN + codes[at + k] + np.uint64(1))
    repeated = at[_repeats(window, np.repeat(np.arange(many), held))[0]]
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, repeated, 1)
    np.add.at(covered, repeated + 5, -1)
    word_text = np.repeat(np.arange(many), counts)
    in_window = np.bincount(word_text[np.cumsum(covered[:-1]) > 0], minlength=many)
    return {
        "n_words": counts.astype(np.int64),
        "word_chars": chars,
        "n_symbols": symbols,
        "n_dup_lines": twice,
        "n_repeat_words": in_window,
    }


@dataclass(frozen=True)
class References:
    """Sorted common words of each language, and its histograms of character classes and of those words."""

    common_of: dict[str, pa.Array]
    chars_of: dict[str, np.ndarray]
    words_of: dict[str, np.ndarray]

    @property
    def words(self) -> pa.Array:
        """Common words of any language."""
        return pa.array(sorted({w for own in self.common_of.values() for w in own.to_pylist()}), pa.large_string())

    @property
    def common_in(self) -> dict[str, np.ndarray]:
        """Which of ``words`` are each language's."""
        words = self.words
        return {
            lang: pc.is_in(words, value_set=own).to_numpy(zero_copy_only=False) for lang, own in self.common_of.items()
        }


def _reports(documents: DataFrame) -> DataFrame:
    """lang, word, n of the words common in a slice; words null: all words of the language there."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                langs = part.column("lang").dictionary_encode()
                of_text = langs.indices.to_numpy(zero_copy_only=False)
                coded, counts = _plain_words(texts_of(part, "text"))
                of_word = np.repeat(of_text, counts)
                codes, width = coded.indices.to_numpy(zero_copy_only=False), len(coded.dictionary)
                lang_out, word_out, n_out = [], [], []
                for number, lang in enumerate(langs.dictionary.to_pylist()):
                    found = np.bincount(codes[of_word == number], minlength=width)
                    common = np.flatnonzero(found >= max(1, COMMON_SHARE / 2 * found.sum()))
                    lang_out += [lang] * (len(common) + 1)
                    word_out += [*coded.dictionary.take(pa.array(common)).to_pylist(), None]
                    n_out += [*found[common].tolist(), int(found.sum())]
                columns = [pa.array(lang_out, pa.string()), pa.array(word_out, pa.string()), pa.array(n_out, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

    return bounded_batches(documents).where("lang is not null").select("lang", "text").mapInArrow(report, "lang string, word string, n long")


def language_references(documents: DataFrame) -> References:
    """Count the references over all documents with a language."""
    reports = stage(_reports(documents).groupBy("lang", "word").agg(F.sum("n").alias("n")), "reports")
    totals = reports.where("word is null").select("lang", F.col("n").alias("total"))
    large = totals.where(F.col("total") >= LANGUAGE_WORDS)
    candidates = (
        reports.where("word is not null").join(large, "lang").where(F.col("n") >= COMMON_SHARE / 2 * F.col("total"))
    )
    known = sorted(r.lang for r in large.select("lang").collect())
    listed = candidates.select("lang", "word").toArrow()  # at most 2 / COMMON_SHARE a language
    common_of = {lang: pa.array([], pa.large_string()) for lang in known}
    for lang, words in _by_language(listed):
        common_of[lang] = pa.array(sorted(words.column("word").to_pylist()), pa.large_string())
    shared = documents.sparkSession.sparkContext.broadcast(common_of)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common_of, held = shared.value, {}
        for batch in batches:
            for part in slices(batch, "text"):
                texts = texts_of(part, "text")
                chars, words = _char_histograms(texts), _plain_words(texts)
                for lang, mine in _rows_of(part.column("lang")):
                    if lang in common_of:
                        bins = _word_histograms(words, mine, common_of[lang])
                        found = np.concatenate((chars[mine].sum(axis=0), bins.sum(axis=0)))
                        held[lang] = held[lang] + found if lang in held else found
        offsets = np.cumsum([0, *map(len, held.values())])
        flat = np.concatenate([np.zeros(0, np.int64), *held.values()])
        rows = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.string()), rows], ["lang", "counts"])

    counted = documents.where("lang is not null").select("lang", "text").mapInArrow(count, "lang string, counts array<long>")
    sums = (
        counted.select("lang", F.posexplode("counts").alias("bin", "n")).groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    )
    width = len(CHAR_CLASSES)
    chars, bins = {}, {}
    for lang, rows in _by_language(sums.toArrow()):  # languages times bins
        found = np.zeros(width + len(common_of[lang]) + 1, np.int64)
        found[rows.column("bin").to_numpy()] = rows.column("n").to_numpy()
        counts, total = found[width:-1], found[width:].sum()
        common = np.flatnonzero(counts >= COMMON_SHARE * total)
        common_of[lang] = common_of[lang].take(pa.array(common))
        chars[lang], bins[lang] = found[:width], np.append(counts[common], total - counts[common].sum())
    return References(common_of, chars, bins)


def _by_language(table: pa.Table) -> Iterator[tuple[str, pa.Table]]:
    """The rows of each language, without a pass over the table for each."""
    table = table.sort_by("lang")
    runs = pc.run_end_encode(table.column("lang").combine_chunks())
    first = 0
    for lang, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
        yield lang, table.slice(first, end - first)
        first = end


def _rows_of(langs: pa.Array) -> Iterator[tuple[str | None, np.ndarray]]:
    """Each language of a slice and its rows."""
    coded = langs.dictionary_encode(null_encoding="encode")
    number = coded.indices.to_numpy(zero_copy_only=False)
    for k, lang in enumerate(coded.dictionary.to_pylist()):
        yield lang, np.flatnonzero(number == k)


def _word_histograms(words: tuple[pa.DictionaryArray, np.ndarray], mine: np.ndarray, listed: pa.Array) -> np.ndarray:
    """A row of counts of the listed words, and of all others, for each of the texts ``mine``."""
    coded, counts = words
    place = pc.fill_null(pc.index_in(coded.dictionary.cast(pa.large_string()), value_set=listed), len(listed))
    width = len(listed) + 1
    place = place.to_numpy(zero_copy_only=False).astype(np.int64)
    codes = coded.indices.to_numpy(zero_copy_only=False)[ragged((np.cumsum(counts) - counts)[mine], counts[mine])]
    owner = np.repeat(np.arange(len(mine)), counts[mine])
    return np.bincount(owner * width + place[codes], minlength=len(mine) * width).reshape(-1, width)


def jensen_shannon(rows: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Distance (base 2) of each row of counts from a histogram; 0 for a row without counts."""
    p = rows / np.maximum(rows.sum(axis=1, keepdims=True), 1)
    q = np.broadcast_to(reference / max(reference.sum(), 1), p.shape)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=1)
    return np.where(rows.sum(axis=1) > 0, np.sqrt(np.clip((left + right) / 2, 0, 1)), 0.0)


def judged(documents: DataFrame, references: References) -> DataFrame:
    """doc_id, base counts, base_failed, kept, char_distance and word_distance (null if guarded)."""
    shared = documents.sparkSession.sparkContext.broadcast(references)
    added = (
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        "base_failed boolean, kept boolean, char_distance double, word_distance double"
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                texts = texts_of(part, "text")
                base = base_counts(texts)
                failed = (base["n_words"] < MIN_WORDS) | (
                    100 * base["n_repeat_words"] > MAX_REPEATED_PERCENT * base["n_words"]
                )
                chars, words = _char_histograms(texts), _plain_words(texts)
                nearest = np.full((2, len(texts)), np.inf)
                for own, mine in _rows_of(part.column("lang")):
                    for lang in known.chars_of if own is None else {own} & known.chars_of.keys():
                        seen = _word_histograms(words, mine, known.common_of[lang])
                        found = jensen_shannon(chars[mine], known.chars_of[lang]), jensen_shannon(seen, known.words_of[lang])
                        nearest[:, mine] = np.minimum(nearest[:, mine], found)
                guards = chars.sum(axis=1) < GUARD_CHARS, base["n_words"] < GUARD_WORDS
                distances = [
                    np.where(guard | np.isinf(near), np.nan, np.round(near, 6)) for guard, near in zip(guards, nearest)
                ]
                far = (distances[0] > MAX_CHAR_DISTANCE) | (distances[1] > MAX_WORD_DISTANCE)
                columns = [*base.values(), failed, ~failed & ~far]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        *[pa.array(c) for c in columns],
                        *[pa.array(d, pa.float64(), from_pandas=True) for d in distances],
                    ],
                    ["doc_id", *base, "base_failed", "kept", "char_distance", "word_distance"],
                )

    schema = T.StructType([T.StructField("doc_id", documents.schema["doc_id"].dataType), *T.StructType.fromDDL(added).fields])
    return bounded_batches(documents).select("doc_id", "lang", "text").mapInArrow(judge, schema)


def divergence_query(spark, sf_dir: str) -> DataFrame:
    """The verdict on every document, against references counted over all documents."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    return judged(documents, language_references(documents))
