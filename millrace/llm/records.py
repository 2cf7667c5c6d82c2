"""Token ids as length-delimited binary records with masked checksums and an offset index.

A record is the length of its data (8 bytes, little-endian), the masked CRC-32C of those 8 bytes, the
data, and the masked CRC-32C of the data (4 bytes each). The data are one byte that says how wide an
id is (2 or 4 bytes) and the ids, little-endian. Documents are dealt into sorted ranges of doc_id; each
task writes one shard file, and Spark writes the index (shard, record, offset, length, doc_id, tokens
before it in the shard, n_tokens). A task that runs again writes another file, and the index names
only the files of tasks that ended well, so a lost executor leaves at most a file that nothing reads.

Reading goes through the index, in its order or shuffled by a seed, and checks both checksums.

Texts are encoded by the tokenizers library. Where the tokenizer's file states that white space is dropped, that
letters never share a pre-token with marks, and that a token ends each pre-token, a text's ids are those of its
blank-separated words, cut where ASCII letters meet ASCII marks, one after the other. Each distinct word is then encoded
once by a worker, within a bound on the bytes it holds; words of letters only are encoded many at once and told apart
by the tokens that end a word. With any other tokenizer whole texts are encoded.

Defined results: a null text is empty and its record holds the end id alone. Ids ascend, nulls come last,
and repeated rows are records each. No rows give no shards. Other columns are left out.
"""

from __future__ import annotations

import itertools
import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from millrace.llm.arrow_text import BLANKS, bounded_batches, placed_words, ragged, slices, texts_of
from millrace.scratch import scratch_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
#: Text bytes that are encoded together; smaller slices take more look-ups among the words held.
ENCODE_BYTES = 2 << 20
#: Words that the library encodes at once, and how many of them as one text if they are letters only.
BATCH_WORDS = 4096
JOINED_WORDS = 256
#: Bytes of words and their ids that a Python worker holds between slices.
KNOWN_BYTES = 8 << 20
#: Bytes of records read and checked together; one longer record is alone.
READ_BYTES = 1 << 20

_CASTAGNOLI = 0x82F63B78
_MASK_DELTA = 0xA282EAD8
_BLOCK = 512


def _crc_tables() -> tuple[np.ndarray, np.ndarray, bytes]:
    """What each byte of a block adds to the register, how a block moves it, and four bytes that fill it."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_CASTAGNOLI), table >> 1).astype(np.uint32)
    adds = np.empty((_BLOCK, 256), np.uint32)
    adds[-1] = table
    for place in range(_BLOCK - 2, -1, -1):
        later = adds[place + 1]
        adds[place] = (later >> 8) ^ table[later & 0xFF]
    moves = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    for _ in range(_BLOCK):
        moves = (moves >> 8) ^ table[moves & 0xFF]
    register, start = 0xFFFFFFFF, 0  # run the register backwards to find what fills it
    high = {int(x) >> 24: i for i, x in enumerate(table)}
    for _ in range(4):
        i = high[register >> 24]
        register = ((register ^ int(table[i])) << 8) & 0xFFFFFFFF | i
    start = register
    return adds, moves, struct.pack("<I", start)


_ADDS, _MOVES, _FILL = _crc_tables()


def crc32c(pieces: list[bytes]) -> np.ndarray:
    """CRC-32C of each piece."""
    lengths = np.array([len(p) + 4 for p in pieces], np.int64)
    blocks = -(-lengths // _BLOCK)
    flat = np.zeros(int(blocks.sum()) * _BLOCK, np.uint8)
    ends = np.cumsum(blocks) * _BLOCK
    for piece, end in zip(pieces, ends, strict=True):  # zeros in front leave the register at zero
        flat[end - len(piece) - 4 : end - len(piece)] = np.frombuffer(_FILL, np.uint8)
        flat[end - len(piece) : end] = np.frombuffer(piece, np.uint8)
    rows, place = flat.reshape(-1, _BLOCK), np.arange(_BLOCK)
    own = np.concatenate(
        [np.bitwise_xor.reduce(_ADDS[place, rows[i : i + 2048]], axis=1) for i in range(0, len(rows), 2048)]
        or [np.zeros(0, np.uint32)]
    )
    register = np.zeros(len(pieces), np.uint32)
    at, left = ends // _BLOCK - blocks, blocks.copy()
    live = np.arange(len(pieces))
    while len(live):
        now = register[live]
        moved = _MOVES[0, now & 0xFF] ^ _MOVES[1, now >> 8 & 0xFF] ^ _MOVES[2, now >> 16 & 0xFF] ^ _MOVES[3, now >> 24]
        register[live] = moved ^ own[at[live]]
        at[live] += 1
        left[live] -= 1
        live = live[left[live] > 0]
    return register ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    """Turned by 15 bits and shifted by a constant, so that checksums of checksums stay sound."""
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(_MASK_DELTA)


def frames(pieces: list[bytes]) -> list[bytes]:
    """The record of each piece of data."""
    lengths = [struct.pack("<Q", len(p)) for p in pieces]
    of_length, of_data = masked(crc32c(lengths)), masked(crc32c(pieces))
    return [
        b"".join((n, struct.pack("<I", a), p, struct.pack("<I", b)))
        for n, a, p, b in zip(lengths, of_length.tolist(), pieces, of_data.tolist(), strict=True)
    ]


def unframe(records: list[bytes]) -> list[bytes]:
    """The data of each record; raises if a length or checksum is wrong."""
    pieces = [r[12:-4] for r in records]
    if any(len(r) < 16 or struct.unpack_from("<Q", r)[0] != len(r) - 16 for r in records):
        raise ValueError("a record is cut or its length is wrong")
    want_length = np.array([struct.unpack_from("<I", r, 8)[0] for r in records], np.uint32)
    want_data = np.array([struct.unpack_from("<I", r, len(r) - 4)[0] for r in records], np.uint32)
    if (masked(crc32c([r[:8] for r in records])) != want_length).any() or (masked(crc32c(pieces)) != want_data).any():
        raise ValueError("a record's checksum is wrong")
    return pieces


def _kinds() -> np.ndarray:
    """ASCII letters (1) and marks that always part pre-tokens from them (2).

    The apostrophe begins contractions, and <|> stand in special tokens; neither parts anything.
    """
    kinds = np.zeros(256, np.int8)
    kinds[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
    kinds[np.frombuffer(b"!\"#$%&()*+,-./:;=?@[]^_`{}~", np.uint8)] = 2
    return kinds


_KINDS = _kinds()


#: Letters of long standing (Latin, Cyrillic, kana, common ideographs, Hangul); I with a dot lower-cases to two characters.
_LETTERS = (
    r"^[a-zA-Z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}\x{400}-\x{481}"
    r"\x{3041}-\x{3096}\x{4E00}-\x{9FA5}\x{AC00}-\x{D7A3}]+$"
)

# How a tokenizer must cut for words to be encoded apart.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_MARKERS = {"<|startoftext|>", "<|endoftext|>"}


def words_stand_alone(tokenizer) -> bool:
    """Whether a text's ids are those of its words, by what the tokenizer says of itself."""
    spec = json.loads(tokenizer.to_str())
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return (
        (spec.get("normalizer") or {}).get("normalizers") == _NORMALIZERS
        and cuts[0].get("pattern") == {"Regex": _CUT}
        and cuts[0].get("behavior") == "Removed"
        and cuts[0].get("invert") is True
        and [c.get("type") for c in cuts[1:]] == ["ByteLevel"]
        and not cuts[1].get("add_prefix_space")
        and not cuts[1].get("use_regex")
        and spec["model"].get("type") == "BPE"
        and spec["model"].get("end_of_word_suffix") == "</w>"
        and not spec["model"].get("dropout")
        and {t["content"] for t in spec["added_tokens"]} <= _MARKERS
    )


class TextEncoder:
    """Ids of texts by a tokenizer that says nothing of its words."""

    def __init__(self, tokenizer, width: np.dtype):
        self.tokenizer, self.width = tokenizer, width

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        return self._library(texts.to_pylist())

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.array([len(x) for x in found], np.int64)
        return np.fromiter(itertools.chain.from_iterable(found), self.width, int(sizes.sum())), sizes


class WordEncoder(TextEncoder):
    """Ids of texts, with the ids of the words met lately at hand, in one row."""

    def __init__(self, tokenizer, width: np.dtype):
        super().__init__(tokenizer, width)
        self.words, self.ids = pa.array([], pa.large_string()), np.zeros(0, width)
        self.bounds, self.met, self.turn = np.zeros(1, np.int64), np.zeros(0, np.int64), 0
        self.ends_word = np.zeros(tokenizer.get_vocab_size(), bool)
        self.ends_word[[i for token, i in tokenizer.get_vocab().items() if token.endswith("</w>")]] = True

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words, counts, _ = placed_words(texts, BLANKS, _KINDS)
        coded = words.dictionary_encode()
        distinct = coded.dictionary
        # The library lower-cases, so ASCII words without a special token share their lower case.
        plain = pc.and_(pc.string_is_ascii(distinct), pc.invert(pc.match_substring(distinct, "<|")))
        lowered = pc.if_else(plain, pc.ascii_lower(distinct), distinct).dictionary_encode()
        place = self._places(lowered.dictionary)
        code = lowered.indices.to_numpy(zero_copy_only=False)[coded.indices.to_numpy(zero_copy_only=False)]
        starts, lengths = self.bounds[place], self.bounds[place + 1] - self.bounds[place]
        ids = self.ids[ragged(starts[code], lengths[code])]
        ends, last = np.concatenate(([0], np.cumsum(lengths[code]))), np.cumsum(counts)
        return ids, ends[last] - ends[last - counts]

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where the ids of each of the distinct words are held, encoding those that are not."""
        self._forget()
        place = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        absent = np.flatnonzero(place < 0)
        ids, sizes = self._encoded(words.take(pa.array(absent)))
        place[absent] = len(self.words) + np.arange(len(absent))
        self.words = pa.concat_arrays([self.words, words.take(pa.array(absent))])
        self.ids = np.concatenate((self.ids, ids))
        self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(sizes)))
        self.met = np.concatenate((self.met, np.zeros(len(absent), np.int64)))
        self.turn += 1
        self.met[place] = self.turn
        return place

    def _forget(self) -> None:
        """Beyond the bound keep the words met last, up to half of it; no word may take a large share."""
        sizes = pc.binary_length(self.words).to_numpy(zero_copy_only=False) + np.diff(self.bounds) * self.width.itemsize + 32
        if sizes.sum() <= KNOWN_BYTES:
            return
        order = np.argsort(-self.met, kind="stable")
        order = order[sizes[order] <= KNOWN_BYTES // 256]
        kept = np.sort(order[np.cumsum(sizes[order]) <= KNOWN_BYTES // 2])
        lengths = np.diff(self.bounds)[kept]
        self.ids = self.ids[ragged(self.bounds[kept], lengths)]
        self.bounds = np.concatenate(([0], np.cumsum(lengths)))
        self.words, self.met = self.words.take(pa.array(kept)), self.met[kept]

    def _encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in a row, and how many each has."""
        letters = pc.match_substring_regex(words, _LETTERS).to_numpy(zero_copy_only=False)
        order = np.concatenate((np.flatnonzero(letters), np.flatnonzero(~letters)))
        listed, joined = words.take(pa.array(order)).to_pylist(), int(letters.sum())
        flat, held = [np.zeros(0, self.width)], [np.zeros(0, np.int64)]
        for first in range(0, len(listed), BATCH_WORDS):  # what the library returns is far larger than the ids
            for part, alike in (
                (listed[first : min(joined, first + BATCH_WORDS)], True),
                (listed[max(joined, first) : first + BATCH_WORDS], False),
            ):
                if part:
                    ids, sizes = self._joined(part) if alike else self._library(part)
                    flat.append(ids)
                    held.append(sizes)
        ids, sizes = np.concatenate(flat), np.concatenate(held)
        back = np.argsort(order)
        return ids[ragged((np.cumsum(sizes) - sizes)[back], sizes[back])], sizes[back]

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters only: many as one text, cut behind each token that ends a word."""
        texts = [" ".join(words[i : i + JOINED_WORDS]) for i in range(0, len(words), JOINED_WORDS)]
        ids, sizes = self._library(texts)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        held = np.diff(np.searchsorted(ends, np.concatenate(([0], np.cumsum(sizes))), side="right"))
        if held.tolist() != [min(JOINED_WORDS, len(words) - i) for i in range(0, len(words), JOINED_WORDS)]:
            return self._library(words)  # a letter this library knows otherwise
        return ids, np.diff(ends, prepend=0)


_encoders: dict[tuple[str, int], TextEncoder] = {}


def _encoder(path: str, end_id: int) -> TextEncoder:
    """The encoder of this Python worker, which serves one task after the other."""
    if (path, end_id) not in _encoders:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        largest = max(tokenizer.get_vocab_size() - 1, end_id)
        kind = WordEncoder if words_stand_alone(tokenizer) else TextEncoder
        _encoders[path, end_id] = kind(tokenizer, np.dtype("<u2" if largest < 1 << 16 else "<u4"))
    return _encoders[path, end_id]


def _open(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root)


_INDEX = "shard string, part int, record long, offset long, length long, before long, n_tokens long"


def write_records(documents: DataFrame, root: str, vocabulary: str | None = None, end_id: int = END_ID) -> None:
    """Encode ``text`` by ascending ``doc_id`` into shards and an index under ``root``.

    ``root`` is a folder that executors reach through pyarrow (a shared path, HDFS or an object
    store); ``vocabulary`` is the path of the tokenizer file.
    """
    doc_id = documents.schema["doc_id"].dataType

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers

        encode = _encoder(vocabulary or public_tokenizers.path(VOCABULARY), end_id)
        width = encode.width
        task, store, out = TaskContext.get(), None, None
        shard = f"part-{task.partitionId():05d}-{task.taskAttemptId()}.records"
        offset = before = record = 0
        try:
            for batch in batches:
                for part in slices(batch, "text", ENCODE_BYTES):
                    if out is None:
                        store, folder = _open(root)
                        store.create_dir(f"{folder}/shards", recursive=True)
                        out = store.open_output_stream(f"{folder}/shards/{shard}")
                    ids, counts = encode(texts_of(part, "text"))
                    head, pieces = bytes([width.itemsize]), []
                    tail = np.array([end_id], width).tobytes()
                    for own in np.split(ids, np.cumsum(counts)[:-1]):
                        pieces.append(b"".join((head, own.tobytes(), tail)))
                    rows = frames(pieces)
                    out.write(b"".join(rows))
                    lengths, tokens = np.array([len(r) for r in rows], np.int64), counts + 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([shard] * len(rows)),
                            pa.array(np.full(len(rows), task.partitionId(), np.int32)),
                            pa.array(record + np.arange(len(rows))),
                            pa.array(offset + np.cumsum(lengths) - lengths),
                            pa.array(lengths),
                            pa.array(before + np.cumsum(tokens) - tokens),
                            pa.array(tokens),
                            part.column("doc_id"),
                        ],
                        ["shard", "part", "record", "offset", "length", "before", "n_tokens", "doc_id"],
                    )
                    offset, before, record = offset + lengths.sum(), before + tokens.sum(), record + len(rows)
        finally:
            if out is not None:
                out.close()
            pa.default_memory_pool().release_unused()  # the worker stays, beside those of later stages

    schema = T.StructType([*T.StructType.fromDDL(_INDEX).fields, T.StructField("doc_id", doc_id)])
    order = F.col("doc_id").asc_nulls_last()
    ranged = bounded_batches(documents).select("doc_id", "text").repartitionByRange(order).sortWithinPartitions(order)
    ranged.mapInArrow(write, schema).write.parquet(f"{root.rstrip('/')}/index")


def read_index(spark: SparkSession, root: str) -> DataFrame:
    """The index with ``start``, the number of ids of all documents before."""
    index = spark.read.parquet(f"{root.rstrip('/')}/index")
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("held"))  # one row per shard
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("first"))
    return index.join(starts, "part").withColumn("start", F.col("first") + F.col("before")).drop("first")


def read_records(index: DataFrame, root: str, seed: int | None = None) -> DataFrame:
    """Add the ids of each record to rows of the index; with a seed, rows come shuffled.

    Neighbours in a shard are read together.
    """
    if seed is not None:
        mixed = F.xxhash64(F.lit(seed), "shard", "record")
        index = index.repartition(mixed).sortWithinPartitions(mixed)
    return index.mapInArrow(
        lambda batches: _with_ids(batches, root, lambda ids: pa.array(ids, pa.list_(pa.int32())), "ids"),
        T.StructType([*index.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]),
    )


def read_checksums(index: DataFrame, root: str) -> DataFrame:
    """Add to the index what the files hold: n_tokens and ids_crc32 of the ids as 32-bit integers."""

    def digest(ids: list[np.ndarray]) -> pa.Array:
        rows = [{"n": len(x), "crc": zlib.crc32(x.astype("<u4").tobytes())} for x in ids]
        return pa.array(rows, pa.struct([("n", pa.int64()), ("crc", pa.int64())]))

    kind = T.StructType.fromDDL("n bigint, crc bigint")
    schema = T.StructType([*index.schema.fields, T.StructField("held", kind)])
    found = index.mapInArrow(lambda batches: _with_ids(batches, root, digest, "held"), schema)
    return found.withColumns({"n_tokens": F.col("held.n"), "ids_crc32": F.col("held.crc")}).drop("held")


def _by_bytes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of records of at most ``READ_BYTES``, or one record."""
    ends = np.cumsum(batch.column("length").to_numpy(zero_copy_only=False))
    first = 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + READ_BYTES, side="right")))
        yield batch.slice(first, last - first)
        first = last


def _with_ids(batches: Iterator[pa.RecordBatch], root: str, into, name: str) -> Iterator[pa.RecordBatch]:
    store = source = opened = None
    for batch in batches:
        for part in _by_bytes(batch):
            shards, offsets, lengths = (part.column(c).to_pylist() for c in ("shard", "offset", "length"))
            records, at = [], 0
            while at < len(shards):
                last = at + 1
                while (
                    last < len(shards)
                    and shards[last] == shards[at]
                    and offsets[last] == offsets[last - 1] + lengths[last - 1]
                ):
                    last += 1
                if shards[at] != opened:
                    if store is None:
                        store, folder = _open(root)
                    source, opened = store.open_input_file(f"{folder}/shards/{shards[at]}"), shards[at]
                block = source.read_at(offsets[last - 1] + lengths[last - 1] - offsets[at], offsets[at])
                records += [block[o - offsets[at] : o - offsets[at] + n] for o, n in zip(offsets[at:last], lengths[at:last])]
                at = last
            ids = [np.frombuffer(p, f"<u{p[0]}", offset=1) for p in unframe(records)]
            yield pa.RecordBatch.from_arrays([*part.columns, into(ids)], [*part.schema.names, name])


def encoded(documents: DataFrame, root: str) -> DataFrame:
    """Write the records of ``documents`` and return doc_id, start, n_tokens, ids_crc32 as read back."""
    write_records(documents, root)
    index = read_index(documents.sparkSession, root)
    return read_checksums(index, root).select("doc_id", "start", "n_tokens", "ids_crc32")


def records_query(spark, sf_dir: str) -> DataFrame:
    """The records of all documents, written and read back."""
    return encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch_path(spark, "records"))


def write_tokens(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: token records of the documents."""
    return encoded(docs, scratch_path(spark, "records"))
