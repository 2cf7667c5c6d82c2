import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from millrace.llm import records as rec
from millrace.scratch import scratch_path


def texts():
    rng = random.Random(4)
    odd = ["", None, " ", "a", "Á é ́x", "<|endoftext|> y<|startoftext|>z", "it's I'LL ’s", " x y",
           "ﬁ Ａ １２３ 12345 !!!???", "\U0001f600\U0001f600 ok", "T\u0308 T.\u0308 a.\u0301 <|ENDOFTEXT|> (<|endoftext|>) can't. 'S.' x<|y|> #'s -'re'- É.é Σ. ΑΣ.Α", "\x00\x01", "word " * 30000, "İstanbul ſ", "한국어 각"]
    pieces = ["the", "Thing", "don't", "é", "12", "!", "\n", "\t", "--", "<|endoftext|>", "naïve", "…"]
    return odd + ["".join(rng.choice(pieces) + rng.choice(["", " ", "  "]) for _ in range(200)) for _ in range(40)]


def test_crc32c_known_values():
    rng = np.random.default_rng(1)
    assert rec.crc32c([b"123456789", b"", b"\0" * 32]).tolist() == [0xE3069283, 0, 0x8A9136AA]

    def plain(data):
        register = 0xFFFFFFFF
        for byte in data:
            register ^= byte
            for _ in range(8):
                register = register >> 1 ^ (0x82F63B78 if register & 1 else 0)
        return register ^ 0xFFFFFFFF

    pieces = [rng.bytes(int(n)) for n in (1, 2, 3, 4, 507, 508, 509, 1020, 5000)]
    assert rec.crc32c(pieces).tolist() == [plain(p) for p in pieces]


def test_round_trip_against_whole_text_encoding(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = [((i * 37) % 101, t, "x") for i, t in enumerate(texts())] + [(None, "last one", "x"), (5, "again", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(5)
    root = scratch_path(spark, "test-records")
    got = sorted(map(tuple, rec.encoded(docs, root).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((r[0] for r in rows if r[0] is not None)) + [None]
    want = {}
    for doc_id, text, _ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        want.setdefault(doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    before = 0
    for doc_id, start, n, crc in got:
        assert start == before
        assert (n, crc) in want[doc_id]
        want[doc_id].remove((n, crc))
        before += n


def test_shuffled_reads_give_the_same_records(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * i) for i in range(60)], "doc_id long, text string")
    root = scratch_path(spark, "test-records")
    rec.write_records(docs, root)
    index = rec.read_index(spark, root)
    straight = rec.read_records(index, root).collect()
    mixed = rec.read_records(index, root, seed=3).collect()
    assert [r.doc_id for r in mixed] != sorted(r.doc_id for r in mixed)
    assert {r.doc_id: r.ids for r in straight} == {r.doc_id: r.ids for r in mixed}
    assert all(r.ids[-1] == 2 and len(r.ids) == r.n_tokens for r in straight)


def test_damage_is_found(spark):
    record = rec.frames([b"\x02\x01\x00\x02\x00"])[0]
    assert rec.unframe([record]) == [b"\x02\x01\x00\x02\x00"]
    for at in range(len(record)):
        broken = bytearray(record)
        broken[at] ^= 4
        with pytest.raises(ValueError):
            rec.unframe([bytes(broken)])
    with pytest.raises(ValueError):
        rec.unframe([record[:-1]])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    root = scratch_path(spark, "test-records")
    assert rec.encoded(docs, root).count() == 0
    assert not os.path.exists(f"{root}/shards")


def test_word_encoder_equals_the_library_whatever_it_holds(monkeypatch):
    rng = random.Random(11)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert rec.words_stand_alone(tokenizer)
    letters = "abcxyzÀÉßéñøœſĲŉİıǅȺЖяѐへ日각ªµΣﬁ"
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(3000)] + ["x" * 5000]
    batches = [pa.array([" ".join(rng.choices(made, k=60)) for _ in range(50)] + [t or "" for t in texts()], pa.large_string())] * 2
    batches += [pa.array([], pa.large_string()), pa.array(["", " "], pa.large_string())]
    for held in (1 << 24, 3000):
        monkeypatch.setattr(rec, "KNOWN_BYTES", held)
        encode = rec.WordEncoder(tokenizer, np.dtype("<u2"))
        for batch in batches:
            ids, counts = encode(batch)
            found = np.split(ids, np.cumsum(counts)[:-1]) if len(batch) else []
            assert [f.tolist() for f in found] == [e.ids for e in tokenizer.encode_batch(batch.to_pylist(), add_special_tokens=False)]
        assert held > 3000 or len(encode.words) < 3000


def test_words_that_are_cut_otherwise_are_encoded_one_by_one(monkeypatch):
    monkeypatch.setattr(rec, "_LETTERS", "")  # takes everything for letters
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    words = pa.array(["a1b", "don't", "plain", "!!", "x-y", "", "́"], pa.large_string())
    ids, sizes = rec.WordEncoder(tokenizer, np.dtype("<u2"))._encoded(words)
    want = [e.ids for e in tokenizer.encode_batch(words.to_pylist(), add_special_tokens=False)]
    assert ids.tolist() == sum(want, []) and sizes.tolist() == [len(w) for w in want]


def test_other_tokenizers_encode_whole_texts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    assert not rec.words_stand_alone(tokenizer)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "doc_id long, text string")
    root = scratch_path(spark, "test-records")
    rec.write_records(docs, root, vocabulary=path, end_id=50256)
    got = {r.doc_id: list(r.ids) for r in rec.read_records(rec.read_index(spark, root), root).collect()}
    for i, text in enumerate(texts()):
        assert got[i] == tokenizer.encode(text or "", add_special_tokens=False).ids + [50256]


def test_reads_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(rec, "READ_BYTES", 100)
    lengths = [10, 95, 5, 300, 40, 60, 1, 99]
    parts = list(rec._by_bytes(pa.RecordBatch.from_arrays([pa.array(lengths)], ["length"])))
    assert [p.column("length").to_pylist() for p in parts] == [[10], [95, 5], [300], [40, 60], [1, 99]]
    assert list(rec._by_bytes(pa.RecordBatch.from_arrays([pa.array([], pa.int64())], ["length"]))) == []
