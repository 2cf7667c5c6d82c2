"""N-grams of words are hashed a block at a time: the same buckets, in bounded memory."""

import tracemalloc

import numpy as np
import pyarrow as pa

from millrace.llm import toxicity


def test_blocks_do_not_change_features(monkeypatch):
    words = pa.array(["a", "héllo", "x" * 50, "", "日本語", "word", "words"] * 3, pa.large_string())
    whole = toxicity._block_features(words)
    for size in (1, 7, 60, 1 << 20):
        monkeypatch.setattr(toxicity, "_BLOCK_BYTES", size)
        for got, wanted in zip(toxicity._word_features(words), whole, strict=True):
            assert np.array_equal(got, wanted)
    buckets, pointers = toxicity._word_features(words.slice(0, 0))
    assert len(buckets) == 0 and pointers.tolist() == [0]


def test_memory_of_a_slice_of_distinct_words():
    words = pa.array([f"{i:06d}" for i in range(350_000)], pa.large_string())  # 2 MB, as much as a slice has
    tracemalloc.start()
    toxicity._word_features(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20
