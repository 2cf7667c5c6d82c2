import random

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import bagminhash as bag
from millrace.llm.components import connected


def overlap(one: str, other: str) -> float:
    def shingles(text):
        words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
        spans = [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
        return {s: spans.count(s) for s in spans}

    a, b = shingles(one), shingles(other)
    both = sum(min(n, b.get(s, 0)) for s, n in a.items())
    whole = sum(a.values()) + sum(b.values()) - both
    return both / whole if whole else 0.0


def brute_classes(texts: list[str], same=0.8) -> list[int]:
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if texts[i] == texts[j] or overlap(texts[i], texts[j]) >= same:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(texts))]


def sample_texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(30, 200))]
        texts.append(" ".join(base))
        for edits in (0, 1, 1, 2, 4, 12):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    texts += ["", "", "one two", "One, two!", "###", "a a a a a a a a a a", "a " * 12, "z " * 3000]
    return texts


def test_signatures_estimate_weighted_overlap_without_bias():
    rng = np.random.default_rng(3)
    owner, hashes, counts = [], [], []
    names = rng.integers(1, 1 << 62, 60).astype(np.uint64)
    left, right = rng.integers(0, 9, 60), rng.integers(0, 9, 60)
    for k, side in enumerate((left, right)):
        for name, n in zip(names, side):
            if n:
                owner.append(k), hashes.append(name), counts.append(n)
    signed = bag.signatures(np.array(owner), np.array(hashes), np.array(counts), 2, 40_000)
    true = np.minimum(left, right).sum() / np.maximum(left, right).sum()
    assert abs((signed[0] == signed[1]).mean() - true) < 0.01


def test_signature_does_not_depend_on_the_company():
    texts = pa.array(sample_texts(), pa.large_string())
    hashes, owner, _, counts = bag._shingles(texts)
    whole = bag.signatures(*bag._multisets(hashes, owner), len(texts), 150)
    for i in range(0, len(texts), 7):
        one = texts.slice(i, 1)
        h, o, _, _ = bag._shingles(one)
        assert (bag.signatures(*bag._multisets(h, o), 1, 150)[0] == whole[i]).all()
    assert (whole[counts > 0] != 0).all()


@pytest.mark.parametrize("block", [2, 1024])
def test_classes_match_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(bag, "BLOCK_ROWS", block)
    monkeypatch.setattr(bag, "PAIRS_AT_ONCE", 50 * block)
    monkeypatch.setattr(bag, "SHINGLES_AT_ONCE", 900 * block)
    texts = sample_texts()
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string").repartition(4)
    got = {r.doc_id: r.class_id for r in bag.near_duplicate_classes(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute_classes(texts)


def test_one_of_each_class_stays_with_all_columns(spark):
    texts = sample_texts()
    rows = [(i, t, i) for i, t in enumerate(texts)] + [(None, texts[0], 1), (3, texts[3], 3), (None, None, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int")
    kept = bag.keep_one_of_each_class(docs)
    assert kept.columns == docs.columns
    want = sorted(set(brute_classes(texts)))
    assert sorted(r.doc_id for r in kept.collect()) == want


def test_nulls_and_empty_tables(spark):
    schema = "doc_id long, text string"
    assert bag.near_duplicate_classes(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, None), (2, ""), (None, "x"), (None, "x"), (4, "x")]
    got = sorted(map(tuple, bag.near_duplicate_classes(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == [(1, 1, 2), (2, 1, 2), (4, 4, 3), (None, 4, 3), (None, 4, 3)]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 300), (300, 200), (7, 7)]
    got = dict(map(tuple, connected(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 200: 100, 300: 100}
