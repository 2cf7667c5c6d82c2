import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm import suffixes as sx


def brute(docs, length):
    counts = Counter(t[i : i + length] for _, t in docs for i in range(len(t) - length + 1))
    result = []
    for doc_id, text in docs:
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if counts[text[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        rest = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        result.append((doc_id, len(text), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(result, key=str)


def corpus():
    rng = random.Random(9)
    words = ["the", "of", "thorn", "é", "straße", "x", "and", "日本"]
    make = lambda n: " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(n))
    passages = [make(n) for n in (5, 8, 12, 30, 60)]
    docs = [(1, None), (2, ""), (3, "short"), (4, "a" * 150), (5, "ab" * 90), (6, "a" * 40), (6, "a" * 40)]
    for i in range(10, 60):
        text = make(rng.randint(1, 120))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(text))
            text = text[:at] + rng.choice(passages) + text[at:]
        docs.append((i, text))
    for i in range(60, 80):  # near copies
        text = list(docs[20 + i % 4][1])
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = "#"
        docs.append((i, "".join(text)))
    return docs + [(None, docs[30][1])]


@pytest.mark.parametrize("group", [1000, 2])
def test_against_all_strings(spark, group, monkeypatch):
    monkeypatch.setattr(sx, "GROUP_BLOCKS", group)
    docs = corpus()
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, size int").repartition(4)
    got = sx.without_repeats(frame, length=40, anchor=12)
    found = sorted((tuple(r)[:5] for r in got.collect()), key=str)
    assert found == brute([(i, (t or "").encode()) for i, t in docs], 40)


def test_sort_orders_and_survives_collisions(monkeypatch):
    rng = random.Random(2)
    pieces = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    group = np.sort(np.array([rng.randint(0, 9) for _ in pieces]))

    def check():
        order, shared = sx.Suffixes(pieces).sort(group)
        for a, b in zip(range(len(order) - 1), range(1, len(order))):
            if group[a] == group[b]:
                one, two = pieces[order[a]], pieces[order[b]]
                assert group[order[a]] == group[a] and one <= two
                n = 0
                while n < min(len(one), len(two)) and one[n] == two[n]:
                    n += 1
                assert shared[b] == n

    check()
    real = sx.span_hashes
    monkeypatch.setattr(sx, "span_hashes", lambda *a: real(*a) & np.uint64(7))
    check()


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert sx.without_repeats(frame).count() == 0


def test_long_text_against_itself(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdef ") for _ in range(30_000))
    docs = [(1, text + text[100:900]), (2, text[5000:5300])]
    got = sorted(tuple(r)[:5] for r in sx.without_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == brute([(i, t.encode()) for i, t in docs], 200)


def thue_morse(length, letters="ab"):
    return "".join(letters[bin(i).count("1") & 1] for i in range(length))


@pytest.mark.parametrize("group", [1000, 2])
def test_texts_with_equal_polynomial_hashes_stay_apart(spark, group, monkeypatch):
    """A Thue-Morse string and its complement have one polynomial hash modulo 2**64, whatever the base."""
    monkeypatch.setattr(sx, "GROUP_BLOCKS", group)
    rng = random.Random(6)
    head = "".join(rng.choice("cdefgh") for _ in range(100))
    one, two = thue_morse(1024), thue_morse(1024, "ba")
    tail = "".join(rng.choice("cdefgh") for _ in range(300))
    docs = [(1, head + one), (2, head + two), (3, head + one[:150] + tail), (4, two + tail), (5, one[:600] + tail)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for length, anchor in ((200, 64), (120, 40)):
        got = sx.without_repeats(frame, length=length, anchor=anchor)
        found = sorted((tuple(r)[:5] for r in got.collect()), key=str)
        assert found == brute([(i, t.encode()) for i, t in docs], length)


def test_sort_is_right_after_a_misled_merge(monkeypatch):
    """With hashes that call too much equal, the order still comes out by the bytes."""
    rng = random.Random(3)
    pieces = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 30))) for _ in range(200)]
    group = np.sort(np.array([rng.randint(0, 5) for _ in pieces]))
    real = sx.span_hashes
    monkeypatch.setattr(sx, "span_hashes", lambda sums, a, b: real(sums, a, b) & np.uint64(3))
    order, shared = sx.Suffixes(pieces).sort(group)
    assert [pieces[i] for i in order] == [t for g in range(6) for t in sorted(p for p, h in zip(pieces, group) if h == g)]
    for at in np.flatnonzero(group[1:] == group[:-1]) + 1:
        one, two = pieces[order[at - 1]], pieces[order[at]]
        assert shared[at] == next((k for k, (x, y) in enumerate(zip(one, two)) if x != y), min(len(one), len(two)))
