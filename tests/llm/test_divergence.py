import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from millrace.llm import divergence as dv

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    text = text or ""
    words = WORD.findall(text)
    seen, twice = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            twice += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), twice, len(covered))


def texts():
    rng = random.Random(6)
    odd = ["", None, "\n", "a", "a\na\n\na", " a\na ", "é\r\né\r\n", "x y z u v " * 3, "#" * 50, "one two three four five",
           "\n\n a b\n a b", "w " * 20000, "tail\n", "　a b\x0bc\x1cd"]
    pieces = ["the", "of", "x1", "Été", "#$%", "\n", "\n\n", "日本", "a|b"]
    return odd + [" ".join(rng.choice(pieces) for _ in range(rng.randint(1, 120))) for _ in range(60)]


def test_base_counts():
    found = dv.base_counts(pa.array([t or "" for t in texts()], pa.large_string()))
    got = list(zip(*[found[c].tolist() for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]))
    assert got == [brute_base(t) for t in texts()]


def plain(text):
    return [w.strip(".,;:!?'\"()[]") for w in WORD.findall(text.lower())]


def distance(a, b):
    na, nb, total = sum(a.values()), sum(b.values()), 0.0
    for key in set(a) | set(b):
        p, q = a[key] / na, b[key] / nb
        m = (p + q) / 2
        total += (p * math.log2(p / m) if p else 0) + (q * math.log2(q / m) if q else 0)
    return math.sqrt(total / 2)


def corpus(spark):
    rng = random.Random(3)
    common = {"en": ["the", "of", "and"], "fr": ["le", "la", "est"]}
    rows = []
    for i in range(120):
        lang = ("en", "fr")[i % 2]
        words = [rng.choice(common[lang]) if rng.random() < 0.5 else f"{lang}{rng.randint(0, 4000)}" for _ in range(300)]
        rows.append((i, " ".join(words) + ".", lang))
    rows += [
        (200, " ".join(f"junk{i}" for i in range(400)), "en"),
        (201, " ".join(w + "###" for w in rows[0][1].split()), "en"),
        (202, rows[1][1], None),
        (203, "the the the of of", "en"),
        (204, None, "en"),
        (204, None, "en"),
        (None, rows[2][1], "zz"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows


def test_references_and_distances(spark):
    docs, rows = corpus(spark)
    references = dv.language_references(docs.repartition(5))
    counted = {"en": Counter(), "fr": Counter()}
    for _, text, lang in rows:
        if lang in counted and text:
            counted[lang].update(plain(text))
    listed = set(references.words.to_pylist())
    assert set(references.words_of) == {"en", "fr"}
    for lang, held in counted.items():
        total = sum(held.values())
        own = {w for w, mine in zip(references.words.to_pylist(), references.common_in[lang]) if mine}
        assert {w for w, n in held.items() if n >= dv.COMMON_SHARE * total} <= own <= listed
        own = dict(zip(sorted(own), references.words_of[lang][:-1].tolist(), strict=True))
        assert own == {w: held[w] for w in own}
        assert references.words_of[lang].sum() == total

    got = {r.doc_id: r for r in dv.judged(docs, references).collect() if r.doc_id is not None}
    for doc_id, text, lang in rows:
        if doc_id is None or doc_id in (202, 203, 204):
            continue
        own = {w for w, mine in zip(references.words.to_pylist(), references.common_in[lang]) if mine}
        fold = lambda words: Counter(w if w in own else "" for w in words)  # noqa: B023, E731
        reference = Counter({w: counted[lang][w] for w in own}) + Counter(
            {"": int(references.words_of[lang][-1])}
        )
        assert got[doc_id].word_distance == pytest.approx(distance(fold(plain(text)), reference), abs=1e-5)
    assert not got[200].kept and not got[201].kept and got[202].kept and got[202].word_distance < 0.41
    assert got[203].base_failed and got[203].word_distance is None and got[204].base_failed
    assert all(got[i].word_distance < 0.41 and got[i].char_distance < 0.28 for i in range(120))
    assert all(got[i].kept != got[i].base_failed for i in range(120))


def test_empty_tables(spark):
    schema = "doc_id long, text string, lang string"
    none = spark.createDataFrame([], schema)
    assert dv.judged(none, dv.language_references(none)).count() == 0
    odd = spark.createDataFrame([(1, "word " * 9 + "a b c d e f", None), (2, None, None)], schema)
    got = sorted((r.doc_id, r.base_failed, r.char_distance) for r in dv.judged(odd, dv.language_references(odd)).collect())
    assert [r[0] for r in got] == [1, 2] and all(r[2] is None for r in got)


def test_other_languages_do_not_change_a_verdict(spark, monkeypatch):
    monkeypatch.setattr(dv, "LANGUAGE_WORDS", 250)
    rng = random.Random(9)
    text = lambda lang, n: " ".join(f"{lang}{rng.randint(0, 30)}" for _ in range(n))
    tail = [(1, text("sw", 300), "sw"), (2, text("9", 200), "zz")]
    large = [(10 + i, text("en", 3000), "en") for i in range(120)]
    verdicts = []
    for rows in (tail + large[:1], tail + large):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        references = dv.language_references(docs)
        assert set(references.words_of) == {"en", "sw"}
        got = {r.doc_id: r for r in dv.judged(docs, references).collect()}
        assert got[2].kept and got[2].char_distance is None and got[2].word_distance is None
        verdicts.append((got[1], got[2]))
    assert verdicts[0] == verdicts[1] and verdicts[0][0].kept and verdicts[0][0].word_distance == 0


def test_common_words_are_exact_in_every_layout(spark):
    rng = random.Random(4)
    often = ["the", "of", "and", *[f"half{i}" for i in range(40)]]  # halves: 0.15 % of all words each
    share = [0.3, 0.2, 0.1, *[0.0015] * 40]
    rare = lambda: f"en{rng.randint(0, 9000)}"
    rows = []
    for i in range(100):
        words = rng.choices([*often, None], [*share, 1 - sum(share)], k=300)
        rows.append((i, " ".join(w or rare() for w in words), "en"))
    held = Counter(w for _, text, _ in rows for w in plain(text))
    exact = {w for w, n in held.items() if n >= dv.COMMON_SHARE * sum(held.values())}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for parts in (1, 7):
        references = dv.language_references(docs.repartition(parts))
        words = [w for w, mine in zip(references.words.to_pylist(), references.common_in["en"]) if mine]
        assert set(words) == exact
        assert references.words_of["en"].tolist() == [held[w] for w in words] + [
            sum(held.values()) - sum(held[w] for w in words)
        ]


def test_lines_with_equal_polynomial_hashes_are_no_duplicates():
    one = "".join("ab"[bin(i).count("1") & 1] for i in range(1024))
    two = one.translate(str.maketrans("ab", "ba"))

    found = dv.base_counts(pa.array([f"{one}\n{two}", f"{one}\n{two}\n{one}", "x\n\nx\n y"], pa.large_string()))
    assert found["n_dup_lines"].tolist() == [0, 1, 1]
