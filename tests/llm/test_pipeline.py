"""The whole pipeline and the toxicity operator against plain Python on a small corpus."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import toxicity as tx
from millrace.scratch import scratch_path
from tests.llm.test_bagminhash import brute_classes
from tests.llm.test_fmindex import brute as brute_hits
from tests.llm.test_mixing import brute_targets

BAD = ["idiot", "scumbag", "worthless", "moron"]


def corpus():
    rng = random.Random(12)
    words = [a + b for a in "ba ce di fo gu ha ki lo me nu".split() for b in "rn st ll mp nd sk tt".split()]
    make = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, " ".join(make(30))) for i in range(8)]
    docs, labels, toxic = [], [], set()
    for i in range(400):
        body = make(rng.randint(20, 120))
        if i % 4 == 1:
            toxic.add(i)
            for _ in range(4):
                body.insert(rng.randint(0, len(body)), rng.choice(BAD))
        if i % 17 == 2:
            body[5:5] = items[i % 8][1].split()[:20]
        docs.append([i, " ".join(body), "en", f"s{min(i % 7, 3)}", 0])
        if i % 3:
            labels.append((i, 1, int(i in toxic)))
    for i in range(400, 440):  # near and exact copies
        body = docs[(i * 7) % 400][1].split()
        if (i * 7) % 400 in toxic:
            toxic.add(i)
        if i % 2:
            body[len(body) // 2] = "changed"
        docs.append([i, " ".join(body), "en", "s9", 0])
    docs.append([440, None, None, None, None])
    docs.append([441, "", "en", None, 0])
    return [tuple(d) for d in docs], items, labels, toxic


@pytest.fixture(scope="module")
def folder(spark):
    docs, items, labels, _ = corpus()
    base = scratch_path(spark, "pipeline-tables")
    kinds = {
        "documents": (docs, "doc_id long, text string, lang string, source string, n_chars long"),
        "benchmark": (items, "item_id long, text string"),
        "labels": (labels, "doc_id long, quality int, toxic int"),
    }
    for name, (rows, schema) in kinds.items():
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{base}/{name}.parquet")
    return base


def mixed(docs):
    """Copies of each document by systematic sampling, written out."""
    sizes = defaultdict(int)
    by_source = defaultdict(list)
    for doc_id, text, source in docs:
        n = len((text or "").split())
        sizes[source] += n
        by_source[source].append((n, doc_id, text))
    targets, copies = brute_targets(dict(sizes)), {}
    for source, rows in by_source.items():
        share = min(3.0, float(targets[source]) / sizes[source]) if sizes[source] else 0.0
        each = int(share * 10**9)
        key = "mix" + ("=" + source if source is not None else "")
        shift = int(hashlib.md5(key.encode()).hexdigest()[:12], 16) % 10**9
        for n, (_, doc_id, _) in enumerate(sorted(rows)):
            copies[doc_id] = (each * (n + 1) + shift) // 10**9 - (each * n + shift) // 10**9
    return copies


def test_pipeline_against_plain_python(spark, folder):
    docs, items, _, toxic = corpus()
    left = [d for d in docs if d[0] not in toxic]
    classes = brute_classes([d[1] or "" for d in left])
    left = [d for i, d in enumerate(left) if classes[i] == i]
    hit = {r[0] for r in brute_hits([d[:2] for d in left], items) if r[5]}
    assert hit
    left = [d for d in left if d[0] not in hit]
    copies = mixed([(d[0], d[1], d[3]) for d in left])
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for doc_id, text, *_ in left:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        want[doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += copies[doc_id]
    rows = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == +want
    ordered = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted(r.doc_id for r in rows)
    assert [r.start for r in ordered] == [sum(r.n_tokens for r in ordered[:i]) for i in range(len(ordered))]


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, folder).columns == docs.columns, name
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_dedup", "decontamination", "mixing", "token_records",
    ]


def test_held_out_accuracy_of_toxicity(spark, folder):
    _, _, _, toxic = corpus()
    found = tx.toxicity_query(spark, folder).collect()
    assert len(found) == 442
    for row in found:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5)
    held = [r for r in found if r.held_out]
    assert sum(r.predicted == int(r.doc_id in toxic) for r in held) >= 0.95 * len(held)


def test_features_are_the_ngrams_of_distinct_words():
    import pyarrow as pa

    texts = ["Éa b Éa", "", "éa", "abcdefgh " * 3]
    found = [set(x.tolist()) for x in tx._features(pa.array(texts, pa.large_string()))]
    assert found[1] == set() and found[2] < found[0] and all(len(x) == len(set(x)) for x in found)
    grams = {w[i : i + n] for w in [" abcdefgh "] for n in tx.ORDERS for i in range(len(w) - n + 1)}
    assert len(found[3]) == len(grams)
    alone = {next(tx._features(pa.array([t], pa.large_string()))).tobytes() for t in ["b Éa", "Éa  b"]}
    assert len({frozenset(np.frombuffer(x, np.int32).tolist()) for x in alone}) == 1


def test_toxicity_without_usable_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None), (None, "c"), (1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one_class = spark.createDataFrame([(1, 0), (None, 1), (2, None), (9, 1)], "doc_id long, toxic int")
    for labels in (none, one_class):
        scored = tx.score_toxicity(docs, tx.fit_toxicity(docs, labels)).collect()
        assert [r.score for r in scored] == [0.0] * 4
    clash = docs.withColumnRenamed("doc_id", "x").selectExpr("x as doc_id", "text", "1 as SCORE")
    with pytest.raises(ValueError):
        tx.score_toxicity(clash, tx.fit_toxicity(docs, none))
    assert tx.score_toxicity(docs.limit(0), tx.fit_toxicity(docs, none)).count() == 0


def tables(spark, docs, schema, items=(), labels=()):
    base = scratch_path(spark, "odd-tables")
    spark.createDataFrame(docs, schema).repartition(2).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return base


def test_pipeline_on_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    assert corpus_pipeline.run(spark, tables(spark, [], schema)).count() == 0


def test_pipeline_on_odd_rows_with_clashing_columns(spark):
    names = "toxicity_score score size copies target cluster contaminated spans shard part n_tokens".split()
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    extra = ["x"] * len(names)
    rows = [(1, "a few plain words stand here", "en", "s", 1, *extra), (1, "a few plain words stand here", "en", "s", 1, *extra),
            (2, None, None, None, None, *[None] * len(names)), (3, "", "en", None, 0, *extra), (None, "no id but words", "en", "s", 1, *extra),
            (5, "long " * 30_000, "en", "t", 1, *extra)]
    folder = tables(spark, rows, schema)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, folder)
        assert docs.columns == [f.split()[0] for f in schema.split(", ")], name
    found = corpus_pipeline.run(spark, folder).collect()
    kept = {r.doc_id for r in found}
    assert {1, None, 5} <= kept <= {1, 2, 3, None, 5} and len(kept & {2, 3}) <= 1
    assert all(r.n_tokens == 1 for r in found if r.doc_id in (2, 3))
