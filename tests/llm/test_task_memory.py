"""What a task of a pipeline stage holds at once is bounded, and the bound does not change its rows."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from millrace.llm import arrow_text, bagminhash as bag, toxicity

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def batch_of(texts: list[str | None]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": pa.array(texts, pa.string())})


def sign_task(monkeypatch):
    """The function that signs batches, without Spark around it."""
    frame = SimpleNamespace(schema=SCHEMA, select=lambda *c: frame, mapInArrow=lambda f, schema: f)
    monkeypatch.setattr(bag, "bounded_batches", lambda df: df)
    return bag._signed(frame, bag.BANDS, bag.ROWS)


def score_task(monkeypatch):
    """The function that scores batches, without Spark around it."""
    model = toxicity.ToxicityModel(np.random.default_rng(3).normal(size=1 << toxicity.BUCKET_BITS), -1.0)
    context = SimpleNamespace(broadcast=lambda x: SimpleNamespace(value=x))
    session = SimpleNamespace(sparkContext=context)
    frame = SimpleNamespace(columns=SCHEMA.names, schema=SCHEMA, sparkSession=session, mapInArrow=lambda f, schema: f)
    monkeypatch.setattr(toxicity, "bounded_batches", lambda df: df)
    return toxicity.score_toxicity(frame, model)


@pytest.mark.parametrize(("task", "most"), [(sign_task, 80), (score_task, 40)])
def test_memory_of_a_batch(monkeypatch, task, most):
    words = [f"{i:06d}" for i in range(300_000)]  # all distinct, 2 MB
    batch = batch_of([" ".join(words[i : i + 300]) for i in range(0, len(words), 300)])
    run = task(monkeypatch)
    tracemalloc.start()
    rows = sum(b.num_rows for b in run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == batch.num_rows
    assert peak < most << 20


@pytest.mark.parametrize(("task", "module", "name"), [(sign_task, bag, "TEXT_BYTES"), (score_task, toxicity, "_TEXT_BYTES")])
def test_rows_do_not_depend_on_the_bound(monkeypatch, task, module, name):
    texts = [None, "", "one", "a b c d e f g " * 40, "Été 日本語 " * 9, "x" * 500, None, *[f"w{i} w{i + 1} " * 7 for i in range(40)]]
    run, found = task(monkeypatch), []
    for size in (1, 100, 1 << 21):
        monkeypatch.setattr(module, name, size)
        found.append([row for b in run(iter([batch_of(texts)])) for row in b.to_pylist()])
    assert [r["doc_id"] for r in found[0]] == list(range(len(texts)))
    assert found[0] == found[1] == found[2]


def test_powers_grow_with_what_is_asked(monkeypatch):
    monkeypatch.setattr(arrow_text, "_powers", {})
    for count in (0, 1, 70_000, 70_001, arrow_text.SLICE_BYTES + 1, arrow_text.SLICE_BYTES + 9):
        found = arrow_text.powers_of(arrow_text.POLY_BASE, count)
        assert len(found) == count
        assert all(int(found[i]) == pow(arrow_text.POLY_BASE, i, 1 << 64) for i in {0, count // 2, count - 1} if 0 <= i < count)
        assert len(arrow_text._powers[arrow_text.POLY_BASE]) <= max(1 << 16, 2 * count)
