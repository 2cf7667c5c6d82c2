import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing


def brute_targets(sizes: dict, weights=(5, 2, 1), most=3) -> dict:
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = Fraction(sum(sizes.values())), {}
    while True:
        free = [s for s in order if s not in fixed]
        if not free:
            return fixed
        level = (total - sum(fixed.values())) / sum(weight[s] for s in free)
        above = [s for s in free if level * weight[s] > most * sizes[s]]
        if not above:
            return fixed | {s: level * weight[s] for s in free}
        fixed |= {s: Fraction(most * sizes[s]) for s in above}


def documents(spark):
    rng = random.Random(1)
    rows = [(i, " ".join("x" * rng.randint(0, 120)), rng.choice(["a", "a", "a", "b", "é", "Z", None]), 7) for i in range(900)]
    rows += [(1, "x y", "tiny", 7), (1, "x y", "tiny", 7), (None, None, "empty", 7), (5, "", "empty", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size int"), rows


def test_targets_and_words_taken(spark):
    docs, rows = documents(spark)
    sizes = Counter()
    for _, text, source, _ in rows:
        sizes[source] += len((text or "").split())
    drawn, names = mixing.sampled(docs)
    got = drawn.groupBy("source").agg(
        F.first(names["target"]).alias("target"),
        F.sum(F.col(names["size"]) * F.col(names["copies"])).alias("taken"),
        F.max(names["size"]).alias("largest"),
        F.max(names["copies"]).alias("most"),
    )
    want = brute_targets(sizes)
    found = {r.source: r for r in got.collect()}
    assert set(found) == set(want)
    for source, row in found.items():
        assert row.target == pytest.approx(float(want[source]))
        assert abs(row.taken - row.target) <= 3 * row.largest
        assert row.most <= 3
    assert drawn.count() == len(rows)
    assert drawn.columns[:4] == docs.columns


def test_reruns_and_partitions_agree(spark):
    docs, _ = documents(spark)
    key = ["doc_id", "text", "source"]
    first, names = mixing.sampled(docs.repartition(7))
    second, _ = mixing.sampled(docs.coalesce(1))
    columns = [*key, names["copies"], names["target"]]
    assert first.select(columns).exceptAll(second.select(columns)).isEmpty()


def test_emits_once_per_boundary(spark):
    docs, _ = documents(spark)
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns
    drawn, names = mixing.sampled(docs)
    assert mix.count() == drawn.agg(F.sum(names["copies"])).first()[0]


@pytest.mark.parametrize("rows", [[], [(1, None, "a")], [(1, "", None), (1, "", None)]])
def test_nothing_to_take(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    drawn, names = mixing.sampled(docs)
    assert [r[names["copies"]] for r in drawn.collect()] == [0] * len(rows)
    assert mixing.mixed(docs).count() == 0


def test_no_python_in_the_plan(spark):
    docs, _ = documents(spark)
    plan = mixing.sampled(docs)[0]._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
