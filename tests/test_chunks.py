import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import chunk_by_bytes, chunk_by_rows, number_rows, shard_mb_for
from millrace.operators.chunks import MB, Names, _place


@pytest.fixture
def texts(spark):
    rng = random.Random(5)
    data = [(i * 7, "é" * rng.choice([0, 1, 3, 50, 2000])) for i in range(3000)]
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "key bigint, text string").repartition(9)


def test_row_numbers_are_dense_and_ordered(texts):
    data, df = texts
    got = {r["key"]: r["position"] for r in number_rows(df, ["key"]).collect()}
    assert got == {key: i for i, (key, _) in enumerate(sorted(data))}


def test_row_chunks(texts):
    data, df = texts
    got = {r["key"]: r["batch_id"] for r in chunk_by_rows(df, ["key"], rows=700).collect()}
    assert got == {key: i // 700 + 1 for i, (key, _) in enumerate(sorted(data))}


@pytest.mark.parametrize("target", [100, 5000, 10**9])
def test_byte_chunks_match_a_running_sum(texts, target):
    data, df = texts
    want, before = {}, 0
    for key, text in sorted(data):
        want[key] = before // target
        before += len(text.encode())
    got = {r["key"]: r["shard_id"] for r in chunk_by_bytes(df, "text", target, ["key"]).collect()}
    assert got == want


def test_full_shards_are_within_one_row_of_the_target(texts):
    data, df = texts
    target = 20_000
    sizes = (
        chunk_by_bytes(df, "text", target, ["key"])
        .groupBy("shard_id")
        .agg(F.sum(F.octet_length("text")).alias("bytes"))
        .collect()
    )
    last = max(r["shard_id"] for r in sizes)
    assert all(abs(r["bytes"] - target) <= 4000 for r in sizes if r["shard_id"] != last)
    assert sum(r["bytes"] for r in sizes) == sum(len(t.encode()) for _, t in data)


def test_composite_and_descending_orders(spark):
    df = spark.range(500).select(
        (F.col("id") % 3).alias("a"), F.xxhash64("id").alias("b"), "id"
    ).repartition(5)
    got = number_rows(df, [F.col("a").desc(), "b"]).orderBy("position").collect()
    want = df.orderBy(F.col("a").desc(), "b").collect()
    assert [r["id"] for r in got] == [r["id"] for r in want]


def test_heavily_skewed_order_key(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") < 3000, F.lit(0)).otherwise(F.col("id")).alias("a"), "id"
    ).repartition(8)
    got = number_rows(df, ["a", "id"]).collect()
    assert sorted(r["position"] for r in got) == list(range(9000))
    assert all(r["position"] == r["id"] for r in got)


def test_rows_of_equal_keys_still_get_distinct_numbers(spark):
    df = spark.range(1000).select((F.col("id") % 4).alias("k"))
    assert sorted(r["position"] for r in number_rows(df, ["k"]).collect()) == list(range(1000))


def test_ties_spread_over_tasks(spark):
    df = spark.range(0, 40_000, 1, 8).select(F.lit(1).alias("k"), "id")
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        placed, _ = _place(df, Names.beside(df), ["k"], (), None)
    finally:
        spark.conf.unset(merging)
    sizes = [r["count"] for r in placed.groupBy("_part").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 12_000


@pytest.mark.parametrize("same", ["1", "map('a', 1)"])
def test_equal_rows_spread_over_tasks(spark, same):
    df = spark.range(0, 40_000, 1, 8).select(F.lit(1).alias("k"), F.expr(same).alias("v"))
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        numbered = number_rows(df, ["k"])
        placed, _ = _place(df, Names.beside(df), ["k"], (), None)
    finally:
        spark.conf.unset(merging)
    assert max(r["count"] for r in placed.groupBy("_part").count().collect()) < 12_000
    assert numbered.agg(F.count_distinct("position"), F.max("position")).first()[:] == (
        40_000,
        39_999,
    )


def test_no_rows(spark):
    empty = spark.createDataFrame([], "key bigint, text string")
    assert chunk_by_rows(empty, ["key"]).count() == 0
    assert chunk_by_bytes(empty, "text", 10, ["key"]).count() == 0
    with pytest.raises(ValueError):
        number_rows(empty)


def test_shard_size_rule():
    assert shard_mb_for(99 * MB) == 20
    assert shard_mb_for(100 * MB) == 100
    assert shard_mb_for(1000 * MB) == 100
    assert shard_mb_for(1001 * MB) == 200
