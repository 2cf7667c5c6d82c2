"""Runs stored whole or not at all, and dedup against what is stored."""

import threading

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.errors import LoadError
from millrace.operators import first_per_key
from millrace.scratch import scratch_path
from millrace.sinks import (
    append_better,
    append_new,
    prepare_run,
    publish,
    read_best,
    read_new,
    read_runs,
    remove_unpublished,
    replace_run,
)
from millrace.sinks import known_keys as kk
from millrace.sinks.runs import last_version, published
from millrace.storage import names_in, write_new
from tests.conftest import plan_of, rows


@pytest.fixture
def path(spark):
    return scratch_path(spark, "test-published")


def dying(spark, n):
    return spark.range(n).select(F.when(F.col("id") == n - 1, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).cast("long").alias("id"))


def test_a_run_that_dies_changes_nothing(spark, path):
    replace_run(spark.range(5), path, "a")
    for _ in range(2):
        with pytest.raises(PySparkException, match="boom"):
            replace_run(dying(spark, 50), path, "a")
    assert rows(read_runs(spark, path, "id long"), "id") == [(i, "a") for i in range(5)]
    replace_run(spark.range(2), path, "a")
    assert rows(read_runs(spark, path, "id long"), "id") == [(0, "a"), (1, "a")]


def test_unpublished_rows_are_not_read_and_can_be_removed(spark, path):
    replace_run(spark.range(3), path, "a")
    forgotten = prepare_run(spark.range(9), path, "a")
    assert read_runs(spark, path, "id long").count() == 3
    assert remove_unpublished(spark, path) == 1 and remove_unpublished(spark, path) == 0
    assert read_runs(spark, path, "id long").count() == 3
    with pytest.raises(PySparkException):
        spark.read.parquet(f"{path}/{forgotten.folder}").count()


def test_a_reader_sees_the_entry_it_began_with(spark, path):
    replace_run(spark.range(4), path, "a")
    before = read_runs(spark, path, "id long")
    replace_run(spark.range(100, 110), path, "a", keep_former=True)
    assert [r.id for r in before.orderBy("id").collect()] == [0, 1, 2, 3]
    assert read_runs(spark, path, "id long").count() == 10
    assert remove_unpublished(spark, path) == 1


def test_outputs_are_published_together(spark, path):
    first = [prepare_run(spark.range(2), path, "r", "good"), prepare_run(spark.range(7), path, "r", "bad")]
    assert last_version(spark, path) == 0
    assert publish(spark, *first) == 1
    assert {r.output for r in published(spark, path).collect()} == {"good", "bad"}
    assert read_runs(spark, path, "id long", output="bad").count() == 7
    assert read_runs(spark, path, "id long", output="none").count() == 0
    with pytest.raises(ValueError):
        publish(spark, first[0], prepare_run(spark.range(1), path + "-other", "r"))


def test_a_writer_that_is_behind_is_refused(spark, path):
    replace_run(spark.range(1), path, "a")
    mine = prepare_run(spark.range(2), path, "b")
    seen = last_version(spark, path)
    replace_run(spark.range(3), path, "c")
    with pytest.raises(LoadError):
        publish(spark, mine, after=seen)
    assert {r.run_id for r in read_runs(spark, path, "id long").collect()} == {"a", "c"}


def test_writers_at_the_same_time_all_count(spark, path):
    pending = [prepare_run(spark.range(i), path, f"r{i}") for i in range(1, 6)]
    threads = [threading.Thread(target=publish, args=(spark, p)) for p in pending]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert last_version(spark, path) == 5
    counts = read_runs(spark, path, "id long").groupBy("run_id").count()
    assert {tuple(r) for r in counts.collect()} == {(f"r{i}", i) for i in range(1, 6)}


def test_small_files_are_written_once(spark, path):
    assert write_new(spark, f"{path}/x", "one") and not write_new(spark, f"{path}/x", "two")
    assert names_in(spark, path) == ["x"] and spark.read.text(f"{path}/x").first().value == "one"
    assert names_in(spark, f"{path}/absent") == []


def keyed(spark, low, high, tag):
    return spark.range(low, high).select(
        F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit(tag).alias("tag"), F.repeat(F.lit("x"), 50).alias("wide")
    )


def test_keys_are_stored_by_the_first_run(spark, path):
    schema = keyed(spark, 0, 1, "").schema
    one = append_new(keyed(spark, 0, 100, "1").union(keyed(spark, 0, 100, "1")), path, "one", "k")
    two = append_new(keyed(spark, 50, 150, "2"), path, "two", "k")
    assert (one.added, one.candidates, one.left_out) == (100, 0, 0)
    assert two.added == 50 and two.left_out == 50 and 50 <= two.candidates <= 60
    again = append_new(keyed(spark, 50, 130, "2b"), path, "two", "k")  # replaces the run
    assert again.added == 30
    three = append_new(keyed(spark, 0, 131, "3"), path, "three", ["k"])  # with the null key
    assert three.added == 1
    got = read_new(spark, path, schema).groupBy("run_id", "tag").agg(F.count("*"), F.min("k"), F.max("k"))
    assert rows(got, "run_id") == [("one", "1", 100, 1, 99), ("three", "3", 1, 130, 130), ("two", "2b", 30, 100, 129)]


def test_only_the_keys_of_the_stored_rows_are_read(spark, path):
    append_new(keyed(spark, 0, 20, "1"), path, "one", "k")
    stored = read_new(spark, path, keyed(spark, 0, 1, "").schema)
    for df in (
        kk.not_stored(keyed(spark, 0, 5, "2"), stored, ["k"]),
        kk.better(keyed(spark, 0, 5, "2"), stored, ["k"], ["tag"]),
    ):
        scans = [line for line in plan_of(df).splitlines() if "FileScan" in line]
        assert scans and not any("wide" in line.split("ReadSchema")[1] for line in scans)


def test_false_positives_stay_within_the_bound_and_the_filter_grows(spark, path):
    buckets = 4
    keys = spark.range(buckets * kk._BITMAP_BITS // kk._BITS_PER_KEY).withColumnRenamed("id", "k")
    known = kk.key_filter(keys, ["k"], buckets).cache()
    assert kk.maybe_known(keys, ["k"], known, buckets, "maybe").where("not maybe").count() == 0
    others = spark.range(10**6, 10**6 + 20_000).withColumnRenamed("id", "k")
    wrong = kk.maybe_known(others, ["k"], known, buckets, "maybe").where("maybe").count() / 20_000
    assert 0.002 < wrong < 0.03  # 1.2 % by the sizes
    n = 2 * kk._BITMAP_BITS // kk._BITS_PER_KEY
    append_new(spark.range(n), path, "one", "id", capacity=100)
    held = read_runs(spark, path, kk._FILTER, output=kk.FILTER)
    assert held.first().buckets > 2 and held.agg(F.sum(F.bitmap_count("bits"))).first()[0] < held.first().buckets * kk._BITMAP_BITS / 2
    assert append_new(spark.range(n + 5), path, "two", "id").added == 5


def test_best_rows_do_not_depend_on_the_order_of_runs(spark):
    parts = [
        spark.createDataFrame(data, "k string, at int, v string")
        for data in (
            [("a", 5, "a5"), ("b", 1, "b1"), (None, 3, "n3"), ("c", None, "c-")],
            [("a", 2, "a2"), ("b", 4, "b4"), (None, 1, "n1"), ("c", 0, "c0")],
            [("a", 3, "a3"), ("a", 9, "a9"), ("d", 7, "d7")],
        )
    ]
    whole = parts[0].union(parts[1]).union(parts[2])
    want = sorted(map(tuple, first_per_key(whole, "k", ["at"]).collect()), key=str)
    for order in ((0, 1, 2), (2, 1, 0), (1, 2, 0)):
        path = scratch_path(spark, "test-best")
        for i in order:
            append_better(parts[i], path, f"r{i}", "k", ["at"])
            append_better(parts[i], path, f"r{i}", "k", ["at"])  # repeated
        got = read_best(spark, path, whole.schema, "k", ["at"]).drop("run_id")
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_reading_a_table_without_runs(spark, path):
    with pytest.raises(LoadError):
        read_new(spark, path, "id long")


def test_the_log_is_folded_and_stays_short(spark, path, monkeypatch):
    from millrace.sinks import runs

    monkeypatch.setattr(runs, "FOLD_EVERY", 4)
    for i in range(14):
        replace_run(spark.range(i, i + 2), path, f"r{i % 5}")
        if i == 7:
            before = read_runs(spark, path, "id long", column="run_id")
            known = published(spark, path)
    assert last_version(spark, path) == 14
    assert sorted(names_in(spark, f"{path}/_log")) == [f"{i:010d}.json" for i in range(9, 15)]
    assert sorted(names_in(spark, f"{path}/_folded")) == [f"{i:010d}{s}" for i in (8, 12) for s in ("", ".done")]
    want = sorted((n, f"r{i % 5}") for i in range(9, 14) for n in (i, i + 1))
    assert rows(read_runs(spark, path, "id long"), "id", "run_id") == want
    assert known.count() == 5 and before.columns == ["id", "run_id"]
    replace_run(spark.range(1), path, "new")
    assert read_runs(spark, path, "id long").count() == 11 and remove_unpublished(spark, path) == 0
