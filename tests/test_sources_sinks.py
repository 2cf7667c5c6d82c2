from pathlib import Path
import json
import os
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from millrace.errors import EmptyInputError, LoadError, SchemaError
from millrace.operators import json_profile
from millrace.plans import land_in_chunks, run_load, split_to_shards
from millrace.plans.split import split_lines
from millrace.scratch import drop_staged, scratch_path, scratch_root, stage
from millrace.sinks import (
    Target,
    append_once,
    append_parquet,
    jdbc_target,
    parquet_target,
    read_runs,
    replace_run,
    staged_load,
    write_jsonl,
)
from millrace.sources import (
    file_inventory,
    jdbc_options,
    key_ranges,
    read_jdbc,
    read_lines,
    read_table,
    require_rows,
    total_bytes,
)
from millrace.sources.tables import quantile_bounds
from tests.conftest import plan_of, rows


def test_inventory_does_not_read_content(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x" * 10)
    (tmp_path / "b.txt").write_text("y" * 5)
    found = file_inventory(spark, str(tmp_path))
    assert "content" not in plan_of(found)
    assert sorted(r["length"] for r in found.collect()) == [5, 10]
    assert total_bytes(spark, str(tmp_path)) == 15
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        file_inventory(spark, str(tmp_path / "absent"))


def test_empty_input_is_an_error_only_when_asked(spark):
    with pytest.raises(EmptyInputError):
        require_rows(spark.range(0))
    assert require_rows(spark.range(1)).count() == 1


def test_profile_tells_layouts_apart(spark, tmp_path):
    files = {
        "lines.json": '\n  {"a":1}\nbroken\n{"b":"x"}\n\n',
        "array.json": '\n [\n {"a":1},\n {"a":2}\n]\n',
        "badarray.json": '[{"a":1},\n',
        "scalars.json": "1\n2\n",
        "blank.json": "\n  \n",
        "broken.json": '{"a":\n',
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    found = {r["file"].rsplit("/", 1)[1]: r for r in json_profile(spark, str(tmp_path)).collect()}

    def flags(name):
        r = found[name]
        return r["is_valid"], r["is_array"], r["is_line_delimited"]

    assert flags("lines.json") == (True, False, True)
    assert flags("array.json") == (True, True, False)
    assert flags("badarray.json") == (False, True, False)
    assert flags("scalars.json") == (True, False, False)
    assert flags("blank.json") == (False, False, False)
    assert flags("broken.json") == (False, False, True)
    lines = found["lines.json"]
    assert (lines["lines"], lines["blank_lines"], lines["valid_lines"]) == (5, 2, 2)
    assert lines["sample"] == '{"a":1}'
    assert lines["sample_schema"] == "OBJECT<a: BIGINT, b: STRING>"


def test_shards_hold_every_valid_line_once_and_in_order(spark, tmp_path):
    lines = [json.dumps({"i": i, "pad": "é" * (i % 50)}, ensure_ascii=False) for i in range(3000)]
    lines[5:5] = ["", "not json", '{"cut":', "   "]
    (tmp_path / "in.json").write_text("\n".join(lines) + "\n")
    out = scratch_path(spark, "test-shards")
    split_lines(read_lines(spark, str(tmp_path)), out, 10_000)
    back = spark.read.text(out).withColumn("file", F.col("_metadata.file_path"))
    per_shard = back.groupBy("shard_id").agg(
        F.count_distinct("file").alias("files"), F.sum(F.octet_length("value")).alias("bytes")
    )
    shards = {r["shard_id"]: r for r in per_shard.collect()}
    assert all(r["files"] == 1 for r in shards.values())
    assert all(abs(r["bytes"] - 10_000) <= 150 for s, r in shards.items() if s != max(shards))
    got = []
    for shard in sorted(shards):
        files = back.where(F.col("shard_id") == shard).select("file").distinct()
        for file in files.collect():
            text = open(file["file"].removeprefix("file:").replace("///", "/")).read()
            got += [json.loads(line)["i"] for line in text.splitlines()]
    assert got == list(range(3000))


def test_shards_stay_in_order_across_files_and_blocks(spark, tmp_path):
    lines = [json.dumps({"i": i, "pad": "x" * (i % 90)}) for i in range(30_000)]
    for part in range(3):
        text = "\n".join(lines[part * 10_000 : (part + 1) * 10_000])
        (tmp_path / f"in-{part}.json").write_text(text)
    out = scratch_path(spark, "test-order")
    block = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(block, "100kb")
    try:
        split_lines(read_lines(spark, str(tmp_path)), out, 400_000)
    finally:
        spark.conf.unset(block)
    got = []
    for shard in sorted(p for p in os.listdir(out) if p.startswith("shard_id=")):
        files = [f for f in os.listdir(f"{out}/{shard}") if f.endswith(".txt")]
        assert len(files) == 1
        with open(f"{out}/{shard}/{files[0]}") as handle:
            got += [json.loads(line)["i"] for line in handle]
    assert got == list(range(30_000))


def test_shard_names_are_padded_and_the_rule_picks_the_target(spark, tmp_path):
    (tmp_path / "in.json").write_text('[{"a":1},5,{"a":2}]')
    out = scratch_path(spark, "test-array")
    assert split_to_shards(spark, str(tmp_path), out, layout="array") == 100
    assert rows(spark.read.text(out + "/shard_id=000000000"), "value") == [
        ("5",), ('{"a":1}',), ('{"a":2}',),
    ]
    with pytest.raises(ValueError):
        split_to_shards(spark, str(tmp_path), out, layout="xml")


def test_jsonl_keeps_null_fields(spark, tmp_path):
    path = scratch_path(spark, "test-jsonl")
    write_jsonl(spark.sql("select 1 as a, cast(null as string) as b"), path)
    assert rows(spark.read.text(path)) == [('{"a":1,"b":null}',)]


def test_append_adds_and_run_replaces(spark):
    path = scratch_path(spark, "test-append")
    df = spark.range(3)
    append_parquet(df, path)
    append_parquet(df, path)
    assert read_table(spark, path, df.schema).count() == 6
    runs = scratch_path(spark, "test-runs")
    for run, n in (("a", 3), ("b", 2), ("a", 4)):
        replace_run(spark.range(n), runs, run)
    counts = read_runs(spark, runs, "id long").groupBy("run_id").count()
    assert {tuple(r) for r in counts.collect()} == {("a", 4), ("b", 2)}


def test_runs_leave_no_stale_rows_and_keep_their_ids(spark):
    runs = scratch_path(spark, "test-stale")
    for run, n in (("2024-05-01", 4), ("2024-05-01", 0), ("001", 2), ("a/b=c", 1)):
        replace_run(spark.range(n), runs, run)
    back = read_runs(spark, runs, "id long")
    assert {tuple(r) for r in back.groupBy("run_id").count().collect()} == {("001", 2), ("a/b=c", 1)}
    assert spark.read.parquet(f"{runs}/run_id=2024-05-01").drop("write").columns == ["id"]
    with pytest.raises(SchemaError):
        replace_run(spark.range(1).withColumnRenamed("id", "RUN_ID"), runs, "x")


def test_repeated_load_adds_only_what_is_missing(spark):
    target = parquet_target(scratch_path(spark, "test-load"))
    df = spark.range(10).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), "id")
    partly = append_once(df.where("id < 4"), target, "x", ["k"], new_table=True)
    assert partly.rows_added == 4
    assert append_once(df, target, "x", ["k"], new_table=True).rows_added == 6
    assert append_once(df, target, "x", ["k"]).rows_added == 0
    assert append_once(df, target, "y", ["k"]).rows_added == 10
    assert target.read(spark).count() == 20


def test_load_into_a_missing_table_raises(spark):
    target = parquet_target(scratch_path(spark, "test-absent"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        append_once(spark.range(1), target, "x", ["id"])
    with pytest.raises(ValueError):
        run_load(spark, scratch_path(spark, "none"), target, "id bigint", load_id="x")


def test_staged_load_checks_and_publishes(spark):
    staging = parquet_target(scratch_path(spark, "test-staging"))
    sql = staged_load(spark.range(3).withColumn('odd"name', F.lit(1)), staging, "final")
    assert sql.startswith('INSERT INTO final ("id", "odd""name") SELECT "id", "odd""name" FROM ')

    class Lossy(Target):
        def write(self, df, mode="append"):
            super().write(df, mode)
            super().write(df.limit(1), "overwrite")

    with pytest.raises(LoadError):
        staged_load(spark.range(3), Lossy("parquet", {"path": scratch_path(spark, "l")}), "final")


def test_run_load_counts(spark):
    path = scratch_path(spark, "test-refined")
    append_parquet(spark.range(5), path)
    target = parquet_target(scratch_path(spark, "test-final"))
    assert run_load(spark, path, target, "id bigint").rows_added == 5
    with pytest.raises(LoadError, match="load_id"):
        run_load(spark, path, target, load_id="l", keys=["id"])
    fresh = parquet_target(scratch_path(spark, "test-fresh"))
    for expected in (5, 0):
        report = run_load(spark, path, fresh, load_id="l", keys=["id"], new_table=True)
        assert report.rows_added == expected


# No database runs in the tests: these check what Spark's JDBC source is asked for.


def test_jdbc_read_is_sliced():
    session = MagicMock()
    options = jdbc_options("jdbc:x:y", "(SELECT * FROM t) q", "d.Driver", fetch_rows=500)
    read_jdbc(session, options, "id", (0, 1000), partitions=4)
    reader = session.read.format
    reader.assert_called_with("jdbc")
    given = reader.return_value.options
    given.assert_called_with(
        url="jdbc:x:y", dbtable="(SELECT * FROM t) q", driver="d.Driver", fetchsize="500"
    )
    given.return_value.options.assert_called_with(
        partitionColumn="id", lowerBound="0", upperBound="1000", numPartitions="4"
    )
    read_jdbc(session, options, predicates=["a < 1", "a >= 1"])
    session.read.jdbc.assert_called_with(
        "jdbc:x:y",
        "(SELECT * FROM t) q",
        predicates=["a < 1", "a >= 1"],
        properties={"driver": "d.Driver", "fetchsize": "500"},
    )
    with pytest.raises(ValueError):
        read_jdbc(session, options, "id")


def test_jdbc_write_is_batched_and_bounded():
    df, target = MagicMock(), jdbc_target("jdbc:x:y", "public.t", connections=4)
    target.write(df)
    df.write.format.assert_called_with("jdbc")
    first = df.write.format.return_value.options
    first.assert_called_with(url="jdbc:x:y", dbtable="public.t")
    first.return_value.options.assert_called_with(batchsize="1000", numPartitions="4")
    first.return_value.options.return_value.mode.assert_called_with("append")


def test_key_ranges_hold_each_row_once(spark):
    df = spark.range(100).select(
        F.when(F.col("id") % 10 != 0, F.col("id") % 7).alias("k"),
        F.concat(F.lit("o'"), (F.col("id") % 5).cast("string")).alias("s"),
    )
    for column, bounds in (("k", [1, 2, 6]), ("s", ["o'1", "o'3"]), ("k", [])):
        cuts = key_ranges(column, bounds)
        assert sum(df.where(c).count() for c in cuts) == 100
    with pytest.raises(ValueError):
        key_ranges("k", [2, 1])
    skewed = spark.range(1000).select(F.greatest(F.col("id") - 500, F.lit(0)).alias("k"))
    assert quantile_bounds(skewed, "k", 4) == sorted(set(quantile_bounds(skewed, "k", 4)))


def test_landed_chunks_are_one_file_each(spark):
    path = scratch_path(spark, "test-land")
    land_in_chunks(spark.range(45), path, ["id"], rows=20)
    back = spark.read.parquet(path)
    per = back.groupBy("batch_id").agg(
        F.count("id"), F.min("id"), F.count_distinct(F.col("_metadata.file_path"))
    )
    assert rows(per, "batch_id") == [(1, 20, 0, 1), (2, 20, 20, 1), (3, 5, 40, 1)]
    first = spark.read.parquet(f"{path}/batch_id=1").collect()
    assert [r["id"] for r in first] == list(range(20))
    assert back.where("ingest_time is null").count() == 0


def test_scratch_follows_the_session(spark):
    fake = MagicMock()
    shared = {"spark.checkpoint.dir": "s3a://b/ck/"}
    fake.conf.get = lambda key, default=None: shared.get(key, default)
    assert scratch_root(fake) == "s3a://b/ck"
    warehouse = {"spark.sql.warehouse.dir": "hdfs:/wh/"}
    fake.conf.get = lambda key, default=None: warehouse.get(key, default)
    assert scratch_root(fake) == "hdfs:/wh/_scratch"
    staged = stage(spark.range(3), "test-stage")
    assert rows(staged, "id") == [(0,), (1,), (2,)]
    folder = Path(staged.inputFiles()[0].removeprefix("file:")).parent
    drop_staged(staged, None)
    assert not folder.exists()


def test_unreadable_files_raise_or_are_left_out(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"id":1,"name":"a","city":"b"}\n')
    (tmp_path / "bad.json.gz").write_bytes(b"\x1f\x8bnot gzip at all")
    with pytest.raises(Exception, match="(?i)gzip|header|FAILED_READ_FILE"):
        read_lines(spark, str(tmp_path)).collect()
    kept = read_lines(spark, str(tmp_path), ignore_corrupt_files=True)
    assert [r["value"] for r in kept.collect()] == ['{"id":1,"name":"a","city":"b"}']


def test_lines_that_are_arrays_are_no_array_document(spark, tmp_path):
    (tmp_path / "lines.json").write_text('[{"a":1}]\n[{"a":2}]\n')
    (tmp_path / "document.json").write_text('[{"a":1},\n{"a":2}]\n')
    (tmp_path / "one.json").write_text('[{"a":1}]\n')
    found = {r["file"].rsplit("/", 1)[1]: r for r in json_profile(spark, str(tmp_path)).collect()}
    kinds = {k: (r["is_array"], r["is_line_delimited"], r["is_valid"]) for k, r in found.items()}
    assert kinds == {
        "lines.json": (False, True, True),
        "document.json": (True, False, True),
        "one.json": (True, False, True),
    }
