"""Schema drift, unreadable files, new files only, pages by key."""

import gzip
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from millrace.errors import LoadError, SchemaError
from millrace.operators import key_pages
from millrace.schema import merge_schemas, widened
from millrace.scratch import scratch_path
from millrace.sinks import append_run, read_merged
from millrace.sinks.runs import last_version
from millrace.sources import probe_files, read_file_runs, run_new_files, split_readable, unread_files
from millrace.sources.new_files import read_files_read
from tests.conftest import plan_of, rows


@pytest.fixture
def path(spark):
    return scratch_path(spark, "test-upkeep")


@pytest.mark.parametrize(
    "one, two, want",
    [
        ("int", "bigint", "bigint"), ("smallint", "tinyint", "smallint"), ("float", "double", "double"), ("int", "double", "double"),
        ("bigint", "double", None), ("int", "string", None), ("decimal(5,2)", "decimal(6,1)", "decimal(7,2)"),
        ("decimal(38,0)", "decimal(38,2)", None), ("date", "timestamp_ntz", "timestamp_ntz"), ("date", "timestamp", None),
        ("array<int>", "array<bigint>", "array<bigint>"), ("map<string,int>", "map<string,bigint>", "map<string,bigint>"),
        ("map<string,int>", "map<int,int>", None), ("struct<a:int>", "struct<a:bigint,b:string>", "struct<a:bigint,b:string>"),
        ("struct<a:int>", "struct<a:string>", None), ("boolean", "int", None), ("float", "bigint", None),
    ],
)
def test_widening(spark, one, two, want):
    kinds = [T.DataType.fromDDL(k) for k in (one, two)]
    for a, b in (kinds, kinds[::-1]):
        found = widened(a, b)
        assert (found.simpleString() if found else None) == want


def test_merged_schemas_name_what_does_not_fit(spark):
    one, two = T.StructType.fromDDL("a int, b string"), T.StructType.fromDDL("B string, A bigint, c date")
    assert merge_schemas(one, two).simpleString() == "struct<a:bigint,b:string,c:date>"
    with pytest.raises(SchemaError, match="'b' is string here and int there"):
        merge_schemas(one, T.StructType.fromDDL("b int"))


def test_drift_is_read_under_one_schema_or_refused(spark, path):
    append_run(spark.sql("select cast(1 as int) as k, cast(2 as float) as f, struct(1 as x) as s"), path, "a")
    append_run(spark.sql("select 3000000000 as k, 'new' as t, struct(2 as x, 'y' as y) as s"), path, "b")
    before = last_version(spark, path)
    with pytest.raises(SchemaError, match=r"run_id=a/write=.*'k' is int here and string there"):
        append_run(spark.sql("select 'x' as k"), path, "c")
    assert last_version(spark, path) == before
    got = {r.run_id: r for r in read_merged(spark, path).collect()}
    assert (got["a"].k, got["a"].f, got["a"].t, got["a"].s) == (1, 2.0, None, (1, None))
    assert (got["b"].k, got["b"].f, got["b"].t, got["b"].s) == (3000000000, None, "new", (2, "y"))
    append_run(spark.sql("select 'x' as k"), scratch_path(spark, "test-other"), "c")
    append_run(spark.sql("select cast(5 as smallint) as k"), path, "b")  # the run that had more is replaced
    assert read_merged(spark, path).schema["k"].dataType.simpleString() == "int"
    with pytest.raises(LoadError):
        read_merged(spark, scratch_path(spark, "test-none"))


def test_unreadable_files_are_named_and_left_out(spark, tmp_path):
    for i in range(5):
        spark.range(i * 1000, i * 1000 + 1000).coalesce(1).write.parquet(f"{tmp_path}/p{i}")
    file = {i: next(str(f) for f in (tmp_path / f"p{i}").glob("*.parquet")) for i in range(5)}
    whole = open(file[1], "rb").read()
    open(file[1], "wb").write(whole[: len(whole) // 2])
    open(file[2], "wb").write(whole[:20] + bytes(len(whole) // 2) + whole[20 + len(whole) // 2 :])
    open(file[3], "wb").write(b"")  # holds nothing to read, and Spark's scans leave such files out
    for i in (1, 2, 3):  # without the file system's own checksums, which tell of the last one alone
        crc = file[i].rsplit("/", 1)
        os.remove(f"{crc[0]}/.{crc[1]}.crc")
    open(file[4], "r+b").write(b"PARX")
    good, bad = split_readable(probe_files(spark, f"{tmp_path}/p*/*.parquet"))
    assert spark.read.parquet(*good).count() == 1000
    assert {r.path.rsplit("/", 2)[1]: r.reason for r in bad.collect()} == {"p1": "no_footer", "p2": "broken_block", "p4": "unreadable"}
    texts = tmp_path / "texts"
    texts.mkdir()
    lines = "".join(f"line {i}\n" for i in range(5000)).encode()
    packed = gzip.compress(lines)
    (texts / "whole.gz").write_bytes(packed)
    (texts / "two.gz").write_bytes(packed + gzip.compress(b"more\n"))
    (texts / "cut.gz").write_bytes(packed[:-100])
    (texts / "sum.gz").write_bytes(packed[:-8] + b"\0" * 8)
    (texts / "none.gz").write_bytes(b"plain text")
    (texts / "plain.txt").write_bytes(b"\xff\xfe")
    found = {r.path.rsplit("/", 1)[1]: r.reason for r in probe_files(spark, str(texts)).collect()}
    assert found == {
        "whole.gz": None, "two.gz": None, "cut.gz": "cut_short", "sum.gz": "broken_block", "none.gz": "broken_block", "plain.txt": None,
    }


def test_every_file_is_read_by_one_run(spark, tmp_path, path):
    def job(paths):
        return spark.read.text(paths).withColumnRenamed("value", "line")

    (tmp_path / "a.txt").write_text("a\n")
    (tmp_path / "b.txt").write_text("b\n")
    one = run_new_files(spark, str(tmp_path), path, "1", job)
    assert (one.files, one.bytes) == (2, 4) and unread_files(spark, str(tmp_path), path).count() == 0
    (tmp_path / "c.txt").write_text("c\n")
    with pytest.raises(PySparkException, match="boom"):
        run_new_files(spark, str(tmp_path), path, "2", lambda p: job(p).withColumn("line", F.raise_error(F.lit("boom")).cast("string")))
    assert run_new_files(spark, str(tmp_path), path, "3", job).files == 1
    assert run_new_files(spark, str(tmp_path), path, "4", job).files == 0
    (tmp_path / "a.txt").write_text("a changed\n")
    os.utime(tmp_path / "a.txt", (2_000_000_000, 2_000_000_000))
    assert run_new_files(spark, str(tmp_path), path, "5", job).files == 1
    got = rows(read_file_runs(spark, path, "line string"), "line")
    assert got == [("a", "1"), ("a changed", "5"), ("b", "1"), ("c", "3")]
    assert read_files_read(spark, path).count() == 4
    assert "content" not in plan_of(unread_files(spark, str(tmp_path), path))


def test_pages_by_key_miss_nothing_at_their_borders(spark, path):
    df = spark.range(1000).select(
        F.when(F.col("id") >= 10, F.least(F.col("id") % 50, F.lit(30))).alias("k"), F.col("id").alias("v")
    )
    df.write.parquet(path)
    stored = spark.read.parquet(path)
    pages = key_pages(stored, "k", 100)
    assert 5 <= len(pages) <= 10
    got = [sorted(r.v for r in pages.read(stored, i).collect()) for i in range(len(pages))]
    assert sorted(sum(got, [])) == list(range(1000))
    keys = [{r.k for r in pages.read(stored, i).select("k").distinct().collect()} for i in range(len(pages))]
    assert all(not a & b for i, a in enumerate(keys) for b in keys[i + 1 :]) and None in keys[0]
    assert [r.k for r in pages.after(stored, pages.bounds[0]).agg(F.max("k").alias("k")).collect()] == [pages.bounds[1]]
    assert pages.after(stored, pages.bounds[-1]).count() == len(got[-1])
    plan = plan_of(pages.read(stored, 2))
    assert "PushedFilters: [IsNotNull(k), GreaterThan(k," in plan and "Sort" not in plan and "Exchange" not in plan
    one = key_pages(stored, "k", 5000)
    assert len(one) == 1 and one.read(stored, 0).count() == 1000
    with pytest.raises(ValueError):
        pages.read(stored, len(pages))
    assert len(key_pages(stored.where("false"), "k", 10)) == 1
