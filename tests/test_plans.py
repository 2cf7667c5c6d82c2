import os

import pytest
from pyspark.sql import functions as F

from millrace.errors import MissingColumnsError
from millrace.plans import clean_lines, run_clean
from millrace.registry import all_oracles, all_queries, batch
from millrace.scratch import scratch_path
from tests.conftest import plan_of, rows

SCHEMA = "id bigint, name string, city string, n bigint"


@pytest.fixture
def folder(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"id":1,"name":"a","city":"x","n":2}\n{"id":1,"name":"a","city":"x","n":1}\n123\n\n'
    )
    (tmp_path / "b.json").write_text(
        '{"id":1,"name":"late"}\n{"id":2,"city":"y","n":"7"}\r\n{"name":"no key"}\n{"id":3,\n'
        '[{"id":4,"n":"x"},{"id":4}]\n'
    )
    return str(tmp_path)


def test_clean_job(spark, folder):
    before = {f: os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder)}
    out, bad = scratch_path(spark, "test-out"), scratch_path(spark, "test-bad")
    for _ in range(2):
        report = run_clean(
            spark, folder, out, bad, SCHEMA, run_id="r", order_by=[F.col("n").asc_nulls_last()],
            constants={"source": "s"},
        )
    assert (report.records, report.rejected_lines) == (7, 2)
    assert (report.rows_written, report.duplicates_removed) == (4, 3)
    assert report.nulls == {"id": 1, "name": 3, "city": 4}
    assert sum(report.coerced.values()) == 1
    got = spark.read.parquet(out)
    assert rows(got.select("id", "name", "n"), "id") == [
        (None, "no key", None), (1, "a", 1), (2, None, 7), (4, None, None),
    ]
    assert got.where("length(salt) = 64 and source = 's'").count() == 3
    assert {(r["problem"], r["line"]) for r in spark.read.parquet(bad).collect()} == {
        ("not_object", "123"), ("invalid_json", '{"id":3,'),
    }
    assert {f: os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder)} == before


def test_clean_job_appends_without_a_run_id(spark, folder):
    out, bad = scratch_path(spark, "test-out"), scratch_path(spark, "test-bad")
    for _ in range(2):
        run_clean(spark, folder, out, bad, SCHEMA)
    assert spark.read.parquet(out).count() == 8


def test_clean_job_with_field_names_of_its_own_outputs(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id":1,"file":"f","line":2,"problem":"p"}\nbad\n')
    out, bad = scratch_path(spark, "test-out"), scratch_path(spark, "test-bad")
    fields = "id bigint, file string, line bigint, problem string"
    run_clean(spark, str(tmp_path), out, bad, fields, required=["id"])
    row = spark.read.parquet(out).first()
    assert (row["file"], row["line"], row["problem"]) == ("f", 2, "p")
    reject = spark.read.parquet(bad).first()
    assert reject["file"].endswith("a.json") and reject["line"] == "bad"


def test_missing_required_columns_stop_the_job_before_it_reads(spark, folder):
    with pytest.raises(MissingColumnsError, match="name, city"):
        run_clean(spark, folder, "unused", "unused", "id bigint")


def test_key_hash_of_another_column(spark, folder):
    out = clean_lines(spark.read.text(folder), SCHEMA, hash_column="absent", null_keys="keep")
    assert out.where("salt is null").count() == 1


def test_clean_plan_has_one_shuffle_and_one_scan(spark, folder):
    plan = plan_of(clean_lines(spark.read.text(folder), SCHEMA, order_by=["n"]))
    assert plan.count("Exchange") == 1
    assert plan.count("FileScan") == 1
    assert "Partial" in plan[plan.index("Exchange") :]


def test_scans_read_only_what_is_needed(spark, data_dir):
    plan = plan_of(batch.dedup_first(spark, data_dir))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in plan
    plan = plan_of(batch.row_count(spark, data_dir))
    assert "ReadSchema: struct<>" in plan
    plan = plan_of(batch.null_report(spark, data_dir))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in plan


def test_every_oracle_belongs_to_a_query():
    assert set(all_oracles()) <= set(all_queries())
    assert set(all_queries()) - set(all_oracles()) == set()
