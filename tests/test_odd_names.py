"""Core operators on rows whose columns are named like an operator's own."""

import pytest
from pyspark.sql import functions as F

from millrace.errors import SchemaError
from millrace.functions import free_prefix
from millrace.operators import chunk_by_bytes, chunk_by_rows, first_per_key, number_rows, page, quality_report, sample_rows
from millrace.plans import run_clean

NAMES = (
    "_id _row _rank _apart _position _tie _place _part _size _block _first _total _range _held _base _offset _before"
    " __row _low _high _times _copy _a _b content_a content_b _content_a rank position"
).split()


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.range(60).repartition(4)
    return rows.select("id", *[(F.col("id") * 100 + i).alias(n) for i, n in enumerate(NAMES)], F.lit("text").alias("t"))


def values(df, *extra):
    """Whether every column still holds what it was made with."""
    found = df.orderBy("id").collect()
    return all(r[n] == r.id * 100 + i for r in found for i, n in enumerate(NAMES)) and [r.id for r in found]


def test_every_operator_leaves_user_columns_alone(odd):
    everyone = list(range(60))
    for null_keys in ("collapse", "keep"):
        kept = first_per_key(odd.union(odd), "_rank", null_keys=null_keys)
        assert kept.columns == odd.columns and values(kept) == everyone
    numbered = number_rows(odd, ["_row"], "n")
    assert numbered.columns == [*odd.columns, "n"] and values(numbered) == everyone
    assert all(r.n == r.id for r in numbered.collect())
    by_rows = chunk_by_rows(odd, ["_id"], 7, "chunk")
    assert by_rows.columns == [*odd.columns, "chunk"] and values(by_rows) == everyone
    assert all(r.chunk == r.id // 7 + 1 for r in by_rows.collect())
    by_bytes = chunk_by_bytes(odd, "t", 20, ["_block"], "_chunk")
    assert by_bytes.columns == [*odd.columns, "_chunk"] and values(by_bytes) == everyone
    assert all(r._chunk == r.id * 4 // 20 for r in by_bytes.collect())
    for order in (["_position"], ["content_a", "_a"]):
        cut = page(odd, order, 10, 5)
        assert cut.columns == odd.columns and values(cut) == list(range(10, 15))
    assert values(sample_rows(odd, ["_tie"], 3)) == [0, 1, 2]
    assert quality_report(odd, ["_row", "_part"], "_id").first().duplicate_rows == 0


def test_the_new_column_must_not_exist(odd):
    for call in (number_rows, chunk_by_rows):
        with pytest.raises(SchemaError):
            call(odd, ["id"], into="_ROW")
    with pytest.raises(SchemaError):
        chunk_by_bytes(odd, "t", 10, ["id"], "t")


def test_clean_keeps_fields_named_like_its_own(spark, tmp_path):
    rows = [(i, f"f{i}", f"p{i}", i % 2 == 0) for i in range(20)]
    spark.createDataFrame(rows, "id long, _file string, _problem string, _good boolean").write.json(f"{tmp_path}/in")
    report = run_clean(
        spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/bad",
        "id bigint, _file string, _problem string, _good boolean", required=["id", "_file"], key="id",
    )
    assert (report.records, report.rejected_lines, report.rows_written) == (20, 0, 20)
    out = spark.read.parquet(f"{tmp_path}/out").select("id", "_file", "_problem", "_good")
    assert sorted(map(tuple, out.collect())) == rows


def test_free_prefix():
    assert free_prefix(["a", "b_"]) == "_" and free_prefix(["_x", "__y"]) == "___" and free_prefix([]) == "_"


def test_a_key_that_does_not_convert_is_rejected_by_the_batch_job(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"id":"x1","n":"3"}\n{"id":"x2","n":"4"}\n{"id":"7","n":"odd"}\n{"id":null,"n":1}\n')
    report = run_clean(spark, f"{tmp_path}/in.json", f"{tmp_path}/out", f"{tmp_path}/bad", "id bigint, n int", required=["id"])
    assert (report.records, report.rejected_lines, report.coerced) == (2, 2, {"n": 1})
    assert {r.problem for r in spark.read.parquet(f"{tmp_path}/bad").collect()} == {"type_mismatch"}
    loose = run_clean(
        spark, f"{tmp_path}/in.json", f"{tmp_path}/out2", f"{tmp_path}/bad2", "id bigint, n int", required=["id"], reject_mismatch=False
    )
    assert (loose.records, loose.rejected_lines, loose.coerced) == (4, 0, {"id": 2, "n": 1})
