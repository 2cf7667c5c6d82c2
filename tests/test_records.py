import pytest
from pyspark.sql import functions as F

from millrace.errors import SchemaError
from millrace.operators import parse_lines, records_with_problems, rejected_lines
from millrace.operators.records import drop_corrupt
from millrace.sources import array_elements, read_json
from millrace.scratch import scratch_path, stage
from tests.conftest import plan_of, rows

LINES = [
    '{"id":1,"n":"89"}',
    '{"id":2,"n":4.5}',
    '{"id":3,"n":{"x":1}}',
    '[{"id":4,"n":1},{"id":5}]',
    "[]",
    "",
    "   ",
    "123",
    '[{"id":6},7]',
    '[{"id":6},null]',
    '{"id":7',
    '{"id":8,"id":9}',
    '{"id":10} tail',
]


@pytest.fixture
def lines(spark):
    return spark.createDataFrame([(v, i) for i, v in enumerate(LINES)], "value string, i int")


def test_loose_types_convert_or_become_null(lines):
    assert rows(parse_lines(lines, "id bigint, n bigint"), "id") == [
        (1, 89), (2, None), (3, None), (4, 1), (5, None), (9, None),
    ]


def test_every_line_is_accounted_for(lines):
    both = records_with_problems(lines, "id bigint", keep=["i"])
    seen = {r["i"] for r in both.collect()}
    blank_or_empty_array = {4, 5, 6}
    assert seen == set(range(len(LINES))) - blank_or_empty_array
    problems = {r["i"]: r["problem"] for r in both.collect() if r["problem"]}
    assert problems == {
        7: "not_object", 8: "not_object", 9: "not_object", 10: "invalid_json", 12: "invalid_json",
    }
    kept = both.where("problem is not null").select("i", "line")
    assert all(LINES[i].strip() == line for i, line in rows(kept))


def test_mismatches_can_be_rejected(lines):
    loose = records_with_problems(lines, "id bigint, n bigint", keep=["i"], reject_mismatch=True)
    assert {r["i"] for r in loose.where("problem = 'type_mismatch'").collect()} == {1, 2}
    strict = records_with_problems(lines, "id bigint, n bigint", keep=["i"], strict_types=True)
    assert {r["i"] for r in strict.where("problem = 'type_mismatch'").collect()} == {0, 1, 2}


def test_mismatch_inside_an_array_line_rejects_the_line(spark):
    df = spark.createDataFrame([('[{"n":1},{"n":"x"}]',)], "value string")
    both = records_with_problems(df, "n bigint", reject_mismatch=True)
    assert rows(both) == [(None, "type_mismatch", '[{"n":1},{"n":"x"}]')]


def test_nested_and_decimal_fields_parse_natively(spark):
    df = spark.createDataFrame(
        [('{"d":12345678901234567.25,"a":[1,2],"s":{"x":"y"}}',), ('{"a":"no list"}',)],
        "value string",
    )
    both = records_with_problems(df, "d decimal(20,2), a array<int>, s struct<x:string>")
    good = both.where("problem is null").collect()[0]
    assert str(good["d"]) == "12345678901234567.25"
    assert good["a"] == [1, 2] and good["s"]["x"] == "y"
    assert [r["problem"] for r in both.where("problem is not null").collect()] == ["type_mismatch"]


def test_rejects_agree_with_and_without_schema(lines):
    plain = rejected_lines(lines, keep=["i"])
    typed = rejected_lines(lines, keep=["i"], schema="id bigint")
    assert rows(plain, "i") == rows(typed, "i")


def test_good_lines_are_parsed_once(lines):
    for df in (parse_lines(lines, "id bigint"), parse_lines(lines, "id bigint").where("id > 3")):
        above, below = plan_of(df).split("Generate", 1)
        assert "from_json" not in above
        # One parse for objects and one for arrays, each behind its own condition.
        parses = next(step for step in below.splitlines() if " AS _one" in step)
        assert parses.count("from_json") == 2
        scan = below.split(" AS _many")[-1]
        assert "from_json" not in scan


def test_field_names_of_our_own_outputs(spark):
    df = spark.createDataFrame([('{"line":1,"problem":"p","file":"f"}',), ("x",)], "value string")
    fields = "line bigint, problem string, file string"
    assert rows(parse_lines(df, fields)) == [(1, "p", "f")]
    with pytest.raises(SchemaError):
        records_with_problems(df, fields)
    both = records_with_problems(df, fields, problem_column="why", line_column="raw")
    assert rows(both.where("why is not null").select("why", "raw")) == [("invalid_json", "x")]


def test_reader_with_corrupt_column(spark):
    path = scratch_path(spark, "test-corrupt")
    spark.createDataFrame([('{"id":1}',), ('{"id":',), ("5",)], "value string").write.text(path)
    read = stage(read_json(spark, path, "id bigint"), "test-read")
    assert rows(drop_corrupt(read)) == [(1,)]
    assert drop_corrupt(read).count() == 1


def test_unreadable_files_raise_unless_told_otherwise(spark, tmp_path):
    (tmp_path / "a.json.gz").write_bytes(b"\x1f\x8b\x08\x00broken")
    (tmp_path / "b.json").write_text('{"id":1}\n')
    schema = "id bigint"
    with pytest.raises(Exception):
        read_json(spark, str(tmp_path), schema).select("id").collect()
    skipped = read_json(spark, str(tmp_path), schema, ignore_corrupt_files=True)
    assert rows(skipped.select("id")) == [(1,)]


def test_one_schema_for_files_that_drift(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id":7,"none":null}\n')
    (tmp_path / "b.json").write_text('{"id":"x"}\n')
    df = read_json(spark, str(tmp_path))
    assert df.schema["id"].dataType.simpleString() == "string"
    assert df.schema["none"].dataType.simpleString() == "string"
    assert {r["id"] for r in df.collect()} == {"7", "x"}


def test_array_documents_keep_every_kind_of_element(spark):
    docs = spark.createDataFrame(
        [
            ('[{"b":1,"a":[1]},5,"x",null]', 1), ("[]", 2), ("[1] x", 3), ('{"a":1}', 4),
            ('[{"a":1,"a":2}]', 5), ("", 6),
        ],
        "value string, i int",
    )
    found = array_elements(docs, keep=["i"])
    assert [r["value"] for r in found.where("i = 1").collect()] == [
        '{"a":[1],"b":1}', "5", '"x"', "null",
    ]
    assert {(r["i"], r["problem"]) for r in found.where("problem is not null").collect()} == {
        (3, "invalid_json"), (4, "not_object"), (5, "repeated_key"),
    }


def test_large_array_document_is_read_whole(spark, tmp_path):
    body = ",".join('{"id":%d,"pad":"%s"}' % (i, "x" * 80) for i in range(20_000))
    (tmp_path / "big.json").write_text(f"[{body}]")
    from millrace.sources import read_documents

    docs = read_documents(spark, str(tmp_path))
    assert parse_lines(docs, "id bigint").agg(F.count_distinct("id")).first()[0] == 20_000
