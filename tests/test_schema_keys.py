import hashlib

import pytest
from pyspark.sql import types as T

from millrace.errors import MissingColumnsError, SchemaError
from millrace.functions import (
    add_constants,
    add_key_hash,
    choose_key_column,
    drop_columns,
    salted_hash,
    stamp,
)
from millrace.schema import as_schema, build_schema, require_columns, review_schema
from tests.conftest import rows


def test_declared_schema(spark):
    schema = build_schema(
        [
            {"name": "a", "type": "integer", "nullable": False},
            {"name": "b", "type": "array<decimal(5,2)>"},
        ]
    )
    assert schema["a"].dataType == T.IntegerType() and not schema["a"].nullable
    assert schema["b"].dataType == T.ArrayType(T.DecimalType(5, 2))
    assert as_schema("x int") == T.StructType().add("x", T.IntegerType())
    assert as_schema(schema) is schema


def test_bad_declarations_raise(spark):
    with pytest.raises(SchemaError, match="unknown type 'intger'"):
        build_schema([{"name": "a", "type": "intger"}])
    with pytest.raises(SchemaError, match="declared twice"):
        build_schema([{"name": "a", "type": "int"}, {"name": "A", "type": "int"}])


def test_review_schema(spark):
    types = [(f.name, f.dataType.simpleString(), f.nullable) for f in review_schema()]
    assert len(types) == 11
    assert ("Time", "int", True) in types and ("ingest_time", "timestamp", True) in types


def test_required_columns(spark):
    df = spark.sql("select 1 as id, 2 as Name")
    with pytest.raises(MissingColumnsError) as found:
        require_columns(df)
    assert found.value.missing == ["name", "city"]
    assert require_columns(df, ["id"]) is df


def test_key_hash_equals_hashlib(spark):
    df = spark.sql("select * from values (1, 'x'), (null, null), (-3, 'é') as t(n, s)")
    got = rows(df.select("n", "s", salted_hash("n").alias("hn"), salted_hash("s", "z").alias("hs")))

    def digest(value, salt):
        return None if value is None else hashlib.sha256(f"{value}{salt}".encode()).hexdigest()

    for n, s, hn, hs in got:
        assert hn == digest(n, "salt_key") and hs == digest(s, "z")


def test_choice_of_key_column():
    assert choose_key_column(["a", "id"]) == "id"
    assert choose_key_column(["name", "Provider", "user_id"]) == "Provider"
    assert choose_key_column(["name", "provider", "uid"], candidates=["x", "uid"]) == "uid"
    assert choose_key_column(["name"]) is None
    assert choose_key_column(["name", "uid"], candidates=[]) is None


def test_fallbacks_without_a_key_column(spark):
    df = spark.range(100).selectExpr("id % 3 as v", "'t' as w").repartition(4)
    numbered = add_key_hash(df)
    assert numbered.select("row_id").distinct().count() == 100
    assert numbered.select("salt").distinct().count() == 100
    first = sorted(r["salt"] for r in add_key_hash(df, fallback="content").collect())
    again = sorted(r["salt"] for r in add_key_hash(df.repartition(7), fallback="content").collect())
    assert first == again and len(set(first)) == 3
    with pytest.raises(ValueError):
        add_key_hash(df, fallback="none")


def test_constants_replace_and_stamp_is_one_value(spark):
    df = spark.range(50).repartition(4)
    out = stamp(add_constants(df, {"id": 7, "source": "s"}), "at")
    assert out.select("id", "source", "at").distinct().count() == 1
    assert out.columns == ["id", "source", "at"]
    assert add_constants(df, None) is df
    assert drop_columns(out, "at", "absent").columns == ["id", "source"]
