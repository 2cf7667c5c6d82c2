"""Inputs derived from the tables: written by many tasks, the same documents whatever the partitions."""

import json
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.registry.inputs import supplier_documents, written_documents
from millrace.sources import document_entries
from tests.conftest import plan_of


def test_every_partition_writes_a_document_of_its_own(spark):
    parts = spark.range(40, numPartitions=4).where("id >= 10").select(F.format_string('"k%d":"a,{%d"', "id", "id").alias("value"))
    path = written_documents(parts, "{", "}", "parts")  # the first partition is empty
    files = [f for f in Path(path).glob("part-*") if f.stat().st_size]
    assert len(files) == 3
    whole = [json.loads(f.read_text()) for f in files]
    assert sorted(k for d in whole for k in d) == sorted(f"k{i}" for i in range(10, 40))
    entries = document_entries(spark, path)
    assert entries.where("problem IS NULL").count() == 30 and entries.where("problem IS NOT NULL").count() == 0
    assert document_entries(spark, written_documents(parts.limit(0), "[", "]", "none")).count() == 0


@pytest.fixture
def shop_tables(spark, tmp_path):
    def make(parts, suppliers=((1, 'S "1"', 7), (2, None, 7))):
        spark.createDataFrame([(7, "ITALY")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
        spark.createDataFrame(suppliers, "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
        ddl = "p_partkey long, p_brand string, p_size int, p_type string"
        spark.createDataFrame(parts, ddl).write.parquet(f"{tmp_path}/part.parquet")
        pairs = [(1, 10), (1, 10), (1, 11), (1, 12), (1, 5001), (2, 10), (None, 10), (2, None), (3, 10), (1, 99)]
        spark.createDataFrame(pairs, "l_suppkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
        return str(tmp_path)

    return make


def test_documents_of_suppliers_and_ranges_of_parts(spark, shop_tables):
    folder = shop_tables([(10, "B\\1", 1, 'x"y'), (11, "A", None, "t"), (12, "B\\1", 3, None), (5001, "A", 4, "u")])
    found = [json.loads(r.value) for r in supplier_documents(spark, folder).collect()]

    def document(key, menu, **more):
        return {"ITALY": {"link": "/italy", "restaurants": {key: {**more, "cost": "7", "menu": menu}}}}

    one = {"price": "1", "veg_or_non_veg": 'x"y'}
    named = {"name": 'S "1"', "address": 'S "1", ITALY'}
    wanted = [
        document("1", {"B\\1": {"10": one, "12": {"price": "3"}}, "A": {"11": {"veg_or_non_veg": "t"}}}, **named),
        document("1", {"A": {"5001": {"price": "4", "veg_or_non_veg": "u"}}}, **named),
        document("2", {"B\\1": {"10": one}}, address="ITALY"),
    ]
    assert sorted(map(repr, map(_sorted, found))) == sorted(map(repr, map(_sorted, wanted)))


def _sorted(value):
    return sorted((k, _sorted(v)) for k, v in value.items()) if isinstance(value, dict) else value


@pytest.mark.parametrize("parts", [[(10, "A", 1, "t"), (10, "A", 2, "t")], [(10, None, 1, "t")]])
def test_null_and_repeated_keys_are_errors(spark, shop_tables, parts):
    with pytest.raises(PySparkException, match="null or repeated key"):
        supplier_documents(spark, shop_tables(parts)).collect()


def test_repeated_suppliers_are_errors(spark, shop_tables):
    folder = shop_tables([(10, "A", 1, "t")], [(1, "S", 7), (1, "T", 7)])
    with pytest.raises(PySparkException, match="null or repeated key"):
        supplier_documents(spark, folder).collect()


def test_pairs_are_never_broadcast(spark, data_dir):
    """File sizes say little of a column pair: the pairs were broadcast, and all documents made from one scan of parts."""
    plan = plan_of(supplier_documents(spark, data_dir))
    for line, below in zip(plan.splitlines(), plan.splitlines()[1:]):
        assert not ("BroadcastExchange" in line and "HashAggregate" in below)
    assert "ShuffledHashJoin" in plan


def test_replay_has_a_bounded_number_of_micro_batches(spark, tmp_path, monkeypatch):
    from millrace.registry import stream

    events = spark.range(230).select(F.col("id").alias("event_id"), F.col("id").alias("user_id"), F.lit("view").alias("event_type"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(stream, "REPLAY_ROWS", 10)
    monkeypatch.setattr(stream, "REPLAY_BATCHES", 4)
    monkeypatch.setattr(stream, "scratch_path", lambda *_: f"{tmp_path}/replay")
    assert stream.stream_replay(spark, str(tmp_path)).distinct().count() == 230
    assert len(list((tmp_path / "replay/landing").glob("batch_id=*"))) == 23  # chunks stay as they are
    assert len([f for f in (tmp_path / "replay/state/commits").iterdir() if f.name.isdigit()]) == 4
