"""Every registered query against its SQL twin."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from tests.check_oracles import rows_of


@pytest.fixture(scope="module")
def db(data_dir):
    connection = duckdb.connect()
    for file in Path(data_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_query(name, spark, data_dir, db):
    result = entry_point.queries()[name](spark, data_dir)
    columns, got = result.columns, [tuple(r) for r in result.collect()]
    sql = entry_point.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    expected = db.execute(sql)
    names = [d[0] for d in expected.description]
    assert sorted(columns) == sorted(names)
    assert rows_of(columns, got) == rows_of(names, expected.fetchall())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
