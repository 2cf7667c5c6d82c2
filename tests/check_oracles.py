"""Run every registered query next to its SQL twin and compare columns and rows.

    python tests/check_oracles.py [folder] [name ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry_point  # noqa: E402


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("check")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _cell(value):
    if isinstance(value, Decimal):
        return float(value)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(str(_cell(row[i])) for i in order) for row in rows)


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = set(sys.argv[2:])
    spark = session()
    db = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    oracles, failed = entry_point.oracle_sql(), []
    for name, query in entry_point.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.monotonic()
        try:
            result = query(spark, folder)
            columns, got = result.columns, [tuple(r) for r in result.collect()]
        except Exception as exc:  # report and go on to the next query
            failed.append(name)
            print(f"FAIL {name}: {type(exc).__name__}: {str(exc)[:600]}", flush=True)
            continue
        took = time.monotonic() - began
        if name not in oracles:
            print(f"rows {name}: {len(got)} rows, {took:.1f}s", flush=True)
            continue
        expected = db.execute(oracles[name])
        names = [d[0] for d in expected.description]
        want = rows_of(names, expected.fetchall())
        have = rows_of(columns, got)
        same = sorted(columns) == sorted(names) and have == want
        print(f"{'ok  ' if same else 'DIFF'} {name}: {len(got)} rows, {took:.1f}s", flush=True)
        if not same:
            failed.append(name)
            print("   columns", sorted(columns), sorted(names))
            print("   only spark", list((have - want).items())[:3], len(have - want))
            print("   only sql  ", list((want - have).items())[:3], len(want - have))
    print("failed:", failed or "none")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
