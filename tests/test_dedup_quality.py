import pytest
from pyspark.sql import functions as F

from millrace.operators import first_per_key, is_empty, page, quality_report, sample_rows
from tests.conftest import plan_of, rows

ROWS = [(1, 5, "a"), (1, 3, "b"), (2, 9, "c"), (None, 4, "d"), (None, 2, "e"), (1, 3, "a")]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, "k bigint, seq int, v string")


def test_first_row_per_key(df):
    assert set(rows(first_per_key(df, "k", ["seq", "v"]))) == {
        (1, 3, "a"), (2, 9, "c"), (None, 2, "e"),
    }


def test_default_order_depends_on_content_only(spark, df):
    once = set(rows(first_per_key(df, "k")))
    for _ in range(3):
        shuffled = df.orderBy(F.rand()).repartition(5)
        assert set(rows(first_per_key(shuffled, "k"))) == once


def test_null_keys_can_be_kept(df):
    kept = rows(first_per_key(df, "k", ["seq", "v"], null_keys="keep"))
    assert sorted(kept, key=str) == sorted(
        [(1, 3, "a"), (2, 9, "c"), (None, 4, "d"), (None, 2, "e")], key=str
    )
    with pytest.raises(ValueError):
        first_per_key(df, "k", null_keys="drop")


def test_dedup_is_idempotent_and_global(df):
    once = first_per_key(df, "k", ["seq", "v"])
    assert set(rows(first_per_key(once, "k", ["seq", "v"]))) == set(rows(once))
    spread = df.repartition(6)
    assert set(rows(first_per_key(spread, "k", ["seq", "v"]))) == set(rows(once))


def test_unorderable_columns_do_not_break_the_default_order(spark):
    df = spark.sql("select 1 as k, map('a', 1) as m, 2 as v union all select 1, map('a', 2), 1")
    assert [r["v"] for r in first_per_key(df, "k").collect()] == [1]


def test_hot_key_is_cut_before_the_shuffle(spark):
    hot = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), "id"
    )
    plan = plan_of(first_per_key(hot, "k", ["id"]))
    below_exchange = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange
    assert first_per_key(hot, "k", ["id"]).where("k = 7").collect()[0]["id"] == 0


def test_quality_report_counts_in_one_pass(df):
    report = quality_report(df, ["k", "v"], "k").first()
    assert report.asDict() == {"rows": 6, "null_k": 2, "null_v": 0, "duplicate_rows": 3}
    removed = df.count() - first_per_key(df, "k").count()
    assert removed == report["duplicate_rows"]
    assert quality_report(df, ["k"], ["k", "seq"]).first()["duplicate_rows"] == 1


def test_quality_report_of_no_rows(df):
    assert quality_report(df.where("false"), ["k"], "k").first().asDict() == {
        "rows": 0, "null_k": 0, "duplicate_rows": 0,
    }
    assert is_empty(df.where("false")) and not is_empty(df)


def test_pages_split_ties_by_content_at_any_depth(spark):
    df = spark.range(60).selectExpr("id % 2 as k", "id div 3 as v").repartition(5)
    whole = [tuple(r) for r in page(df, ["k"], 0, 60).collect()]
    assert len(whole) == 60 and [k for k, _ in whole] == [0] * 30 + [1] * 30
    for offset, limit in ((3, 5), (28, 7), (55, 50)):
        cut = [tuple(r) for r in page(df.coalesce(1), ["k"], offset, limit).collect()]
        assert cut == whole[offset : offset + limit]


def test_a_page_stages_hashes_only(spark, monkeypatch):
    from millrace.operators import chunks

    staged = []
    real = chunks.stage
    monkeypatch.setattr(chunks, "stage", lambda df, label: staged.append(df.columns) or real(df, label))
    df = spark.range(20).selectExpr("id as k", "repeat('x', 100) as wide")
    assert page(df, ["k"], 2, 3).count() == 3
    assert staged and not any({"wide", "k"} & set(columns) for columns in staged)


def test_pages_cover_everything_without_overlap(spark):
    df = spark.range(1000).withColumn("key", F.xxhash64("id")).repartition(7)
    want = [r["key"] for r in df.orderBy("key").collect()]
    got = []
    for offset in range(0, 1000, 300):
        got += [r["key"] for r in page(df, ["key"], offset, 300).collect()]
    assert got == want
    assert [r["key"] for r in sample_rows(df, ["key"], 5).collect()] == want[:5]
