"""Columns, keys, dedup, counts, pages and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.defaults import HASH_SALT, INGESTED_AT, PROCESSED_AT, READ_AT
from millrace.functions import add_constants, add_key_hash, drop_columns, salted_hash, stamp
from millrace.operators import (
    chunk_by_bytes,
    chunk_by_rows,
    count_rows,
    first_per_key,
    is_empty,
    number_rows,
    page,
    quality_report,
    sample_rows,
)
from millrace.operators.quality import watch
from millrace.registry.inputs import table
from millrace.scratch import scratch_path


def key_hash(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey", salted_hash("o_orderkey").alias("key_hash")
    )


def key_fallback(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_type", "event_id", "user_id")
    return add_key_hash(events)


def key_candidates(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_type", "event_id", "user_id")
    return add_key_hash(events, candidates=["account_id", "user_id"])


def key_row_id(spark: SparkSession, folder: str) -> DataFrame:
    hashed = add_key_hash(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"))
    return hashed.agg(
        F.count("row_id").alias("numbered"),
        F.count_distinct("row_id").alias("distinct_numbers"),
        F.count_if(F.col("salt").rlike("^[0-9a-f]{64}$")).alias("hashed"),
    )


def key_content(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return add_key_hash(nation, candidates=[], fallback="content")


def const_columns(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "event_type")
    return add_constants(events, {"origin": "demo feed", "stage": "trial"})


def audit_columns(spark: SparkSession, folder: str) -> DataFrame:
    """One audit value per query: every row carries the same three times."""
    rows = table(spark, folder, "orders").select("o_orderstatus")
    for name in (PROCESSED_AT, INGESTED_AT, READ_AT):
        rows = stamp(rows, name)
    return rows.groupBy("o_orderstatus").agg(
        F.count(PROCESSED_AT).alias("stamped"),
        F.count_distinct(PROCESSED_AT, INGESTED_AT, READ_AT).alias("moments"),
    )


def drop_column(spark: SparkSession, folder: str) -> DataFrame:
    return drop_columns(table(spark, folder, "nation"), "n_regionkey")


def dedup_first(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    return first_per_key(events, "user_id", ["event_id"])


def dedup_by_content(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey")
    return first_per_key(lines, "l_suppkey")


def _events_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    known = F.when(F.col("event_type") != "error", F.col("user_id"))
    return events.select("event_id", "event_type", known.alias("user_key"))


def dedup_odd_names(spark: SparkSession, folder: str) -> DataFrame:
    """Columns named like an operator's own go through dedup and numbering unchanged."""
    events = table(spark, folder, "events").select(
        F.col("user_id").alias("_id"),
        F.col("event_id").alias("_row"),
        F.col("event_type").alias("_rank"),
        F.col("value").alias("_apart"),
        F.col("props").alias("_position"),
    )
    kept = first_per_key(events, ["_id", "_rank"], ["_row"], null_keys="keep")
    return number_rows(kept, ["_id", "_row"], "number")


def dedup_null_keys_collapse(spark: SparkSession, folder: str) -> DataFrame:
    return first_per_key(_events_with_gaps(spark, folder), "user_key", ["event_id"])


def dedup_null_keys_keep(spark: SparkSession, folder: str) -> DataFrame:
    return first_per_key(
        _events_with_gaps(spark, folder), "user_key", ["event_id"], null_keys="keep"
    )


def per_chunk_dedup(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id")
    chunks = chunk_by_rows(events, ["event_id"])
    return first_per_key(chunks, "user_id", ["event_id"], within=["batch_id"])


def null_report(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        "event_id",
        "user_id",
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
    )
    return quality_report(events, ["event_id", "user_id", "event_type"], "user_id")


def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return count_rows(table(spark, folder, "lineitem"))


def empty_check(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    found = {
        "events_empty": is_empty(events),
        "unknown_type_empty": is_empty(events.where(F.col("event_type") == "no such type")),
    }
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in found.items()])


def run_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Counts taken while a table is written, without a job of their own."""
    rows, seen = watch(
        table(spark, folder, "lineitem").select("l_orderkey", "l_returnflag"),
        "lineitem",
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.max("l_orderkey").alias("max_key"),
    )
    rows.write.parquet(scratch_path(spark, "totals"))
    totals = seen.get
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in totals.items()])


def page_shallow(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    return page(events, ["event_id"], offset=4000, limit=2000)


def page_deep(spark: SparkSession, folder: str) -> DataFrame:
    """The page a top-k would be too large for, cut by dense row number."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    order = ["l_orderkey", "l_linenumber", "l_quantity"]
    return page(lines, order, offset=4000, limit=2000)


def sample(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return sample_rows(orders, ["o_orderkey"])


def row_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return number_rows(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"])


def batch_ids(spark: SparkSession, folder: str) -> DataFrame:
    chunks = chunk_by_rows(table(spark, folder, "events").select("event_id"), ["event_id"])
    return chunks.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"),
    )


def byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    shards = chunk_by_bytes(documents, "text", 200_000, ["doc_id"])
    return shards.select("doc_id", "shard_id")


QUERIES = {
    "key_hash": key_hash,
    "key_fallback": key_fallback,
    "key_candidates": key_candidates,
    "key_row_id": key_row_id,
    "key_content": key_content,
    "const_columns": const_columns,
    "audit_columns": audit_columns,
    "drop_column": drop_column,
    "dedup_first": dedup_first,
    "dedup_by_content": dedup_by_content,
    "dedup_odd_names": dedup_odd_names,
    "dedup_null_keys_collapse": dedup_null_keys_collapse,
    "dedup_null_keys_keep": dedup_null_keys_keep,
    "per_chunk_dedup": per_chunk_dedup,
    "null_report": null_report,
    "row_count": row_count,
    "empty_check": empty_check,
    "run_totals": run_totals,
    "page": page_shallow,
    "page_deep": page_deep,
    "sample_rows": sample,
    "row_numbers": row_numbers,
    "batch_ids": batch_ids,
    "byte_shards": byte_shards,
}

_GAPS = """SELECT event_id, event_type,
                  CASE WHEN event_type <> 'error' THEN user_id END AS user_key FROM events"""

ORACLES = {
    "key_hash": f"""
        SELECT o_orderkey, sha256(CAST(o_orderkey AS VARCHAR) || '{HASH_SALT}') AS key_hash
        FROM orders""",
    "key_fallback": f"""
        SELECT event_type, event_id, user_id,
               sha256(CAST(event_id AS VARCHAR) || '{HASH_SALT}') AS salt
        FROM events""",
    "key_candidates": f"""
        SELECT event_type, event_id, user_id,
               sha256(CAST(user_id AS VARCHAR) || '{HASH_SALT}') AS salt
        FROM events""",
    "key_row_id": """
        SELECT count(*) AS numbered, count(*) AS distinct_numbers, count(*) AS hashed
        FROM orders""",
    "key_content": f"""
        SELECT n_nationkey, n_name, n_regionkey,
               sha256('{{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name
                      || '","n_regionkey":' || n_regionkey || '}}' || '{HASH_SALT}') AS salt
        FROM nation""",
    "const_columns": """
        SELECT event_id, event_type, 'demo feed' AS origin, 'trial' AS stage
        FROM events""",
    "audit_columns": """
        SELECT o_orderstatus, count(*) AS stamped, CAST(1 AS BIGINT) AS moments
        FROM orders GROUP BY o_orderstatus""",
    "drop_column": "SELECT n_nationkey, n_name FROM nation",
    "dedup_first": """
        SELECT event_id, user_id, event_type FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events)
        WHERE r = 1""",
    "dedup_odd_names": """
        SELECT user_id AS _id, event_id AS _row, event_type AS _rank, value AS _apart, props AS _position,
               row_number() OVER (ORDER BY user_id NULLS FIRST, event_id) - 1 AS number
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS r FROM events)
        WHERE r = 1 OR user_id IS NULL OR event_type IS NULL""",
    "dedup_by_content": """
        SELECT l_suppkey, l_partkey, l_orderkey FROM (
            SELECT *, row_number() OVER (PARTITION BY l_suppkey
                                         ORDER BY l_partkey, l_orderkey) AS r FROM lineitem)
        WHERE r = 1""",
    "dedup_null_keys_collapse": f"""
        SELECT event_id, event_type, user_key FROM (
            SELECT *, row_number() OVER (PARTITION BY user_key ORDER BY event_id) AS r
            FROM ({_GAPS}))
        WHERE r = 1""",
    "dedup_null_keys_keep": f"""
        SELECT event_id, event_type, user_key FROM (
            SELECT *, row_number() OVER (PARTITION BY user_key ORDER BY event_id) AS r
            FROM ({_GAPS}))
        WHERE r = 1 OR user_key IS NULL""",
    "per_chunk_dedup": """
        SELECT event_id, user_id, batch_id FROM (
            SELECT *, row_number() OVER (PARTITION BY batch_id, user_id ORDER BY event_id) AS r
            FROM (SELECT event_id, user_id,
                         (row_number() OVER (ORDER BY event_id) - 1) // 2000 + 1 AS batch_id
                  FROM events))
        WHERE r = 1""",
    "null_report": """
        SELECT count(*) AS rows,
               count(*) FILTER (WHERE event_id IS NULL) AS null_event_id,
               count(*) FILTER (WHERE user_id IS NULL) AS null_user_id,
               count(*) FILTER (WHERE nullif(event_type, 'error') IS NULL) AS null_event_type,
               count(*) - count(DISTINCT user_id) - count(DISTINCT user_id IS NULL OR NULL)
                   AS duplicate_rows
        FROM events""",
    "row_count": "SELECT count(*) AS rows FROM lineitem",
    "empty_check": """
        SELECT count(*) = 0 AS events_empty,
               count(*) FILTER (WHERE event_type = 'no such type') = 0 AS unknown_type_empty
        FROM events""",
    "run_totals": """
        SELECT count(*) AS rows, count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
               max(l_orderkey) AS max_key
        FROM lineitem""",
    "page": """
        SELECT event_id, user_id, event_type FROM events
        ORDER BY event_id LIMIT 2000 OFFSET 4000""",
    "page_deep": """
        SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
        ORDER BY l_orderkey, l_linenumber, l_quantity LIMIT 2000 OFFSET 4000""",
    "sample_rows": "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5",
    "row_numbers": """
        SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders""",
    "batch_ids": """
        SELECT batch_id, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id
        FROM (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 2000 + 1 AS batch_id
              FROM events)
        GROUP BY batch_id""",
    "byte_shards": """
        SELECT doc_id,
               CAST(coalesce(sum(strlen(text)) OVER (
                   ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                   // 200000 AS BIGINT) AS shard_id
        FROM documents""",
}
