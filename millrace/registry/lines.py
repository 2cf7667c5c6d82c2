"""JSON lines, JSON arrays, profiles, shards and the cleaning job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.defaults import HASH_SALT, PROCESSED_AT
from millrace.functions import is_json, line_kind
from millrace.operators import json_profile, parse_lines, records_with_problems, rejected_lines
from millrace.operators.records import drop_corrupt
from millrace.plans import clean_lines, run_clean, split_to_shards
from millrace.plans.split import split_lines
from millrace.registry.inputs import (
    DOCUMENT_ROWS,
    EVENT_LINES_SQL,
    KEEP_NULLS,
    RECORD_DDL,
    conversation_arrays,
    event_lines,
    record_lines,
    table,
    written_documents,
    written_lines,
)
from millrace.schema import build_schema, missing_columns, require_columns
from millrace.scratch import scratch_path, stage
from millrace.sinks import write_jsonl
from millrace.sources import array_elements, document_entries, infer_json_schema, read_json, read_lines

EVENT_DDL = "id bigint, user bigint, name string, k bigint"
CONSTANTS = {"origin": "demo feed", "stage": "trial"}


def jsonl_validity(spark: SparkSession, folder: str) -> DataFrame:
    judged = event_lines(spark, folder).select(is_json(F.col("value")).alias("valid"))
    return judged.groupBy("valid").agg(F.count(F.lit(1)).alias("n"))


def jsonl_parse(spark: SparkSession, folder: str) -> DataFrame:
    return parse_lines(event_lines(spark, folder), EVENT_DDL)


def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    return rejected_lines(event_lines(spark, folder), keep=["event_id"])


def line_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of free text and of events, by kind of line and by outcome."""
    events = event_lines(spark, folder).select("value")
    texts = table(spark, folder, "documents").select(F.col("text").alias("value"))
    judged = records_with_problems(events.unionByName(texts), EVENT_DDL)
    return judged.groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


def type_mismatch(spark: SparkSession, folder: str) -> DataFrame:
    """Text read into a bigint: the line is kept aside instead of losing the value."""
    wrong = "id bigint, user bigint, name bigint, k bigint"
    both = records_with_problems(
        event_lines(spark, folder), wrong, keep=["event_id"], reject_mismatch=True
    )
    return both.select("event_id", "problem")


def coerced_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Values that do not convert, read as null and counted by field."""
    wrong = "id bigint, user bigint, name bigint, k bigint"
    read = records_with_problems(event_lines(spark, folder), wrong, coerced_column="lost")
    fields = read.where("problem is null").select(F.explode("lost").alias("field"))
    return fields.groupBy("field").agg(F.count(F.lit(1)).alias("n"))


def json_sniff(spark: SparkSession, folder: str) -> DataFrame:
    arrays = conversation_arrays(spark, folder)
    objects = event_lines(spark, folder).select("value")
    texts = table(spark, folder, "benchmark").select(F.col("text").alias("value"))
    mixed = arrays.unionByName(objects).unionByName(texts)
    kinds = mixed.select(line_kind(F.col("value")).alias("kind"))
    # The number of arrays follows the scan, so it is reported as present or not.
    counted = kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("kind", F.when(F.col("kind") != "array", F.col("n")).alias("n"))


def file_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Profile of files written per event type, added up by type."""
    path = scratch_path(spark, "profile")
    lines = event_lines(spark, folder)
    lines.select("event_type", "value").write.partitionBy("event_type").text(path)
    profile = json_profile(spark, path)
    return (
        profile.withColumn("event_type", F.regexp_extract("file", "event_type=([a-z]+)", 1))
        .groupBy("event_type")
        .agg(
            F.sum("lines").alias("lines"),
            F.sum("valid_lines").alias("valid_lines"),
            F.sum("blank_lines").alias("blank_lines"),
            F.bool_and("is_line_delimited").alias("is_line_delimited"),
            F.bool_or("is_array").alias("is_array"),
            F.bool_and("is_valid").alias("is_valid"),
            F.bool_and(F.col("sample").isNotNull()).alias("has_sample"),
        )
    )


def json_array_rows(spark: SparkSession, folder: str) -> DataFrame:
    return parse_lines(
        conversation_arrays(spark, folder), "conv_id bigint, turn bigint, role string"
    )


def array_document_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """The conversations as few large arrays, read by ranges of bytes."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    parts = turns.select(F.to_json(F.struct("*"), KEEP_NULLS).alias("value"))
    entries = document_entries(spark, written_documents(parts, "[", "]", "array-document"))
    return parse_lines(entries.where(F.col("problem").isNull()), turns.schema)


def json_array_elements(spark: SparkSession, folder: str) -> DataFrame:
    """The same arrays opened without a schema, each element as JSON text."""
    elements = array_elements(conversation_arrays(spark, folder))
    part = {
        name: F.get_json_object("value", f"$.{name}") for name in ("conv_id", "turn", "role")
    }
    return elements.where(F.col("problem").isNull()).select(
        part["conv_id"].cast("bigint").alias("conv_id"),
        part["turn"].cast("bigint").alias("turn"),
        part["role"].alias("role"),
    )


def corrupt_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Spark's permissive JSON reader and its corrupt column, staged once."""
    path = written_lines(event_lines(spark, folder).select("value"), "corrupt")
    declared = "id bigint, user bigint, name string, k string"
    return drop_corrupt(stage(read_json(spark, path, declared), "read"))


def schema_inferred(spark: SparkSession, folder: str) -> DataFrame:
    """One inference over all files, then one read with what it found."""
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    path = scratch_path(spark, "infer")
    write_jsonl(events, path)
    found = infer_json_schema(spark, path)
    return read_json(spark, path, found).drop("_corrupt_record")


def schema_build(spark: SparkSession, folder: str) -> DataFrame:
    declared = build_schema(
        [
            {"name": "id", "type": "integer", "nullable": True},
            {"name": "user", "type": "string", "nullable": True},
            {"name": "name", "type": "string", "nullable": True},
            {"name": "k", "type": "double", "nullable": True},
        ]
    )
    return parse_lines(event_lines(spark, folder), declared)


def jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """JSON lines with nulls written out, read back under the same schema."""
    events = table(spark, folder, "events").select(
        "event_id", "user_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_type")
    )
    path = scratch_path(spark, "jsonl")
    write_jsonl(events, path)
    lines = read_lines(spark, path)
    kept = F.get_json_object("value", "$.event_type").isNotNull() | F.col("value").contains(
        '"event_type":null'
    )
    parsed = parse_lines(
        lines.withColumn("kept", kept),
        "event_id bigint, user_id bigint, event_type string",
        keep=["kept"],
    )
    return parsed.withColumnRenamed("kept", "field_written")


SHARD_BYTES = 100_000


def split_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Byte-bounded shard files of the valid lines, in event order, read back."""
    ordered = (
        event_lines(spark, folder)
        .repartitionByRange("event_id")
        .sortWithinPartitions("event_id")
        .select("value")
    )
    source = written_lines(ordered, "unsplit")
    shards = scratch_path(spark, "shards")
    split_lines(read_lines(spark, source), shards, SHARD_BYTES)
    back = spark.read.text(shards)
    return back.groupBy(F.col("shard_id").cast("bigint").alias("shard_id")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.octet_length("value")).alias("bytes"),
        F.count_distinct(F.col("_metadata.file_path")).alias("files"),
    )


def split_array(spark: SparkSession, folder: str) -> DataFrame:
    """Array documents to shards of one element per line; the size rule picks the target."""
    source = scratch_path(spark, "arrays")
    conversation_arrays(spark, folder, rows=DOCUMENT_ROWS).write.text(source)
    # One array per file, so that every file is one document.
    documents = scratch_path(spark, "documents")
    spark.read.text(source).write.option("maxRecordsPerFile", 1).text(documents)
    shards = scratch_path(spark, "shards")
    split_to_shards(spark, documents, shards, layout="array")
    return parse_lines(spark.read.text(shards), "conv_id bigint, turn bigint, role string")


def _without_time(clean: DataFrame) -> DataFrame:
    return clean.withColumn("stamped", F.col(PROCESSED_AT).isNotNull()).drop(PROCESSED_AT)


def clean_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Validity, required columns, dedup, constants, audit time and key hash in one plan."""
    clean = clean_lines(
        record_lines(spark, folder), RECORD_DDL, order_by=["seq"], constants=CONSTANTS
    )
    return _without_time(clean)


def _run_clean(spark: SparkSession, folder: str, runs: int):
    source = written_lines(record_lines(spark, folder), "records")
    output, rejects = scratch_path(spark, "clean"), scratch_path(spark, "rejects")
    for _ in range(runs):
        report = run_clean(
            spark,
            source,
            output,
            rejects,
            RECORD_DDL,
            run_id="first",
            order_by=["seq"],
            constants=CONSTANTS,
        )
    return output, rejects, report


def clean_job(spark: SparkSession, folder: str) -> DataFrame:
    """The job from text files to a table, run twice under one run id."""
    output, _, _ = _run_clean(spark, folder, runs=2)
    return _without_time(spark.read.parquet(output).drop("run_id", "write"))


def clean_job_report(spark: SparkSession, folder: str) -> DataFrame:
    """What the job counted while it wrote, next to what the two tables hold."""
    output, rejects, report = _run_clean(spark, folder, runs=1)
    stored = spark.read.parquet(output).select(F.lit("row").alias("held"))
    aside = spark.read.parquet(rejects).select(F.lit("reject").alias("held"))
    return stored.unionByName(aside).agg(
        F.count_if(F.col("held") == "row").alias("stored_rows"),
        F.count_if(F.col("held") == "reject").alias("stored_rejects"),
        F.lit(report.records).alias("records"),
        F.lit(report.rejected_lines).alias("rejected"),
        F.lit(report.rows_written).alias("rows_written"),
        F.lit(report.duplicates_removed).alias("duplicates_removed"),
        F.lit(report.nulls["city"]).alias("null_city"),
    )


def required_columns(spark: SparkSession, folder: str) -> DataFrame:
    """The column check on each table, with the rows of the tables that pass it."""
    needed = ("event_id", "user_id")
    found = []
    for name in ("events", "orders"):
        df = table(spark, folder, name)
        absent = ", ".join(missing_columns(df.columns, needed))
        rows = df if absent else require_columns(df, needed)
        found.append(
            rows.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table_name"), F.lit(absent).alias("missing"), "rows"
            )
        )
    return found[0].unionByName(found[1])


QUERIES = {
    "array_document_ranges": array_document_ranges,
    "jsonl_validity": jsonl_validity,
    "jsonl_parse": jsonl_parse,
    "quarantine": quarantine,
    "line_accounts": line_accounts,
    "type_mismatch": type_mismatch,
    "coerced_counts": coerced_counts,
    "json_sniff": json_sniff,
    "file_profile": file_profile,
    "json_array_rows": json_array_rows,
    "json_array_elements": json_array_elements,
    "corrupt_filter": corrupt_filter,
    "schema_inferred": schema_inferred,
    "schema_build": schema_build,
    "jsonl_roundtrip": jsonl_roundtrip,
    "split_shards": split_shards,
    "split_array": split_array,
    "clean_batch": clean_batch,
    "clean_job": clean_job,
    "clean_job_report": clean_job_report,
    "required_columns": required_columns,
}

_CLEAN_SQL = f"""
    SELECT user_id AS id, event_type AS name, json_extract_string(props, '$.k') AS city,
           event_id AS seq, '{CONSTANTS["origin"]}' AS origin, '{CONSTANTS["stage"]}' AS stage,
           sha256(CAST(user_id AS VARCHAR) || '{HASH_SALT}') AS salt, true AS stamped
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r
          FROM events WHERE event_type <> 'error')
    WHERE r = 1
"""

ORACLES = {
    "array_document_ranges": "SELECT conv_id, turn, role, text FROM conversations",
    "jsonl_validity": f"""
        SELECT json_valid(value) AS valid, count(*) AS n FROM ({EVENT_LINES_SQL}) GROUP BY 1""",
    "jsonl_parse": f"""
        SELECT CAST(json_extract_string(value, '$.id') AS BIGINT) AS id,
               CAST(json_extract_string(value, '$.user') AS BIGINT) AS "user",
               json_extract_string(value, '$.name') AS name,
               CAST(json_extract_string(value, '$.k') AS BIGINT) AS k
        FROM ({EVENT_LINES_SQL}) WHERE json_valid(value)""",
    "quarantine": f"""
        SELECT event_id, 'invalid_json' AS problem, value AS line
        FROM ({EVENT_LINES_SQL}) WHERE NOT json_valid(value)""",
    "line_accounts": f"""
        SELECT CASE WHEN json_valid(value) THEN NULL ELSE 'invalid_json' END AS problem,
               count(*) AS n
        FROM (SELECT value FROM ({EVENT_LINES_SQL}) UNION ALL SELECT text FROM documents)
        WHERE trim(value) <> '' GROUP BY 1""",
    "type_mismatch": """
        SELECT event_id,
               CASE WHEN event_type = 'error' THEN 'invalid_json' ELSE 'type_mismatch' END
                   AS problem
        FROM events""",
    "coerced_counts": """
        SELECT 'name' AS field, count(*) AS n FROM events WHERE event_type <> 'error'""",
    "json_sniff": f"""
        SELECT kind, CASE WHEN kind <> 'array' THEN count(*) END AS n
        FROM (SELECT CASE WHEN value LIKE '{{%' THEN 'object' WHEN value LIKE '[%' THEN 'array'
                          WHEN trim(value) = '' THEN 'blank' ELSE 'other' END AS kind
              FROM (SELECT value FROM ({EVENT_LINES_SQL})
                    UNION ALL SELECT text FROM benchmark
                    UNION ALL (SELECT '[' || min(conv_id) FROM conversations)))
        GROUP BY kind""",
    "file_profile": f"""
        SELECT event_type, count(*) AS lines,
               count(*) FILTER (WHERE json_valid(value)) AS valid_lines,
               CAST(0 AS BIGINT) AS blank_lines, true AS is_line_delimited, false AS is_array,
               count(*) FILTER (WHERE json_valid(value)) > 0 AS is_valid,
               count(*) FILTER (WHERE json_valid(value)) > 0 AS has_sample
        FROM ({EVENT_LINES_SQL}) GROUP BY event_type""",
    "json_array_rows": "SELECT conv_id, turn, role FROM conversations",
    "json_array_elements": "SELECT conv_id, turn, role FROM conversations",
    "corrupt_filter": f"""
        SELECT CAST(json_extract_string(value, '$.id') AS BIGINT) AS id,
               CAST(json_extract_string(value, '$.user') AS BIGINT) AS "user",
               json_extract_string(value, '$.name') AS name,
               json_extract_string(value, '$.k') AS k
        FROM ({EVENT_LINES_SQL}) WHERE json_valid(value)""",
    "schema_inferred": "SELECT event_id, event_type, user_id, value FROM events",
    "schema_build": """
        SELECT CAST(event_id AS INTEGER) AS id, CAST(user_id AS VARCHAR) AS "user",
               event_type AS name, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
        FROM events WHERE event_type <> 'error'""",
    "jsonl_roundtrip": """
        SELECT event_id, user_id, nullif(event_type, 'error') AS event_type, true AS field_written
        FROM events""",
    "split_shards": f"""
        SELECT shard_id, count(*) AS lines, CAST(sum(size) AS BIGINT) AS bytes,
               CAST(1 AS BIGINT) AS files
        FROM (SELECT size, CAST(coalesce(sum(size) OVER (ORDER BY event_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {SHARD_BYTES}
                  AS BIGINT) AS shard_id
              FROM (SELECT event_id, strlen(value) AS size FROM ({EVENT_LINES_SQL})
                    WHERE json_valid(value)))
        GROUP BY shard_id""",
    "split_array": "SELECT conv_id, turn, role FROM conversations",
    "clean_batch": _CLEAN_SQL,
    "clean_job": _CLEAN_SQL,
    "clean_job_report": """
        SELECT count(*) FILTER (WHERE event_type <> 'error') AS records,
               count(*) FILTER (WHERE event_type = 'error') AS rejected,
               count(DISTINCT user_id) FILTER (WHERE event_type <> 'error') AS rows_written,
               count(*) FILTER (WHERE event_type <> 'error')
                   - count(DISTINCT user_id) FILTER (WHERE event_type <> 'error')
                   AS duplicates_removed,
               CAST(0 AS BIGINT) AS null_city,
               count(DISTINCT user_id) FILTER (WHERE event_type <> 'error') AS stored_rows,
               count(*) FILTER (WHERE event_type = 'error') AS stored_rejects
        FROM events""",
    "required_columns": """
        SELECT 'events' AS table_name, '' AS missing, count(*) AS rows FROM events
        UNION ALL SELECT 'orders', 'event_id, user_id', count(*) FROM orders""",
}
