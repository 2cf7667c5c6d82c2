"""Streams over files that Spark derives from the tables, run until they have caught up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.defaults import HASH_SALT, PROCESSED_AT, READ_AT
from millrace.plans import land_in_chunks
from millrace.registry.tables import EVENT_KINDS
from millrace.registry.inputs import RECORD_DDL, record_lines, table, written_lines
from millrace.scratch import scratch_path
from millrace.sinks import append_parquet, parquet_target, read_best, read_new
from millrace.storage import names_in
from millrace.streaming import (
    ProgressLog,
    read_rejects,
    start_first_per_key,
    start_parquet_sink,
    start_published_clean,
    start_stamped_copy,
    stream_parquet,
    wait,
    whole_report,
)
from millrace.streaming.clean import start_table_stream

EVENT_SCHEMA = "event_id bigint, user_id bigint, event_type string"

# Rows of a replayed chunk, at every size of the table.
REPLAY_ROWS = 10_000
# Micro-batches of a replay, more or less: beyond as many chunks a micro-batch takes several, since its fixed cost
# (logs, planning, commits) is above that of a chunk's rows.
REPLAY_BATCHES = 50


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", "user_id", "event_type")


def _landed(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "landing")
    append_parquet(_events(spark, folder), path)
    return path


def stream_enrich(spark: SparkSession, folder: str) -> DataFrame:
    """Parquet directory in, read time added, Parquet directory out."""
    base = scratch_path(spark, "stream")
    query = start_stamped_copy(
        spark, _landed(spark, folder), f"{base}/out", f"{base}/state", EVENT_SCHEMA, every="once"
    )
    wait(query)
    out = spark.read.parquet(f"{base}/out")
    return out.select(
        "event_id", "user_id", "event_type", F.col(READ_AT).isNotNull().alias("stamped")
    )


def stream_restart(spark: SparkSession, folder: str) -> DataFrame:
    """Stopped and started again on the same checkpoint, with more files in between."""
    base, landing = scratch_path(spark, "stream"), _landed(spark, folder)
    for more in (False, True, False):
        if more:
            append_parquet(
                _events(spark, folder).where(F.col("event_type") == "purchase"), landing
            )
        wait(
            start_stamped_copy(
                spark, landing, f"{base}/out", f"{base}/state", EVENT_SCHEMA, every="once"
            )
        )
    return spark.read.parquet(f"{base}/out").select("event_id", "event_type")


def stream_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Landed in ordered chunks, then streamed by whole chunk files, one per micro-batch while the chunks are few."""
    base, events = scratch_path(spark, "replay"), _events(spark, folder)
    land_in_chunks(events, f"{base}/landing", ["event_id"], REPLAY_ROWS)
    chunks = len(names_in(spark, f"{base}/landing"))
    source = stream_parquet(
        spark,
        f"{base}/landing",
        f"{EVENT_SCHEMA}, ingest_time timestamp, batch_id bigint",
        max_files=max(1, -(-chunks // REPLAY_BATCHES)),
    )
    wait(start_parquet_sink(source, f"{base}/out", f"{base}/state", every="once"))
    out = spark.read.parquet(f"{base}/out")
    return out.select("event_id", "event_type", F.col("ingest_time").isNotNull().alias("landed"))


def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Overlapping files: a key already seen in an earlier micro-batch is dropped."""
    base = scratch_path(spark, "dedup")
    for _ in range(2):
        append_parquet(_events(spark, folder), f"{base}/landing")
    source = stream_parquet(spark, f"{base}/landing", EVENT_SCHEMA, max_files=1)
    rows = source.dropDuplicates(["event_id"])
    wait(start_parquet_sink(rows, f"{base}/out", f"{base}/state", every="once"))
    return spark.read.parquet(f"{base}/out")


def _clean(spark: SparkSession, folder: str) -> str:
    """One query that stores records and rejects; every line comes twice, the second time in files of its own."""
    base = scratch_path(spark, "clean-stream")
    lines = record_lines(spark, folder)
    source = written_lines(lines.unionByName(lines), "records")
    query = start_published_clean(
        spark, source, f"{base}/table", f"{base}/state", RECORD_DDL, every="once", max_files=1, key="seq"
    )
    wait(query)
    return f"{base}/table"


def stream_clean(spark: SparkSession, folder: str) -> DataFrame:
    """JSON lines cleaned as a stream."""
    fields = f"{RECORD_DDL}, {PROCESSED_AT} timestamp, salt string"
    return read_new(spark, _clean(spark, folder), fields).select("id", "name", "city", "seq", "salt")


def stream_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The lines the cleaning stream kept aside."""
    bad = read_rejects(spark, _clean(spark, folder))
    return bad.groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


def stream_first_per_key(spark: SparkSession, folder: str) -> DataFrame:
    """Later events arrive first; the row kept for a user is that of the batch operator."""
    base = scratch_path(spark, "first-stream")
    events = _events(spark, folder)
    for kinds in reversed(EVENT_KINDS):
        append_parquet(events.where(F.col("event_type").isin(kinds)).orderBy(F.desc("event_id")), f"{base}/landing")
        rows = stream_parquet(spark, f"{base}/landing", EVENT_SCHEMA)
        wait(start_first_per_key(rows, f"{base}/table", f"{base}/state", "user_id", ["event_id"], every="once"))
    return read_best(spark, f"{base}/table", EVENT_SCHEMA, "user_id", ["event_id"]).drop("run_id")


def stream_table_load(spark: SparkSession, folder: str) -> DataFrame:
    """Micro-batches loaded into a table through the repeatable batch loader."""
    base = scratch_path(spark, "table-stream")
    events = _events(spark, folder)
    target = parquet_target(f"{base}/table", partition_by=["load_id"])
    for kinds in EVENT_KINDS:  # whatever has landed is one micro-batch, hence one load
        append_parquet(events.where(F.col("event_type").isin(kinds)), f"{base}/landing")
        rows = stream_parquet(spark, f"{base}/landing", EVENT_SCHEMA)
        wait(
            start_table_stream(
                rows, target, ["event_id"], "events", f"{base}/state", every="once", new_table=True
            )
        )
    return target.read(spark).select("event_id", "user_id", "event_type", "load_id")


def stream_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Everything, the last event again, everything once more: the totals count what came too late.

    Spark judges lateness by the watermark of the micro-batch before, hence the one in between. The query is
    started for each and keeps no more than one progress record; the log holds those of all three.
    """
    base = scratch_path(spark, "totals")
    events = table(spark, folder, "events").select("event_id", "ts")
    last = events.orderBy(F.desc("ts"), "event_id").limit(1)
    with ProgressLog(spark, f"{base}/progress") as log:
        for more in (events, last, events.withColumn("event_id", -1 - F.col("event_id"))):
            append_parquet(more, f"{base}/landing")
            rows = stream_parquet(spark, f"{base}/landing", "event_id bigint, ts timestamp_ntz")
            timed = rows.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "1 day")
            kept = timed.dropDuplicatesWithinWatermark(["event_id"])
            log.finish(start_parquet_sink(kept, f"{base}/out", f"{base}/state", every="once"))
    found = whole_report(spark, f"{base}/progress")
    out = spark.read.schema("event_id bigint").parquet(f"{base}/out")
    return out.agg(F.count(F.lit(1)).alias("rows_out")).select(
        F.lit(found.batches).alias("batches"),
        F.lit(found.rows_in).cast("bigint").alias("rows_in"),
        F.lit(found.dropped_late).cast("bigint").alias("dropped_late"),
        "rows_out",
    )


QUERIES = {
    "stream_totals": stream_totals,
    "stream_enrich": stream_enrich,
    "stream_restart": stream_restart,
    "stream_replay": stream_replay,
    "stream_dedup": stream_dedup,
    "stream_first_per_key": stream_first_per_key,
    "stream_clean": stream_clean,
    "stream_rejects": stream_rejects,
    "stream_table_load": stream_table_load,
}

ORACLES = {
    "stream_enrich": "SELECT event_id, user_id, event_type, true AS stamped FROM events",
    "stream_restart": """
        SELECT event_id, event_type FROM events
        UNION ALL SELECT event_id, event_type FROM events WHERE event_type = 'purchase'""",
    "stream_replay": "SELECT event_id, event_type, true AS landed FROM events",
    "stream_dedup": """
        SELECT event_id, user_id, event_type FROM (
            SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_id) AS r FROM events)
        WHERE r = 1""",
    "stream_first_per_key": """
        SELECT event_id, user_id, event_type FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events)
        WHERE r = 1""",
    "stream_clean": f"""
        SELECT user_id AS id, event_type AS name, json_extract_string(props, '$.k') AS city,
               event_id AS seq, sha256(CAST(event_id AS VARCHAR) || '{HASH_SALT}') AS salt
        FROM events WHERE event_type <> 'error'""",
    "stream_rejects": """
        SELECT 'invalid_json' AS problem, 2 * count(*) AS n FROM events WHERE event_type = 'error'""",
    "stream_table_load": """
        SELECT event_id, user_id, event_type,
               CASE WHEN event_type = 'view' THEN 'events-0'
                    WHEN event_type IN ('click', 'signup') THEN 'events-1' ELSE 'events-2' END AS load_id
        FROM events""",
    "stream_totals": """
        WITH edge AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY AS edge FROM events),
             late AS (SELECT count(*) AS n FROM events, edge WHERE ts <= edge)
        SELECT 3 AS batches, 2 * count(*) + 1 AS rows_in, any_value(late.n) AS dropped_late,
               2 * count(*) - any_value(late.n) AS rows_out
        FROM events, late""",
}
