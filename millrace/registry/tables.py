"""Table sources and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.registry.inputs import table
from millrace.scratch import scratch_path
from millrace.operators import key_pages, parse_lines
from millrace.errors import SchemaError
from millrace.sinks import (
    append_new,
    append_once,
    append_parquet,
    append_run,
    parquet_target,
    read_merged,
    read_new,
    read_runs,
    replace_run,
    staged_load,
)
from millrace.sources import (
    file_inventory,
    key_ranges,
    probe_files,
    read_file_runs,
    read_lines,
    read_table,
    run_new_files,
    split_readable,
)
from millrace.sources.tables import quantile_bounds
from millrace.plans import run_load

# Pages of a table read by its key.
PAGES = 8

EVENT_KINDS = (["view"], ["click", "signup"], ["error", "purchase"])


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")


def append_union(spark: SparkSession, folder: str) -> DataFrame:
    """Slices appended to one table and read back together."""
    events, path = _events(spark, folder), scratch_path(spark, "appended")
    known = [kind for kinds in EVENT_KINDS for kind in kinds]
    for kinds in EVENT_KINDS:
        append_parquet(events.where(F.col("event_type").isin(kinds)), path)
    other = events.where(~F.coalesce(F.col("event_type").isin(known), F.lit(False)))
    append_parquet(other, path)
    return read_table(spark, path, events.schema)


def rerun_replace(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs under one id and one under another: each id holds its rows once."""
    events, path = _events(spark, folder), scratch_path(spark, "runs")
    for run in ("a", "a", "b"):
        replace_run(events, path, run)
    return read_runs(spark, path, events.schema).select("event_id", "event_type", "run_id")


def rerun_smaller(spark: SparkSession, folder: str) -> DataFrame:
    """A run repeated with fewer rows, then one with none: nothing of the former rows is left."""
    events, path = _events(spark, folder), scratch_path(spark, "runs")
    replace_run(events, path, "2024-05-01")
    replace_run(events, path, "001")
    replace_run(events.where(F.col("event_type") == "purchase"), path, "2024-05-01")
    replace_run(events.limit(0), path, "001")
    return read_runs(spark, path, events.schema).select("event_id", "event_type", "run_id")


def run_failed_midway(spark: SparkSession, folder: str) -> DataFrame:
    """A run repeated with other rows dies while it writes: its former rows still count, and only they."""
    events, path = _events(spark, folder), scratch_path(spark, "runs")
    for run in ("a", "b"):
        replace_run(events, path, run)
    dying = F.when(F.col("event_type") == "purchase", F.raise_error(F.lit("injected"))).otherwise(F.lit("new"))
    try:
        replace_run(events.withColumn("event_type", dying.cast("string")), path, "a")
    except PySparkException as error:
        died = "injected" in str(error)
    replace_run(events.where(F.col("event_type") == "purchase"), path, "b")
    found = read_runs(spark, path, events.schema)
    return found.select("event_id", "event_type", "run_id", F.lit(died).alias("died"))


def dedup_across_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs that overlap, one of them repeated: each key is stored by the first run that brought it."""
    events, table_path = _events(spark, folder), scratch_path(spark, "known")
    changed = events.withColumn("value", F.col("value") + 1)
    some = events.where(F.col("event_type").isin("view", "click"))
    append_new(some.unionByName(some), table_path, "one", "event_id")
    append_new(events, table_path, "two", "event_id")
    append_new(changed, table_path, "two", "event_id")
    append_new(changed, table_path, "three", "event_id")
    return read_new(spark, table_path, events.schema)


def append_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Runs whose key is an int, then a bigint with a field more, then a text: the last one is refused."""
    events, path = _events(spark, folder).drop("value"), scratch_path(spark, "drift")
    append_run(events.withColumn("user_id", F.col("user_id").cast("int")), path, "narrow")
    append_run(events.withColumn("length", F.length("event_type")), path, "wide")
    refused = ""
    try:
        append_run(events.withColumn("user_id", F.col("user_id").cast("string")), path, "text")
    except SchemaError as problem:
        refused = str(problem)
    named = refused.startswith(path) and "'user_id' is int here and string there" in refused
    return read_merged(spark, path).select(
        "event_id", "user_id", "event_type", "length", "run_id", F.lit(named).alias("refused_with_folder")
    )


def _cut_in_half(spark: SparkSession, path: str) -> None:
    """Leave the first half of the one file that a pattern names."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    pattern = jvm.org.apache.hadoop.fs.Path(path)
    files = pattern.getFileSystem(conf)
    (status,) = files.globStatus(pattern)
    with_head = files.open(status.getPath())
    head = with_head.readNBytes(status.getLen() // 2)
    with_head.close()
    out = files.create(status.getPath(), True)
    out.write(head)
    out.close()


def unreadable_files(spark: SparkSession, folder: str) -> DataFrame:
    """A Parquet and a gzip file for each kind of event, one of each cut in half: the rows of the others, and two reasons."""
    events, base = _events(spark, folder), scratch_path(spark, "unreadable")
    for kinds in EVENT_KINDS:
        mine = events.where(F.col("event_type").isin(kinds))
        mine.coalesce(1).write.parquet(f"{base}/{kinds[0]}/parquet")
        mine.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.option("compression", "gzip").text(
            f"{base}/{kinds[0]}/text"
        )
    _cut_in_half(spark, f"{base}/click/parquet/*.parquet")
    _cut_in_half(spark, f"{base}/error/text/*.gz")
    tables, bad_tables = split_readable(probe_files(spark, f"{base}/*/parquet/*.parquet"))
    texts, bad_texts = split_readable(probe_files(spark, f"{base}/*/text/*.gz"))
    whole = spark.read.schema(events.schema).parquet(*tables).select("event_id", F.lit("parquet").alias("found"))
    lines = parse_lines(read_lines(spark, texts), events.schema).select("event_id", F.lit("text").alias("found"))
    refused = bad_tables.unionByName(bad_texts).select(F.lit(None).cast("bigint").alias("event_id"), F.col("reason").alias("found"))
    return whole.unionByName(lines).unionByName(refused)


def only_new_files(spark: SparkSession, folder: str) -> DataFrame:
    """Runs over a growing folder, one of which fails: every file is read once, those of the failed run by the next."""
    events, base = _events(spark, folder), scratch_path(spark, "new-files")

    def read(paths: list[str]) -> DataFrame:
        return spark.read.schema(events.schema).parquet(*paths)

    def fail(paths: list[str]) -> DataFrame:
        return read(paths).withColumn("event_type", F.raise_error(F.lit("injected")).cast("string"))

    died = False
    for number, (kinds, job) in enumerate(zip(EVENT_KINDS, (read, fail, read))):
        append_parquet(events.where(F.col("event_type").isin(kinds)), f"{base}/landing")
        try:
            run_new_files(spark, f"{base}/landing/*.parquet", f"{base}/table", f"run-{number}", job)
        except PySparkException as error:
            died = "injected" in str(error)
    again = run_new_files(spark, f"{base}/landing/*.parquet", f"{base}/table", "run-3", read)
    found = read_file_runs(spark, f"{base}/table", events.schema)
    return found.select("event_id", "event_type", "run_id", F.lit(died and again.files == 0).alias("as_expected"))


def keyset_pages(spark: SparkSession, folder: str) -> DataFrame:
    """All pages by a key with many equal values, each read behind the last key of the page before."""
    lines = table(spark, folder, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber")
    pages = key_pages(lines, "l_suppkey", -(-lines.count() // PAGES))
    whole = pages.read(lines, 0).withColumn("in_order", F.lit(True))
    for number, cursor in enumerate(pages.bounds, start=1):
        behind = pages.after(lines, cursor)
        fits = F.col("l_suppkey") > F.lit(cursor)
        if number < len(pages.bounds):
            fits = fits & (F.col("l_suppkey") <= F.lit(pages.bounds[number]))
        whole = whole.unionByName(behind.withColumn("in_order", fits))
    return whole


def load_once(spark: SparkSession, folder: str) -> DataFrame:
    """A load that died after part of its rows, repeated twice under the same id."""
    events, path = _events(spark, folder), scratch_path(spark, "loaded")
    target = parquet_target(path)
    part = events.where(F.col("event_type").isin("view", "click"))
    first = append_once(part, target, "load-1", ["event_id"], new_table=True)
    second = append_once(events, target, "load-1", ["event_id"])
    third = append_once(events, target, "load-1", ["event_id"])
    stored = target.read(spark)
    return stored.select(
        "event_id",
        "event_type",
        "load_id",
        F.lit(first.rows_added + second.rows_added).alias("added"),
        F.lit(third.rows_added).alias("added_again"),
    )


def warehouse_load(spark: SparkSession, folder: str) -> DataFrame:
    """A Parquet directory loaded into a staging table, checked, then appended."""
    events, base = _events(spark, folder), scratch_path(spark, "warehouse")
    append_parquet(events, f"{base}/refined")
    statement = staged_load(events, parquet_target(f"{base}/staging"), "events_final")
    report = run_load(spark, f"{base}/refined", parquet_target(f"{base}/final"), events.schema)
    return read_table(spark, f"{base}/final", events.schema).select(
        "event_id",
        "value",
        F.lit(report.rows_added).alias("loaded"),
        F.lit(statement.startswith("INSERT INTO events_final (")).alias("publishes"),
    )


def source_slices(spark: SparkSession, folder: str) -> DataFrame:
    """The predicates of a sliced relational read, at the key's own quantiles, in one scan.

    Every row meets exactly one of them, nulls included.
    """
    lines = table(spark, folder, "lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.col("l_suppkey")).alias("supplier_key"),
        "l_orderkey",
        "l_linenumber",
    )
    predicates = key_ranges("supplier_key", quantile_bounds(lines, "supplier_key", 8))
    met = reduce(lambda a, b: a + b, [F.expr(f"cast(coalesce({p}, false) as int)") for p in predicates])
    return lines.withColumn("_met", met).select("*", F.explode(F.sequence(F.lit(1), "_met"))).select(
        *lines.columns
    )


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of written text files per event type, from the listing alone."""
    path = scratch_path(spark, "inventory")
    lines = _events(spark, folder).select(
        "event_type", F.concat_ws(" ", "event_id", "user_id", "event_type").alias("value")
    )
    lines.write.partitionBy("event_type").text(path)
    name = F.regexp_extract("path", "event_type=([^/]+)", 1)
    listed = file_inventory(spark, f"{path}/*/*.txt")
    return listed.groupBy(name.alias("event_type")).agg(F.sum("length").alias("bytes"))


QUERIES = {
    "append_union": append_union,
    "rerun_replace": rerun_replace,
    "rerun_smaller": rerun_smaller,
    "run_failed_midway": run_failed_midway,
    "dedup_across_runs": dedup_across_runs,
    "append_drift": append_drift,
    "unreadable_files": unreadable_files,
    "only_new_files": only_new_files,
    "keyset_pages": keyset_pages,
    "load_once": load_once,
    "warehouse_load": warehouse_load,
    "source_slices": source_slices,
    "file_inventory": inventory,
}

ORACLES = {
    "append_union": "SELECT event_id, user_id, event_type, value FROM events",
    "rerun_replace": """
        SELECT event_id, event_type, run_id
        FROM events CROSS JOIN (SELECT 'a' AS run_id UNION ALL SELECT 'b')""",
    "rerun_smaller": """
        SELECT event_id, event_type, '2024-05-01' AS run_id FROM events WHERE event_type = 'purchase'""",
    "run_failed_midway": """
        SELECT event_id, event_type, 'a' AS run_id, true AS died FROM events
        UNION ALL SELECT event_id, event_type, 'b', true FROM events WHERE event_type = 'purchase'""",
    "dedup_across_runs": """
        SELECT event_id, user_id, event_type,
               CASE WHEN event_type IN ('view', 'click') THEN value ELSE value + 1 END AS value,
               CASE WHEN event_type IN ('view', 'click') THEN 'one' ELSE 'two' END AS run_id
        FROM events""",
    "append_drift": """
        SELECT event_id, user_id, event_type, CAST(NULL AS INTEGER) AS length, 'narrow' AS run_id,
               true AS refused_with_folder
        FROM events
        UNION ALL SELECT event_id, user_id, event_type, CAST(length(event_type) AS INTEGER), 'wide', true FROM events""",
    "unreadable_files": """
        SELECT event_id, 'parquet' AS found FROM events WHERE event_type IN ('view', 'error', 'purchase')
        UNION ALL SELECT event_id, 'text' FROM events WHERE event_type IN ('view', 'click', 'signup')
        UNION ALL SELECT NULL, 'no_footer' UNION ALL SELECT NULL, 'cut_short'""",
    "only_new_files": """
        SELECT event_id, event_type, CASE WHEN event_type = 'view' THEN 'run-0' ELSE 'run-2' END AS run_id,
               true AS as_expected
        FROM events""",
    "keyset_pages": "SELECT l_suppkey, l_orderkey, l_linenumber, true AS in_order FROM lineitem",
    "load_once": """
        SELECT event_id, event_type, 'load-1' AS load_id, count(*) OVER () AS added,
               CAST(0 AS BIGINT) AS added_again
        FROM events""",
    "warehouse_load": """
        SELECT event_id, value, count(*) OVER () AS loaded, true AS publishes FROM events""",
    "file_inventory": """
        SELECT event_type, CAST(sum(strlen(concat_ws(' ', event_id, user_id, event_type)) + 1) AS BIGINT) AS bytes
        FROM events WHERE event_type IS NOT NULL GROUP BY event_type""",
    "source_slices": """
        SELECT CASE WHEN l_returnflag <> 'R' THEN l_suppkey END AS supplier_key,
               l_orderkey, l_linenumber
        FROM lineitem""",
}
