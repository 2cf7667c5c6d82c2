"""Inputs that queries derive from the shared tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.scratch import scratch_path, stage

KEEP_NULLS = {"ignoreNullFields": "false"}

# Rows per derived JSON array and (on average) per derived nested document.
ARRAY_ROWS = 500
DOCUMENT_ROWS = 5000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def event_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON line per event; the lines of ``error`` events lose their last 5 characters."""
    events = table(spark, folder, "events")
    line = F.to_json(
        F.struct(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("user"),
            F.col("event_type").alias("name"),
            F.get_json_object("props", "$.k").alias("k"),
        ),
        KEEP_NULLS,
    )
    cut = F.substring(line, F.lit(1), F.length(line) - 5)
    return events.select(
        "event_id",
        "event_type",
        F.when(F.col("event_type") == "error", cut).otherwise(line).alias("value"),
    )


# The same lines in SQL.
EVENT_LINES_SQL = """
    SELECT event_id, event_type,
           CASE WHEN event_type = 'error' THEN substring(line, 1, length(line) - 5)
                ELSE line END AS value
    FROM (SELECT event_id, event_type,
                 '{"id":' || event_id || ',"user":' || user_id || ',"name":"' || event_type
                 || '","k":"' || json_extract_string(props, '$.k') || '"}' AS line
          FROM events)
"""


def record_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Entity-shaped lines keyed by user, in event order; ``error`` lines are broken."""
    events = table(spark, folder, "events")
    line = F.to_json(
        F.struct(
            F.col("user_id").alias("id"),
            F.col("event_type").alias("name"),
            F.get_json_object("props", "$.k").alias("city"),
            F.col("event_id").alias("seq"),
        ),
        KEEP_NULLS,
    )
    cut = F.substring(line, F.lit(1), F.length(line) - 5)
    return events.select(
        F.when(F.col("event_type") == "error", cut).otherwise(line).alias("value")
    )


RECORD_DDL = "id bigint, name string, city string, seq bigint"


def conversation_arrays(spark: SparkSession, folder: str, rows: int = ARRAY_ROWS) -> DataFrame:
    """JSON arrays of at most ``rows`` conversation turns each, in scan order."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role")
    group = F.floor(F.monotonically_increasing_id() / rows)
    return (
        turns.withColumn("_group", group)
        .groupBy("_group")
        .agg(F.to_json(F.collect_list(F.struct("conv_id", "turn", "role"))).alias("value"))
        .select("value")
    )


def _once(copies: Column, key: Column, value: Column) -> Column:
    """``value``; an error where the key of an object is null or would repeat, as maps have it."""
    return F.when((copies == 1) & key.isNotNull(), value).otherwise(
        F.raise_error(F.concat(F.lit("null or repeated key: "), F.coalesce(key.cast("string"), F.lit("null"))))
    )


def _inside(text: Column) -> Column:
    """JSON text without its outer brackets."""
    return F.substring(text, F.lit(2), F.length(text) - 2)


def _dishes(spark: SparkSession, folder: str) -> DataFrame:
    """Each part as the JSON text of a dish, ``"key":{…}``, and of the category it stands in."""
    dish = F.struct(F.col("p_size").cast("string").alias("price"), F.col("p_type").alias("veg_or_non_veg"))
    return (
        table(spark, folder, "part")
        .where(F.col("p_partkey").isNotNull())
        .repartition("p_partkey")
        .groupBy("p_partkey", "p_brand")
        .agg(
            F.count(F.lit(1)).alias("dishes"),
            F.first(_inside(F.to_json(F.create_map(F.col("p_partkey").cast("string"), dish)))).alias("dish"),
        )
        .withColumn("category", F.when(F.col("p_brand").isNotNull(), _inside(F.to_json(F.array("p_brand")))))
    )


def _shops(spark: SparkSession, folder: str) -> DataFrame:
    """Each supplier as the JSON text of a document up to its menu; written, so that its size is known."""
    home = table(spark, folder, "supplier").join(
        table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    shop = F.struct(
        F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("string").alias("cost"),
        F.concat_ws(", ", "s_name", "n_name").alias("address"),
    )
    opening = F.concat(
        F.lit("{"),
        _inside(F.to_json(F.array("n_name"))),
        F.lit(":{"),
        _inside(F.to_json(F.struct(F.concat(F.lit("/"), F.lower("n_name")).alias("link")))),
        F.lit(',"restaurants":{"'),
        F.col("s_suppkey").cast("string"),
        F.lit('":{'),
        _inside(F.to_json(shop)),
        F.lit(',"menu":{'),
    )
    shops = (
        home.where(F.col("s_suppkey").isNotNull())
        .groupBy("s_suppkey", "n_name")
        .agg(F.count(F.lit(1)).alias("shops"), F.first(opening).alias("opening"))
    )
    return stage(shops, "shops")


def supplier_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Nested documents over supplier, part and lineitem.

    A document holds one supplier and one range of its parts, so it stays small
    however many parts a supplier has; such a supplier shows up in many documents.
    Text is made once a part and once a supplier: what is moved and gathered for a
    pair is its dish, and the supplier joins its documents, not its pairs.
    """
    # One shuffle serves the distinct pairs and their join.
    pairs = table(spark, folder, "lineitem").select("l_suppkey", "l_partkey").repartition("l_partkey").distinct()
    rows = pairs.join(_dishes(spark, folder).hint("shuffle_hash"), F.col("l_partkey") == F.col("p_partkey"))
    document = ["l_suppkey", "_range"]
    # A stated number is not coalesced by bytes, which say little of what the text costs that these rows become.
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    gathered = (
        rows.select(
            "l_suppkey",
            F.expr(f"l_partkey div {DOCUMENT_ROWS}").alias("_range"),
            _once(F.col("dishes"), F.col("category"), F.col("category")).alias("category"),
            "dish",
        )
        .repartition(spread, *document)
        .groupBy(*document)
        .agg(F.collect_list(F.struct("category", "dish")).alias("menu"))
        .withColumn("menu", F.sort_array("menu"))
    )

    def written(entry: Column, at: Column) -> Column:
        begun = F.concat(entry["category"], F.lit(":{"), entry["dish"])
        return (
            F.when(at == 0, begun)
            .when(entry["category"] == F.get("menu", at - 1)["category"], F.concat(F.lit(","), entry["dish"]))
            .otherwise(F.concat(F.lit("},"), begun))
        )

    menus = gathered.select("l_suppkey", F.array_join(F.transform("menu", written), "").alias("menu"))
    return menus.join(_shops(spark, folder), F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.concat(_once(F.col("shops"), F.col("n_name"), F.col("opening")), F.col("menu"), F.lit("}}}}}}")).alias("value")
    )


def written_lines(lines: DataFrame, label: str) -> str:
    """Write a one-column text DataFrame and return its folder."""
    path = scratch_path(lines.sparkSession, label)
    lines.write.text(path)
    return path


def written_documents(parts: DataFrame, opening: str, closing: str, label: str) -> str:
    """Write JSON documents on one line each, their ``value`` parts parted by commas; returns their folder.

    One file has one writer, so every partition of ``parts`` is a document in a file of its own: they grow in number
    with the input, and no task writes or gathers the whole. A partition without parts gives no document.
    """

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        led = opening
        for batch in batches:
            values = batch.column(0)
            if not len(values):
                continue
            leads = pa.array([led] + [","] * (len(values) - 1), values.type)
            empty = pa.scalar("", values.type)
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(leads, values, empty)], ["value"])
            led = ","
        if led != opening:
            yield pa.RecordBatch.from_arrays([pa.array([closing], pa.string())], ["value"])

    spark, path = parts.sparkSession, scratch_path(parts.sparkSession, label)
    whole = parts.select("value").where(F.col("value").isNotNull()).mapInArrow(framed, "value string")
    whole.write.option("lineSep", " ").text(path)
    return path
