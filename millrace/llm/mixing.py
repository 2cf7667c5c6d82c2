"""Mixing sources to target weights by systematic sampling.

Each document of a source is expected target / source size times in the mix. The expected copies are
summed up in front of each document, one random offset per source is added, and the document is
emitted once per integer boundary that its share crosses. Documents are taken in the order of
their size, so a sample holds small and large ones in proportion and its words come near the target.

Targets share the total size by the weights of the sources, stop at ``most`` times a source's own size,
and the excess is shared again by weight until no target is above its bound. The result is the level
at which all unbounded sources stand, found from sums over sources in the order of size by weight.

No window runs over a whole source: rows are numbered inside sorted ranges, and only counts per
source and range are added up. Counts are integers, so results do not depend on where ranges end.

Defined results: a null or empty text has size 0, is copied like any other and takes no words. The null
source is a source, last in order. A source of size 0 has target 0 and no copies. Equal rows are members
each; rows equal in size and id are interchangeable. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.arrow_text import free_name
from millrace.scratch import stage

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Expected copies are whole numbers of this unit.
UNIT = 1_000_000_000
SEED = "mix"

_WORD = r"[^\x20\x09-\x0D]+"


def text_size(text: str) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(_WORD)), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Number sources 0, 1, 2, … in code point order, null last, without one window over all."""
    part = F.spark_partition_id()
    ranged = sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", part)
    held = stage(ranged, "source-ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = held.groupBy("part").agg(F.count("*").alias("n"))  # one row per task
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return held.join(offsets, "part").select("source", "source_size", (F.col("before") + inside - 1).alias("rank"))


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Add ``target`` to rows of (source, source_size).

    Sources with the same weight fill up in the order of their size, so the level is settled by the
    sums of each weight below a size; candidates are met by aggregation, not in one task.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = stage(
        _ranked(sources).withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int"))),
        "sources",
    )
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    bounded, level = 0, 0.0
    capped_size, open_weight = 0, weighed.agg(F.sum("weight")).first()[0] or 0
    while open_weight:
        # Sources above their bound at this level are fixed there; the rest shares what is left.
        level = (total - most * capped_size) / open_weight
        above = F.col("weight") * F.lit(level) > most * F.col("source_size")
        capped = weighed.agg(
            F.count(F.when(above, 1)), F.sum(F.when(above, F.col("source_size"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if capped[0] == bounded:
            break
        bounded, capped_size, open_weight = capped[0], capped[1] or 0, capped[2] or 0
    bound = (most * F.col("source_size")).cast("double")
    return weighed.withColumn("target", F.least(bound, F.col("weight") * F.lit(float(level)))).select(
        "source", "source_size", "target"
    )


def _offset(source: Column, seed: str) -> Column:
    """The random offset of a source, from 0 to below UNIT."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("="), source), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % UNIT


def sampled(
    documents: DataFrame,
    size: Column | None = None,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: str = SEED,
) -> tuple[DataFrame, dict[str, str]]:
    """``documents`` with the columns size, source_size, target and copies under free names.

    The names are given with the table.
    """
    names = {base: free_name(documents, base) for base in ("size", "source_size", "target", "copies")}
    s, n, order = names["size"], free_name(documents, "_n"), free_name(documents, "_range")
    key = free_name(documents, "_source")
    measured = documents.withColumns({s: text_size("text") if size is None else size, key: F.col("source")})
    keys = [F.col(key).asc_nulls_last(), F.col(s), F.col("doc_id").asc_nulls_last()]
    ranged = measured.repartitionByRange(*keys).withColumn(order, F.spark_partition_id())
    placed = stage(ranged.sortWithinPartitions(*keys), "placed")
    # A range of one source is one task's rows at most.
    inside = Window.partitionBy(order, key).orderBy(F.col(s), F.col("doc_id").asc_nulls_last())
    held = placed.groupBy(order, key).agg(F.count("*").alias("rows"), F.sum(s).alias("words"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(F.col(key).alias("source"), F.col(order).alias("range"), "rows", "words")
    counted = stage(held.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))), "ranges")
    sources = counted.groupBy("source").agg(F.sum("words").alias("source_size"))
    ratio = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size")))
    targets = source_targets(sources, weights, most).withColumn(
        "each", F.floor(F.coalesce(ratio, F.lit(0.0)) * UNIT).cast("decimal(38,0)")
    )
    spans = counted.withColumnRenamed("source", "_of").join(targets, F.col("_of").eqNullSafe(F.col("source")))
    spans = stage(
        spans.select(
            F.col("source").alias("_s"),
            F.col("range").alias("_r"),
            F.col("before").alias("_before"),
            F.col("source_size").alias("_source_size"),
            F.col("target").alias("_target"),
            F.col("each").alias("_each"),
            _offset(F.col("source"), seed).cast("decimal(38,0)").alias("_offset"),
        ),
        "spans",
    )
    spans = spans.toDF(*[free_name(documents, c) for c in spans.columns])
    r_s, r_r, r_before, r_size, r_target, r_each, r_offset = spans.columns
    numbered = placed.withColumn(n, F.row_number().over(inside))
    joined = numbered.join(spans, (F.col(order) == F.col(r_r)) & F.col(key).eqNullSafe(F.col(r_s)))
    last = F.floor((F.col(r_each) * (F.col(r_before) + F.col(n)) + F.col(r_offset)) / F.lit(UNIT))
    first = F.floor((F.col(r_each) * (F.col(r_before) + F.col(n) - 1) + F.col(r_offset)) / F.lit(UNIT))
    return (
        joined.select(
            *[F.col(f"`{c}`") for c in documents.columns],
            F.col(s),
            F.col(r_size).alias(names["source_size"]),
            F.col(r_target).alias(names["target"]),
            (last - first).cast("long").alias(names["copies"]),
        ),
        names,
    )


def mixed(documents: DataFrame, **options) -> DataFrame:
    """The mix: each document as often as it was drawn, with the columns of ``documents``."""
    drawn, names = sampled(documents, **options)
    copy = free_name(drawn, "_copy")
    copies = drawn.where(F.col(names["copies"]) > 0).withColumn(
        copy, F.explode(F.sequence(F.lit(1), F.col(names["copies"]).cast("int")))
    )
    return copies.select(*[F.col(f"`{c}`") for c in documents.columns])


def mixing_query(spark, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken and copies of every document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    small = documents.select("doc_id", "source", text_size("text").alias("size"))
    drawn, names = sampled(small.withColumnRenamed("size", "words"), F.col("words"))
    return drawn.select(
        "doc_id",
        F.col(names["size"]).alias("size"),
        F.col(names["source_size"]).alias("source_size"),
        F.col(names["target"]).alias("target"),
        (F.col(names["copies"]) * F.col(names["size"])).alias("taken"),
        F.col(names["copies"]).alias("copies"),
    )


def mix_sources(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents repeated or left out so that sources come near their targets."""
    return mixed(docs)


ORACLE = f"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size FROM documents
), totals AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM totals
), filled AS (
    SELECT *,
        (SELECT sum(source_size) FROM weighed)
            - {MOST_COPIES} * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
        sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
    FROM weighed
), level AS (
    SELECT max(CAST(left_over AS DOUBLE) / open_weight) AS level FROM filled
), targets AS (
    SELECT source, source_size,
        least(CAST({MOST_COPIES} * source_size AS DOUBLE), weight * level) AS target,
        CAST('0x' || substr(md5('{SEED}' || coalesce('=' || source, '')), 1, 12) AS BIGINT) % {UNIT} AS shift
    FROM weighed, level
), shares AS (
    SELECT *, CASE WHEN source_size > 0
        THEN CAST(floor(least({MOST_COPIES}.0::DOUBLE, target / source_size) * {UNIT}) AS HUGEINT) ELSE 0 END AS each
    FROM targets
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS LAST) AS n FROM sized
), drawn AS (
    SELECT doc_id, size, source_size, target,
        CAST((each * n + shift) // {UNIT} - (each * (n - 1) + shift) // {UNIT} AS BIGINT) AS copies
    FROM placed JOIN shares ON placed.source IS NOT DISTINCT FROM shares.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, copies * size AS taken, copies FROM drawn
"""
