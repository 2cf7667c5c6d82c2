"""Chat formatting by linking quotations to the messages they come from.

A line's quote level is the number of > in front of it. Runs of lines of one level are passages; each paragraph
of a passage, and each of its lines, is normalised (lower case, single blanks) and hashed, as are those of every
message's own words. A quotation belongs to the earliest message with the same hash in its conversation, else
in all conversations before it, so a passage that many messages share is matched with one of them only. The
message that most quoted characters of the lowest matched level come from is the one replied to.

Replies are followed up to a message that replies to none, by doubling the steps. A conversation then holds
all messages whose root is in it, by the root's turn and the number of replies below it, without
quotes and the lines that introduce them ("… wrote:").

Defined results: null is the empty text. A message without quotes keeps its text. Passages shorter than a few
characters link nothing. An original stands before its quotation by (conv_id, turn); rows without conv_id or turn
link nothing and nothing links to them. Repeated rows are messages each; the quotation belongs to one of them. No
rows give no rows. Other columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.llm.arrow_text import bounded_batches, slices
from millrace.operators.chunks import number_rows
from millrace.scratch import stage

#: Shortest normalised passage that links.
MIN_CHARS = 12

_MARK = re.compile(r"(?:[ \t]*>)+")
_INTRODUCTION = re.compile(r"\bwrote:\s*$")


def levels(text: str) -> list[tuple[int, str]]:
    """Quote level and content of each line."""
    found = []
    for line in text.split("\n"):
        mark = _MARK.match(line)
        if mark:
            found.append((mark.group().count(">"), line[mark.end() :].removeprefix(" ")))
        else:
            found.append((0, line))
    return found


def without_quotes(lines: list[tuple[int, str]]) -> str:
    """The lines of level 0, without those that introduce a quotation, and at most one blank line in a row."""
    kept: list[str] = []
    for i, (level, line) in enumerate(lines):
        if level:
            continue
        behind = next((other for other, rest in lines[i + 1 : i + 4] if other or rest.strip()), 0)
        if behind and _INTRODUCTION.search(line):
            continue
        if line.strip() or (kept and kept[-1].strip()):
            kept.append(line)
    return "\n".join(kept).strip("\n")


def passages(lines: list[tuple[int, str]]) -> dict[tuple[int, bytes], int]:
    """Length of each distinct passage, by level and hash: paragraphs of runs of a level, and lines."""
    found: dict[tuple[int, bytes], int] = {}

    def add(level: int, pieces: list[str]) -> None:
        plain = " ".join(" ".join(pieces).lower().split())
        if len(plain) >= MIN_CHARS:
            found[level, xxhash.xxh3_128_digest(plain.encode())] = len(plain)

    held: list[str] = []
    level = 0
    for other, line in [*lines, (-1, "")]:
        if held and (other != level or not line.strip()):
            add(level, held)
            held = []
        level = other
        if line.strip():
            held.append(line)
            add(other, [line])
    return found


_PASSAGES = "array<struct<level:int,hash:binary,chars:int>>"


def _parsed(messages: DataFrame) -> DataFrame:
    """id, key columns, text without quotes, whether it had any, and its passages."""
    kind = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.binary()), ("chars", pa.int32())]))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts, held = [], []
                for text in part.column("text").to_pylist():
                    text = text or ""
                    lines = levels(text)
                    quoted = any(level for level, _ in lines)
                    texts.append(without_quotes(lines) if quoted else text)
                    rows = passages(lines)
                    held.append([{"level": a, "hash": b, "chars": n} for (a, b), n in rows.items()])
                columns = [part.column(c) for c in ("conv_id", "turn", "role")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(texts, pa.string()), pa.array(held, kind)],
                    ["conv_id", "turn", "role", "text", "passages"],
                )

    chosen = messages.select("conv_id", "turn", "role", "text")
    schema = T.StructType(
        [
            *[chosen.schema[c] for c in ("conv_id", "turn", "role")],
            T.StructField("text", T.StringType()),
            *T.StructType.fromDDL(f"passages {_PASSAGES}").fields,
        ]
    )
    return bounded_batches(chosen).mapInArrow(parse, schema).withColumn("id", F.monotonically_increasing_id())


def reply_links(parsed: DataFrame) -> DataFrame:
    """id and parent (the id of the message replied to)."""
    rows = parsed.where("conv_id is not null and turn is not null").select(
        "id", "conv_id", "turn", F.explode("passages").alias("p")
    )
    rows = rows.select("id", "conv_id", "turn", F.col("p.level").alias("level"), F.col("p.hash").alias("hash"), "p.chars")
    quotes = stage(rows.where("level > 0").drop("p"), "quotations")
    place = F.min(F.struct("conv_id", "turn", "id")).alias("first")
    # Only passages that somebody quotes take part; each has one earliest message at most.
    own = rows.where("level = 0").join(quotes.select("hash").distinct(), "hash", "left_semi")
    near = stage(own.groupBy("hash", "conv_id").agg(place), "originals")
    far = near.groupBy("hash").agg(F.min("first").alias("anywhere"))
    found = quotes.join(near, ["hash", "conv_id"], "left").join(far, "hash", "left")
    me = F.struct("conv_id", "turn", "id")
    earlier = F.when(F.col("first.turn") < F.col("turn"), F.col("first"))
    outside = F.when((F.col("anywhere.conv_id") != F.col("conv_id")) & (F.col("anywhere") < me), F.col("anywhere"))
    matched = found.withColumn("original", F.coalesce(earlier, outside)).where("original is not null")
    votes = matched.groupBy("id", "level", "original").agg(F.sum("chars").alias("chars"))
    best = votes.groupBy("id").agg(F.min(F.struct("level", -F.col("chars"), "original")).alias("best"))
    return best.select("id", F.col("best.original.id").alias("parent"))


def roots(links: DataFrame) -> DataFrame:
    """id, root and level of every message that replies to one."""
    reach = stage(links.select("id", F.col("parent").alias("root"), F.lit(1).cast("long").alias("level")), "reach")
    while True:
        above = reach.select(F.col("id").alias("root"), F.col("root").alias("upper"), F.col("level").alias("more"))
        joined = reach.join(above, "root", "left")
        if joined.where("upper is not null").isEmpty():
            return reach
        reach = stage(
            joined.select(
                "id",
                F.coalesce("upper", "root").alias("root"),
                (F.col("level") + F.coalesce("more", F.lit(0))).alias("level"),
            ),
            "reach",
        )


def reply_ordered(messages: DataFrame) -> DataFrame:
    """Every message with its place in the reply-ordered conversation and its text without quotes.

    Columns: conversation (conv_id of the root), position (from 0 in the conversation), conv_id, turn, role, text,
    parent_conv, parent_turn and level (replies between the message and its root).
    """
    parsed = stage(_parsed(messages), "messages")
    links = stage(reply_links(parsed), "replies")
    above = roots(links)
    keys = parsed.select(F.col("id").alias("at"), F.struct("conv_id", "turn").alias("key"))
    root_keys = above.join(keys, F.col("root") == F.col("at")).select("id", "level", F.col("key").alias("root_key"))
    parent_keys = links.join(keys, F.col("parent") == F.col("at")).select("id", F.col("key").alias("parent_key"))
    placed = (
        parsed.drop("passages")
        .join(root_keys, "id", "left")
        .join(parent_keys, "id", "left")
        .select(
            F.when(F.col("root_key").isNull(), F.col("conv_id")).otherwise(F.col("root_key.conv_id")).alias("conversation"),
            F.when(F.col("root_key").isNull(), F.col("turn")).otherwise(F.col("root_key.turn")).alias("root_turn"),
            "conv_id",
            "turn",
            "role",
            "text",
            F.col("parent_key.conv_id").alias("parent_conv"),
            F.col("parent_key.turn").alias("parent_turn"),
            F.coalesce("level", F.lit(0)).alias("level"),
        )
    )
    order = [F.col(c).asc_nulls_last() for c in ("conversation", "root_turn", "level", "conv_id", "turn")]
    numbered = stage(number_rows(placed, order, "position"), "numbered")
    firsts = numbered.groupBy("conversation").agg(F.min("position").alias("first")).withColumnRenamed("conversation", "of")
    joined = numbered.join(firsts, F.col("conversation").eqNullSafe(F.col("of")))
    return joined.withColumn("position", F.col("position") - F.col("first")).select(
        "conversation", "position", "conv_id", "turn", "role", "text", "parent_conv", "parent_turn", "level"
    )


def quotes_query(spark, sf_dir: str) -> DataFrame:
    """All messages of the conversations in reply order."""
    return reply_ordered(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
