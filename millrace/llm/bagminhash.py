"""Near-duplicate classes by BagMinHash signatures over multisets of word shingles.

Weights are counts of shingles. The weight axis is cut into dyadic intervals [0, 1), [1, 2),
[2, 4), [4, 8), …; each interval of each shingle carries a Poisson process whose rate is its
length, every point of which falls on a unit of the interval and on a cell of the signature. A
document sees the points on units below the shingle's count, and each cell keeps its
earliest. Two documents agree in a cell with exactly their weighted Jaccard similarity. Points are
only drawn up to a time by which all cells are filled.

Signatures are banded; documents that share a band are compared by their whole multisets, and
links of at least the threshold join classes. Every pair of texts that shares a band is either in
one class already or compared (see below):

* Equal word sequences are one text from the start, so a large group of copies is one row.
* In each bucket all others are compared with its leader, the text with most neighbours. That joins
  a large group of near copies by one link each.
* Members of a bucket that are then still in different classes are compared with each other, first
  by one byte of each cell, then whole if those bytes agree nearly enough. A large bucket is met in
  pairs of blocks; what leaves a task is one link for each two classes that it joins.

Defined results: words are runs of ASCII letters, digits and non-ASCII characters, lower-cased. A
text of fewer words than a shingle is one shingle; a text without words equals only the same text,
and null is the empty text. class_id is the smallest doc_id of the class, null if it has none but
nulls. Repeated rows are members each. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.llm.arrow_text import (
    bounded_batches,
    byte_flags,
    compact,
    flat_bytes,
    free_name,
    mix64,
    ragged,
    slices,
    spaced_words,
    texts_of,
    word_hashes,
)
from millrace.llm.components import connected
from millrace.scratch import stage

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS = 30
ROWS = 5
#: Members of one bucket that are still apart are compared in blocks of about so many.
BLOCK_ROWS = 512
#: Shingles of pairs in memory at once.
SHINGLES_AT_ONCE = 1_000_000
#: Text bytes that a task handles at once, for its memory; one longer text is handled alone.
TEXT_BYTES = 1 << 18
#: Pairs of sketches in memory at once.
PAIRS_AT_ONCE = 200_000
#: A pair is compared whole unless its sketches agree less than the similarity by so much (4.6 standard errors).
SKETCH_SLACK = 0.15

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SEPARATORS = ~byte_flags((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def _shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Hash and text number of every shingle, the words, and the words of each text."""
    words, counts = spaced_words(pc.utf8_lower(texts), _SEPARATORS)
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    hashes = word_hashes(coded.dictionary)[codes] if len(codes) else np.zeros(0, np.uint64)
    held = np.where(counts >= SHINGLE_WORDS, counts - SHINGLE_WORDS + 1, (counts > 0).astype(np.int64))
    firsts = np.cumsum(counts) - counts
    at = ragged(firsts, held)
    owner = np.repeat(np.arange(len(counts)), held)
    ends = (firsts + counts)[owner]
    total = np.zeros(len(at), np.uint64)
    for k in range(SHINGLE_WORDS):
        there = at + k < ends
        total = total * _GOLDEN
        total[there] += hashes[at[there] + k]
    return mix64(total), owner, words, counts


def _digests(texts: pa.Array, words: pa.Array, counts: np.ndarray) -> list[bytes]:
    """16 bytes that stand for the word sequence of each text."""
    data, offsets = flat_bytes(words)
    lengths = np.diff(offsets)
    spaced = np.full(len(data) + len(lengths), 0x20, np.uint8)
    spaced[ragged(offsets[:-1] + np.arange(len(lengths)), lengths)] = data
    word_ends = np.concatenate(([0], np.cumsum(lengths + 1)))
    ends = word_ends[np.cumsum(counts)]
    starts = word_ends[np.cumsum(counts) - counts]
    view = memoryview(spaced)
    return [
        blake2b(view[a:b], digest_size=16).digest()
        if b > a
        else blake2b(b"\0" + (texts[i].as_py() or "").encode(), digest_size=16).digest()
        for i, (a, b) in enumerate(zip(starts, ends, strict=True))
    ]


def _multisets(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, hash and count of each distinct shingle, ordered by owner and hash."""
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], hashes[at], np.diff(np.append(at, len(hashes)))


def signatures(owner: np.ndarray, hashes: np.ndarray, counts: np.ndarray, texts: int, cells: int) -> np.ndarray:
    """A row of ``cells`` point identities for each text; zeros for a text without shingles."""
    result = np.zeros((texts, cells), np.uint64)
    weight = np.bincount(owner, counts, minlength=texts)
    # The processes: one for each dyadic interval that begins below the count.
    levels = np.where(counts > 1, np.ceil(np.log2(np.maximum(counts, 2))).astype(np.int64) + 1, 1)
    of = np.repeat(np.arange(len(owner)), levels)
    level = ragged(np.zeros(len(owner), np.int64), levels)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    rate = np.where(level > 0, low, 1).astype(np.float64)
    seed = mix64(hashes[of] + level.astype(np.uint64) * _GOLDEN)
    limit, text = counts[of], owner[of]
    horizon = np.zeros(texts)
    filled = weight > 0
    horizon[filled] = cells / weight[filled] * (np.log(cells) + 3)
    todo = np.flatnonzero(filled)
    live = np.arange(len(text))
    while len(todo):
        best = np.full(texts * cells, np.inf)
        points: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        active, time, drawn = live, np.zeros(len(live)), np.zeros(len(live), np.int64)
        while len(active):
            left = rate[active] * (horizon[text[active]] - time)
            block = np.ceil(left).astype(np.int64) + 1
            run = np.repeat(np.arange(len(active)), block)
            number = ragged(drawn, block).astype(np.uint64)
            point = mix64(seed[active][run] + (number + np.uint64(1)) * _GOLDEN)
            wait = -np.log(((point >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
            steps = np.cumsum(wait / rate[active][run])
            ends = np.cumsum(block)
            before = np.where(ends > block, steps[ends - block - 1], 0.0)
            at = steps + (time - before)[run]
            place = mix64(point)
            unit = low[active][run] + (
                (place >> np.uint64(32)).astype(np.float64) * 2.0**-32 * rate[active][run]
            ).astype(np.int64)
            seen = (at <= horizon[text[active]][run]) & (unit < limit[active][run])
            cell = ((place & np.uint64(0xFFFFFFFF)) * np.uint64(cells)) >> np.uint64(32)
            slot = (text[active][run] * cells + cell.astype(np.int64))[seen]
            np.minimum.at(best, slot, at[seen])
            points.append((slot, at[seen], point[seen]))
            last = at[ends - 1]
            more = last <= horizon[text[active]]
            active, time, drawn = active[more], last[more], (drawn + block)[more]
        open_cells = np.isinf(best.reshape(texts, cells)).any(axis=1)
        done = np.zeros(texts, bool)
        done[todo] = ~open_cells[todo]
        flat = result.reshape(-1)
        for slot, at, point in points:
            first = (at == best[slot]) & done[slot // cells]
            flat[slot[first]] = point[first]
        todo = todo[open_cells[todo]]
        horizon[todo] *= 2
        pending = np.zeros(texts, bool)
        pending[todo] = True
        live = live[pending[text[live]]]
    return result


def _band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    cells = signature.reshape(len(signature), bands, rows)
    total = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), cells.shape[:2]).copy()
    for k in range(rows):
        total = mix64(total * _GOLDEN + cells[:, :, k])
    return total.view(np.int64)


def _signed(documents: DataFrame, bands: int, rows: int) -> DataFrame:
    """doc_id, digest, band hashes (none for a text without words) and a sketch: a byte of each cell, four of each band."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                texts = texts_of(part, "text")
                hashes, owner, words, counts = _shingles(texts)
                signature = signatures(*_multisets(hashes, owner), len(texts), bands * rows)
                found = _band_hashes(signature, bands, rows)
                names = found.astype("<u4").view(np.uint8).reshape(len(texts), -1)
                sketch = np.concatenate((signature.astype(np.uint8), names), axis=1)
                flat = found[counts > 0].reshape(-1)
                ends = np.concatenate(([0], np.cumsum(np.where(counts > 0, bands, 0)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(_digests(texts, words, counts), pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                        pa.array([row.tobytes() for row in sketch], pa.binary()),
                    ],
                    ["doc_id", "digest", "bands", "sketch"],
                )

    ids = documents.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", ids),
            T.StructField("digest", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
            T.StructField("sketch", T.BinaryType()),
        ]
    )
    return bounded_batches(documents).select("doc_id", "text").mapInArrow(sign, schema)


def _with_digest(documents: DataFrame, into: str) -> DataFrame:
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                texts = texts_of(part, "text")
                words, counts = spaced_words(pc.utf8_lower(texts), _SEPARATORS)
                found = pa.array(_digests(texts, words, counts), pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, found], [*part.schema.names, into])

    schema = T.StructType([*documents.schema.fields, T.StructField(into, T.BinaryType())])
    return bounded_batches(documents).mapInArrow(digest, schema)


def _overlapping(
    pairs: tuple[np.ndarray, np.ndarray], multisets: tuple[np.ndarray, ...], texts: int, similarity: float
) -> np.ndarray:
    """Which pairs of text numbers overlap enough as whole multisets."""
    owner, hashes, counts = multisets
    ends = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=texts))))
    weight = np.bincount(owner, counts, minlength=texts)
    one, two = pairs
    # A pair whose weights are too far apart cannot overlap enough.
    least, most = np.minimum(weight[one], weight[two]), np.maximum(weight[one], weight[two])
    linked = (least > 0) & (least >= similarity * most - 1e-9)
    open_pairs = np.flatnonzero(linked)
    sizes = np.cumsum((ends[one + 1] - ends[one] + ends[two + 1] - ends[two])[open_pairs])
    done = 0
    while done < len(open_pairs):
        held = sizes[done - 1] if done else 0
        stop = max(done + 1, int(np.searchsorted(sizes, held + SHINGLES_AT_ONCE)))
        part = open_pairs[done:stop]
        both = np.stack((one[part], two[part]), axis=1).reshape(-1)
        length = ends[both + 1] - ends[both]
        at = ragged(ends[both], length)
        pair = np.repeat(np.arange(len(both)) // 2, length)
        order = np.lexsort((hashes[at], pair))
        pair, at = pair[order], at[order]
        same = (pair[1:] == pair[:-1]) & (hashes[at[1:]] == hashes[at[:-1]])
        least_count = np.minimum(counts[at[1:]], counts[at[:-1]])[same]
        shared = np.bincount(pair[1:][same], least_count, minlength=len(part))
        whole = weight[one[part]] + weight[two[part]] - shared
        linked[part] = shared >= similarity * whole - 1e-9
        done = stop
    return linked


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts overlap enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a", TEXT_BYTES):
                both = pa.concat_arrays([texts_of(part, "text_a"), texts_of(part, "text_b")])
                hashes, owner, _, _ = _shingles(both)
                rows = np.arange(part.num_rows)
                found = (rows, rows + len(rows))
                linked = _overlapping(found, _multisets(hashes, owner), len(both), similarity)
                yield part.select(["a", "b"]).filter(pa.array(linked))

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(compare, "a long, b long")


_GROUP = ["bucket", "low", "high"]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by group, in tables that hold whole groups."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        same = np.logical_and.reduce([rows[c].to_numpy() == rows[c][-1].as_py() for c in _GROUP])
        whole = int(np.flatnonzero(same)[0])  # the last group may go on
        if whole:
            yield rows.slice(0, whole)
        held = rows.slice(whole)
    if held is not None and len(held):
        yield held


def _close_pairs(rows: pa.Table, bands: int, cells: int, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of pairs of one group with different labels that agree enough in their sketches.

    A pair counts only in the first of the buckets that it shares.
    """
    low, high, label, block, band = (rows[c].to_numpy() for c in ("low", "high", "label", "block", "band"))
    sketch = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint8).reshape(len(rows), -1)
    names = np.ascontiguousarray(sketch[:, cells:]).view("<u4")
    at = np.arange(len(rows))
    new_group = np.ones(len(rows), bool)
    new_group[1:] = np.logical_or.reduce([rows[c].to_numpy()[1:] != rows[c].to_numpy()[:-1] for c in _GROUP])
    new_label = new_group.copy()
    new_label[1:] |= label[1:] != label[:-1]
    group = np.maximum.accumulate(np.where(new_group, at, 0))
    earlier = np.maximum.accumulate(np.where(new_label, at, 0)) - group  # rows of other labels before this one
    across = low != high
    done, ends = 0, np.cumsum(earlier)
    while done < len(rows):
        held = ends[done - 1] if done else 0
        stop = max(done + 1, int(np.searchsorted(ends, held + PAIRS_AT_ONCE)))
        one, two = np.repeat(at[done:stop], earlier[done:stop]), ragged(group[done:stop], earlier[done:stop])
        fit = ~across[one] | (block[one] != block[two])
        one, two = one[fit], two[fit]
        fit = (sketch[one, :cells] == sketch[two, :cells]).mean(axis=1) >= least
        one, two = one[fit], two[fit]
        fit = (names[one] == names[two]).argmax(axis=1) == band[one]
        yield one[fit], two[fit]
        done = stop


def _links_apart(members: DataFrame, texts: DataFrame, similarity: float, bands: int, cells: int) -> DataFrame:
    """Links (a, b) that join labels inside buckets; a spanning set of those in each group.

    ``members`` has bucket, band, size, node, label and sketch. A large bucket is dealt in blocks, and
    each pair of blocks is a group of its own, so a group has a bounded number of rows. Texts join only
    those members that have a close partner, and pairs never leave the task that holds the group.
    """
    blocks = F.expr(f"size div {BLOCK_ROWS} + 1").cast("int")
    dealt = members.withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bucket",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "label",
        "block",
        "band",
        "node",
        "sketch",
    )

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            kept = np.zeros(len(rows), bool)
            for one, two in _close_pairs(rows, bands, cells, similarity - SKETCH_SLACK):
                kept[one] = kept[two] = True
            yield from rows.filter(pa.array(kept)).to_batches()

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            hashes, owner, _, _ = _shingles(compact(rows["text"].combine_chunks()))
            multisets = _multisets(hashes, owner)
            label, node = rows["label"].to_pylist(), rows["node"].to_numpy()
            root: dict[int, int] = {}

            def top(x: int) -> int:
                while (up := root.get(x, x)) != x:
                    root[x] = x = root.get(up, up)
                return x

            left, right = [], []
            for one, two in _close_pairs(rows, bands, cells, similarity - SKETCH_SLACK):
                linked = _overlapping((one, two), multisets, len(rows), similarity)
                for i, j in zip(one[linked].tolist(), two[linked].tolist(), strict=True):
                    x, y = top(label[i]), top(label[j])
                    if x != y:
                        root[x] = y
                        left.append(node[i])
                        right.append(node[j])
            if left:
                ends = [pa.array(left, pa.int64()), pa.array(right, pa.int64())]
                yield pa.RecordBatch.from_arrays(ends, ["a", "b"])

    def grouped(rows: DataFrame) -> DataFrame:
        return rows.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "label")

    with_partner = grouped(dealt).mapInArrow(near, dealt.schema)
    return grouped(with_partner.join(texts.select("node", "text"), "node")).mapInArrow(link, "a long, b long")


def _classes(documents: DataFrame, similarity: float, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """Signed documents, and digest with the node number that stands for its class."""
    signed = stage(_signed(documents, bands, rows), "signed")
    # Written once, so that the numbers hold for all that reads them.
    nodes = stage(
        signed.groupBy("digest")
        .agg(F.first(F.struct("bands", "sketch")).alias("sign"))
        .select("digest", "sign.*", F.monotonically_increasing_id().alias("node")),
        "nodes",
    )
    in_bucket = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = in_bucket.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = stage(in_bucket.join(shared, "bucket"), "members")
    reach = members.groupBy("node").agg(F.sum("size").alias("reach"))
    wanted = nodes.select("digest", "node").join(reach, "node")
    first_text = _with_digest(documents.select("text"), "digest").groupBy("digest").agg(F.first("text").alias("text"))
    texts = stage(first_text.join(wanted, "digest").select("node", "text", "reach"), "texts")

    # First every text meets the leader of each of its buckets.
    ranked = members.select("bucket", "node").join(texts.select("node", "reach"), "node")
    leaders = ranked.groupBy("bucket").agg(F.max(F.struct("reach", "node")).alias("leader"))
    led = members.join(leaders, "bucket").where("node != leader.node")
    ends = [F.least("node", "leader.node").alias("a"), F.greatest("node", "leader.node").alias("b")]
    pairs = stage(led.select(*ends).distinct(), "pairs")
    links = stage(_verified(pairs, texts, similarity), "links")
    classes = connected(links)

    # Then the members of a bucket that are still apart meet each other.
    labelled = members.join(classes, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = labelled.groupBy("bucket").agg((F.min("label") < F.max("label")).alias("mixed")).where("mixed")
    apart = labelled.join(mixed, "bucket").join(nodes.select("node", "sketch"), "node")
    more = stage(_links_apart(apart, texts, similarity, bands, bands * rows), "links")
    classes = connected(links.union(more))
    named = nodes.select("digest", "node").join(classes, "node", "left")
    return signed, named.select("digest", F.coalesce("label", "node").alias("label"))


def near_duplicate_classes(
    documents: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """doc_id, class_id and class_size (rows of the class) for every row of ``documents``."""
    signed, named = _classes(documents, similarity, bands, rows)
    groups = signed.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).join(named, "digest")
    classes = groups.groupBy("label").agg(F.min("least").alias("class_id"), F.sum("n").alias("class_size"))
    of_digest = stage(groups.join(classes, "label").select("digest", "class_id", "class_size"), "classes")
    return signed.join(of_digest, "digest").select("doc_id", "class_id", "class_size")


def keep_one_of_each_class(
    documents: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """Of each class the row with the smallest doc_id (a null only if there is no other)."""
    signed, named = _classes(documents, similarity, bands, rows)
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("digest"))
    groups = signed.groupBy("digest").agg(F.min(rank).alias("best")).join(named, "digest")
    kept = groups.groupBy("label").agg(F.min("best").alias("best")).select(F.col("best.digest").alias("_kept"))
    kept = stage(kept, "kept")
    digest, row = free_name(documents, "_digest"), free_name(documents, "_row")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"))
    rows_by_text = (
        _with_digest(documents, digest)
        .groupBy(digest)
        .agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in documents.columns]), order).alias(row))
    )
    return rows_by_text.join(kept, rows_by_text[digest] == kept["_kept"], "left_semi").select(f"{row}.*")


def bagminhash_query(spark, sf_dir: str) -> DataFrame:
    """doc_id, class_id, class_size for every document."""
    return near_duplicate_classes(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def drop_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each near-duplicate class stays."""
    return keep_one_of_each_class(docs)
