"""Divergence of sources from their language, by a sort of pointers to the starts of terms.

Every task cuts its texts into shards of bounded bytes. A shard's Arrow buffer gives a pointer to the
start of each term, lower-cased in place; the pointers are put in order by multikey quicksort, whose
characters are eight bytes wide and whose open segments are all parted at once. The parting is stable and
pointers begin in order of (lang, source) and document, so a run of equal terms falls into one stretch
for each source, whose length is the count and whose changes of document are the document frequency.

Spark adds the shards up, keeps each language's terms found in enough of its documents, and compares smoothed
integer shares p (group) and q: f = floor((p - q)**2 / (p + q)). Pairs of sources are compared by slices of
the terms, in dense blocks of bounded size, and a slice reports one sum for each pair. Arithmetic is exact.

Defined results: null text, lang and source are ''. A row is a document, so repeated rows count each. A group
without kept terms has the smoothed share of count 0 for every term; if its language keeps none, its pairs have
value 0. A language with one source has no pairs. No rows give no rows. Ties go by item, in the order of its bytes.
Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.arrow_text import bounded_batches, byte_flags, flat_bytes, placed_words, ragged, slices, texts_of
from millrace.scratch import stage

#: A term is kept if so many documents of its language hold it.
MIN_DOCUMENTS = 10
#: Terms reported for a group.
TOP_TERMS = 10
#: Text bytes of a shard.
SHARD_BYTES = 4 << 20
#: Terms times sources of a slice that pairs are compared on.
SLICE_CELLS = 1 << 15

_SCALE = 1_000_000_000
#: What parts terms of the form [^\x00-\x40\x5B-\x60\x7B-\x7F]+.
_PARTS = byte_flags((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: Which bytes of a wide character belong to a term that has 0 to 8 bytes left.
_MASKS = np.array([(1 << 64) - (1 << (64 - 8 * left)) for left in range(9)], np.uint64)
#: Wide characters compared by quicksort; what is equal beyond goes by its bytes.
_DEEPEST = 8


def pointer_sort(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings by their bytes (none of them 0), and where in it another string begins.

    Equal strings keep their order. Multikey quicksort: every round parts each open segment into smaller, equal
    and larger by the pivot's character, and equal ones go on with the next.
    """
    n = len(starts)
    order, new = np.arange(n), np.zeros(n, bool)
    if not n:
        return order, new
    new[0] = True
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    wide = np.ndarray(len(data) + 1, ">u8", padded, strides=(1,))

    def characters(ids: np.ndarray, depth: np.ndarray) -> np.ndarray:
        left = np.clip(lengths[ids] - 8 * depth, 0, 8)
        at = np.minimum(starts[ids] + 8 * depth, len(data))
        return wide[at].astype(np.uint64) & _MASKS[left]

    keys = characters(order, np.zeros(n, np.int64))
    begin, size, depth = np.array([0]), np.array([n]), np.array([0])
    begin, size, depth = begin[size > 1], size[size > 1], depth[size > 1]
    while len(begin):
        members, owner = ragged(begin, size), np.repeat(np.arange(len(begin)), size)
        ids = order[members]
        key = keys[ids]
        first = np.cumsum(size) - size
        pivot = np.sort(np.stack([key[first], key[first + size // 2], key[first + size - 1]]), axis=0)[1]
        mine = pivot[owner]
        side = (key >= mine).astype(np.int64) + (key > mine)
        held = np.bincount(owner * 3 + side, minlength=3 * len(begin)).reshape(-1, 3)
        to = begin[:, None] + np.cumsum(held, axis=1) - held
        for s in range(3):
            at = np.flatnonzero(side == s)
            inner = np.arange(len(at)) - np.repeat(np.cumsum(held[:, s]) - held[:, s], held[:, s])
            order[to[owner[at], s] + inner] = ids[at]
        new[to[held > 0]] = True
        deeper = (pivot & np.uint64(0xFF)) != 0  # a term that ends has a zero here
        open_sides = held > 1
        open_sides[:, 1] &= deeper
        of, side_of = np.nonzero(open_sides)
        begin, size, depth = to[of, side_of], held[of, side_of], depth[of] + (side_of == 1)
        late = depth >= _DEEPEST
        for b, s in zip(begin[late], size[late], strict=True):
            texts = {i: data[starts[i] : starts[i] + lengths[i]].tobytes() for i in order[b : b + s].tolist()}
            found = sorted(texts, key=texts.get)
            order[b : b + s] = found
            new[b + 1 : b + s] = [texts[x] != texts[y] for x, y in zip(found[1:], found[:-1], strict=True)]
        went = (side_of == 1) & ~late
        again = order[ragged(begin[went], size[went])]
        keys[again] = characters(again, np.repeat(depth[went], size[went]))
        begin, size, depth = begin[~late], size[~late], depth[~late]
    return order, new


def _strings(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    return pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets), pa.py_buffer(data[ragged(starts, lengths)])
    )


def _shard_counts(shard: pa.RecordBatch) -> pa.RecordBatch:
    """lang, source, term, count and docs of one shard; a row with the term '' for each group."""
    langs, sources = (shard.column(c).dictionary_encode() for c in ("lang", "source"))
    code = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(sources.dictionary)
    code += sources.indices.to_numpy(zero_copy_only=False)
    groups, group = np.unique(code, return_inverse=True)
    words, counts, _ = placed_words(texts_of(shard, "text"), _PARTS)
    data, offsets = flat_bytes(words)
    data = _LOWER[data]
    by_group = np.argsort(group, kind="stable")  # documents of a group side by side
    pointers = ragged((np.cumsum(counts) - counts)[by_group], counts[by_group])
    document = np.repeat(np.arange(len(by_group)), counts[by_group])
    starts, lengths = offsets[pointers], offsets[pointers + 1] - offsets[pointers]
    order, new = pointer_sort(data, starts, lengths)
    group_of, document = group[by_group][document[order]], document[order]
    other = new.copy()
    other[1:] |= group_of[1:] != group_of[:-1]
    first = np.flatnonzero(other)
    other[1:] |= document[1:] != document[:-1]
    count = np.diff(np.append(first, len(order)))
    docs = np.add.reduceat(other.astype(np.int64), first) if len(first) else count
    heads = order[first]
    terms = _strings(data, starts[heads], lengths[heads])
    none = np.zeros(len(groups), np.int64)
    found = groups[np.concatenate((group_of[first], np.arange(len(groups))))]
    return pa.RecordBatch.from_arrays(
        [
            langs.dictionary.take(pa.array(found // max(1, len(sources.dictionary)))),
            sources.dictionary.take(pa.array(found % max(1, len(sources.dictionary)))),
            pa.concat_arrays([terms, pa.array([""] * len(groups), pa.large_string())]).cast(pa.string()),
            pa.array(np.concatenate((count, none))),
            pa.array(np.concatenate((docs, none))),
        ],
        ["lang", "source", "term", "count", "docs"],
    )


def term_counts(documents: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """lang, source, term, count (occurrences) and docs; each group also has the term '' with zeros."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in slices(batch, "text", shard_bytes):
                yield _shard_counts(shard)

    texts = documents.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    shards = bounded_batches(texts).mapInArrow(count, "lang string, source string, term string, count long, docs long")
    return shards.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10**9 * (count + 2) / (total + 2 * terms)); null without terms."""
    wide = (count + 2).cast("decimal(20,0)") * F.lit(_SCALE).cast("decimal(10,0)")
    each = F.when(terms > 0, (total + 2 * terms).cast("decimal(20,0)"))
    return F.call_function("div", wide, each) + 1


def _pair_sums(cells: pa.Table, groups: pa.Table) -> pa.Table:
    """lang, one, two and the sum of f over the terms of a slice, for each pair of the groups."""
    groups = groups.sort_by("source")
    names = groups.column("source").combine_chunks()
    many = len(names)
    terms = cells.column("term").combine_chunks().dictionary_encode()
    shares = np.tile(pc.fill_null(groups.column("none"), 1).to_numpy(), (len(terms.dictionary), 1))
    where = pc.index_in(cells.column("source").combine_chunks(), value_set=names).to_numpy(zero_copy_only=False)
    shares[terms.indices.to_numpy(zero_copy_only=False), where] = cells.column("p").to_numpy()
    two, values = [], []
    for one in range(many):
        off, both = shares[:, one + 1 :] - shares[:, one, None], shares[:, one + 1 :] + shares[:, one, None]
        values.append((off * off // both).sum(axis=0))
        two.append(np.arange(one + 1, many))
    one, two = np.repeat(np.arange(many), np.arange(many)[::-1]), np.concatenate([np.zeros(0, np.int64), *two])
    lang = groups.column("lang").combine_chunks()
    return pa.Table.from_arrays(
        [
            lang.take(pa.array(one)),
            names.take(pa.array(one)),
            names.take(pa.array(two)),
            pa.array(np.concatenate([np.zeros(0, np.int64), *values]).astype(np.int64)),
        ],
        ["lang", "one", "two", "value"],
    )


def audit_sources(
    documents: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    top: int = TOP_TERMS,
    shard_bytes: int = SHARD_BYTES,
    slice_cells: int = SLICE_CELLS,
) -> DataFrame:
    """lang, source, part, item, value, rank: how far sources are from each other (part pair, all of them)
    and which terms set a source apart from its language (part term, the ``top`` highest)."""
    counts = stage(term_counts(documents, shard_bytes), "terms")
    everywhere = Window.partitionBy("lang", "term")
    cells = stage(
        counts.where("term != ''")
        .withColumns(
            {
                "held": F.sum("docs").over(everywhere),
                "total": F.sum("count").over(everywhere),
                "head": (F.row_number().over(everywhere.orderBy("source")) == 1).cast("long"),
            }
        )
        .where(F.col("held") >= min_documents)
        .select("lang", "source", "term", "count", "total", "head"),
        "cells",
    )
    of_group = cells.groupBy("lang", "source").agg(F.sum("count").alias("n"), F.sum("head").alias("heads"))
    named = counts.where("term = ''").select("lang", "source").join(of_group, ["lang", "source"], "left")
    of_lang = named.groupBy("lang").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_lang"),
        F.coalesce(F.sum("heads"), F.lit(0)).alias("terms"),
        F.count("*").alias("sources"),
    )
    n = F.coalesce(F.col("n"), F.lit(0))
    groups = stage(
        named.join(of_lang, "lang").select(
            "lang",
            "source",
            n.alias("n"),
            "n_lang",
            "terms",
            _share(F.lit(0), n, F.col("terms")).alias("none"),
            F.ceil((F.col("terms") * F.col("sources") + 1) / slice_cells).alias("slices"),
        ),
        "groups",
    )
    shares = cells.join(groups, ["lang", "source"]).withColumns(
        {
            "p": _share(F.col("count"), F.col("n"), F.col("terms")),
            "q": _share(F.col("total"), F.col("n_lang"), F.col("terms")),
        }
    )
    apart = F.expr("(p - q) * (p - q) div (p + q)")
    terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), apart.alias("value"))
    sums = (
        shares.select("lang", F.expr("pmod(xxhash64(term), slices)").alias("slice"), "source", "term", "p")
        .groupBy("lang", "slice")
        .cogroup(
            groups.select("lang", F.explode(F.expr("sequence(0, slices - 1)")).alias("slice"), "source", "none").groupBy(
                "lang", "slice"
            )
        )
        .applyInArrow(_pair_sums, "lang string, one string, two string, value long")
        .groupBy("lang", "one", "two")
        .agg(F.sum("value").alias("value"))
    )
    pairs = sums.select(
        "lang",
        F.explode(F.expr("array(struct(one as source, two as item), struct(two as source, one as item))")).alias("pair"),
        "value",
    ).select("lang", "pair.source", F.lit("pair").alias("part"), "pair.item", "value")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    best = terms.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(ranked)).union(best)


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), found AS (
  SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS total FROM found GROUP BY lang, term HAVING count(DISTINCT id) >= 10
), counts AS (
  SELECT lang, source, term, count(*)::HUGEINT AS c FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL
), langs AS (
  SELECT d.lang, coalesce(k.v, 0) AS v, coalesce(k.n, 0) AS n
  FROM (SELECT DISTINCT lang FROM docs) d
  LEFT JOIN (SELECT lang, count(*)::HUGEINT AS v, sum(total) AS n FROM kept GROUP BY lang) k USING (lang)
), groups AS (
  SELECT g.lang, g.source, coalesce(c.n, 0) AS n, langs.v, langs.n AS n_lang
  FROM (SELECT DISTINCT lang, source FROM docs) g JOIN langs USING (lang)
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL) c USING (lang, source)
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
    1 + 1000000000 * (coalesce(c.c, 0) + 2) // (g.n + 2 * g.v) AS p,
    1 + 1000000000 * (k.total + 2) // (g.n_lang + 2 * g.v) AS q
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) FROM shares x JOIN shares y USING (lang, term)
      WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM shares WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def source_audit_query(spark, sf_dir: str) -> DataFrame:
    """The audit of all documents."""
    return audit_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))
