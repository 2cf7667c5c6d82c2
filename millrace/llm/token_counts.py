"""Token counts with a proven whole-token shortcut.

Offline, the vocabulary is searched for what can be counted without merging: the strings that the
library encodes as one token when they stand alone, the characters no merge can cross (barriers), and
whether a mark of white space is only ever the start of a piece. If so, a text falls into
pre-tokens (a run of blanks with the word behind it, a barrier, or a word behind a barrier) that are
encoded independently of each other. Pre-tokens that are whole tokens count one by look-up; the rest is
merged by the library, once for each distinct string of a slice. A vocabulary without this proof is
counted by encoding whole texts.

Defined results: null is the empty text, which has no tokens. Strings of special tokens inside a text are
ordinary text, as the library treats them. Repeated rows are counted each. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.llm.arrow_text import bounded_batches, flat_bytes, slices, texts_of

VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
#: Text bytes counted together.
COUNT_BYTES = 8 << 20

_BLANK = "▁"  # the library's mark of a blank


@dataclass(frozen=True)
class WholeTokens:
    """What was proven of a vocabulary; ``whole`` is None if texts must be encoded as they are."""

    model: bytes
    whole: pa.Array | None
    barriers: tuple[int, ...]


def _processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def prove(path: str | None = None) -> WholeTokens:
    """Read a sentencepiece model and prove which strings are whole tokens."""
    import public_tokenizers

    with open(path or public_tokenizers.path(VOCABULARY), "rb") as file:
        model = file.read()
    library = _processor(model)
    ids = [i for i in range(library.get_piece_size()) if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))]
    pieces = [library.id_to_piece(i) for i in ids]
    inner = any(_BLANK in piece.lstrip(_BLANK) for piece in pieces)
    # Texts must be kept as they are but for one blank put in front.
    same = all(
        library.encode(text, out_type=str) == want
        for text, want in (("", []), (" ", [_BLANK * 2]), ("\n", [_BLANK, "<0x0A>"]))
    )
    if inner or not same or b"identity" not in model:
        return WholeTokens(model, None, ())
    held = set("".join(pieces))
    barriers = tuple(
        code for code in range(128) if code != 0x20 and chr(code) not in held and len(library.encode(chr(code))) == 2
    )
    if 0x0A not in barriers:
        return WholeTokens(model, None, ())
    led = [p for p in pieces if p.startswith(_BLANK)]
    alone = library.encode([p[1:].replace(_BLANK, " ") for p in led])
    whole = [" " + p[1:].replace(_BLANK, " ") for p, found in zip(led, alone, strict=True) if len(found) == 1]
    bare = [p for p in pieces if not p.startswith(_BLANK)]
    whole += [p for p, found in zip(bare, library.encode(["\n" + p for p in bare]), strict=True) if len(found) == 3]
    return WholeTokens(model, pa.array(whole + [chr(b) for b in barriers], pa.large_string()), barriers)


def count_tokens(texts: pa.Array, proven: WholeTokens, library) -> np.ndarray:
    """Tokens of each text (large_string, no nulls)."""
    if proven.whole is None:
        return np.array([len(x) for x in library.encode(texts.to_pylist(), num_threads=1)], np.int64)
    none = pc.binary_length(texts).to_numpy(zero_copy_only=False) == 0
    nothing, blank = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
    marked = pc.replace_substring(texts, _BLANK, " ")
    data, offsets = flat_bytes(pc.binary_join_element_wise(nothing, marked, blank))
    space = data == 0x20
    barrier = np.zeros(256, bool)
    barrier[list(proven.barriers)] = True
    barrier = barrier[data]
    begins = barrier.copy()
    begins[1:] |= (space[1:] & ~space[:-1]) | barrier[:-1]
    begins[offsets[:-1]] = True
    starts = np.flatnonzero(begins)
    bounds = np.append(starts, len(data)).astype(np.int64)
    pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data)))
    coded = pieces.dictionary_encode()
    distinct = coded.dictionary
    known = pc.is_in(distinct, value_set=proven.whole).to_numpy(zero_copy_only=False)
    tokens = np.ones(len(distinct), np.int64)
    at = np.flatnonzero(~known)
    rest = distinct.take(pa.array(at)).to_pylist()
    # A piece without a blank in front stands behind a barrier, which shields it from the blank the library adds.
    given = [p[1:] if p[0] == " " else "\n" + p for p in rest]
    merged = library.encode(given, num_threads=1)
    tokens[at] = [
        (len(found) - 2 if p[0] != " " else len(found)) if g else 1
        for p, g, found in zip(rest, given, merged, strict=True)
    ]
    ends = np.concatenate(([0], np.cumsum(tokens[coded.indices.to_numpy(zero_copy_only=False)])))
    places = np.searchsorted(starts, offsets)
    counts = ends[places[1:]] - ends[places[:-1]]
    counts[none] = 0
    return counts


def token_counts(documents: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of each document; ``path`` is the model's file."""
    shared = documents.sparkSession.sparkContext.broadcast(prove(path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        proven = shared.value
        library = _processor(proven.model)
        for batch in batches:
            for part in slices(batch, "text", COUNT_BYTES):
                texts = texts_of(part, "text")
                sizes = pc.binary_length(texts).cast(pa.int64())
                tokens = pa.array(count_tokens(texts, proven, library))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), sizes, tokens], ["doc_id", "n_bytes", "n_tokens"]
                )

    schema = T.StructType(
        [
            T.StructField("doc_id", documents.schema["doc_id"].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )
    counted = bounded_batches(documents).select("doc_id", "text").mapInArrow(count, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def token_counts_query(spark, sf_dir: str) -> DataFrame:
    """The token counts of all documents."""
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
