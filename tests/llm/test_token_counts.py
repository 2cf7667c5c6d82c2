import random

import pytest
import sentencepiece
import public_tokenizers

from millrace.llm import token_counts as tc


def texts():
    rng = random.Random(8)
    odd = ["", None, " ", "  ", "\n", "\n\n x", "▁a▁▁b", "a  b   c", " lead", "trail ", "<s>x</s> <0x0A>", "\ta\r\nb",
           "ﬁ　é́", "\x00\x01", "日本語 テスト", "\U0001f600", "x" * 5000, "word " * 4000, "a\n b", "a \nb", " n"]
    pieces = ["the", "Thing", "don't", "é", "12", "!", "\n", "\t", "--", "▁", "ungüte", "\x7f", "…", "  ", "of"]
    return odd + ["".join(rng.choice(pieces) + rng.choice(["", " ", "  "]) for _ in range(150)) for _ in range(60)]


def test_counts_match_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = [(i, t, 0) for i, t in enumerate(texts())] + [(3, "again", 0), (None, "no id", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").repartition(4)
    got = sorted(map(tuple, tc.token_counts(docs).collect()), key=str)
    want = []
    for doc_id, text, _ in rows:
        n = len(library.encode(text or ""))
        want.append((doc_id, len((text or "").encode()), n, n > 4096))
    assert got == sorted(want, key=str)


def test_proof_holds_for_most_words_and_can_fail():
    proven = tc.prove()
    assert len(proven.whole) > 20_000 and 0x0A in proven.barriers
    library = tc._processor(proven.model)
    import pyarrow as pa

    plain = tc.WholeTokens(proven.model, None, ())
    array = pa.array([t or "" for t in texts()], pa.large_string())
    assert tc.count_tokens(array, plain, library).tolist() == tc.count_tokens(array, proven, library).tolist()


@pytest.mark.parametrize("rows", [[]])
def test_empty(spark, rows):
    assert tc.token_counts(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0
