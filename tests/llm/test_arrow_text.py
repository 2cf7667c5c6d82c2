import pyarrow as pa
import pyarrow.compute as pc

from millrace.llm import arrow_text as at


def test_slices_of_a_batch_hold_their_own_texts():
    texts = [None if i % 7 == 3 else f"Doc {i} É " * (i % 5) for i in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    for limit in (1, 30, 100, 10_000):
        seen, words = [], []
        for part in at.slices(batch, "text", limit):
            column = at.texts_of(part, "text")
            seen += column.to_pylist()
            lowered = pc.utf8_lower(pc.ascii_lower(column))
            found, counts = at.spaced_words(lowered, at.BLANKS)
            ends = 0
            for n in counts.tolist():
                words.append(found.slice(ends, n).to_pylist())
                ends += n
        assert seen == [t or "" for t in texts]
        assert words == [(t or "").lower().split(" ")[:-1] if t else [] for t in texts]
