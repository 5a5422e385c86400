"""What a Python worker holds while it encodes or tells languages."""

import random
import tracemalloc

import pyarrow as pa

from genoeval.llm import language, pieces


def peak_mb(run, batches):
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in run(iter(batches)))
        return rows, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_encoding_remembers_ids_only():
    """120,000 words, no two alike: what is remembered of them and worked on at once stays far below what the words' ids, decimals and texts take as objects."""
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abcdefghijklmnop", k=8)) for _ in range(250)) for _ in range(480)]
    path = pieces.default_model()
    pieces._loaded(path)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    for run in (pieces._encoded(path), pieces._digests(path)):
        rows, most = peak_mb(run, [batch])
        assert rows == len(texts) and most < 64
    assert not pieces._loaded(path)[1]


def test_ids_of_odd_texts():
    """Ids, decimals and text as the library gives them, where no symbol is a piece and across the bounds of slices and of spelled parts."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    model = pieces._loaded(pieces.default_model())[0]
    texts = ["", " ", "\n", "a\U0001f9ff一  ", "lo " * 70_000, "\U000e0041" * 300, *["minte %d" % i for i in range(50)]]
    for text, ids in zip(texts, pieces.encode_texts(pieces.default_model(), texts), strict=True):
        want = library.encode(text)
        assert ids.tolist() == want and model.joined(ids).decode() == ",".join(map(str, want)) and model.text(ids).decode() == library.decode(want)


def test_language_works_on_a_slice_at_once():
    rng = random.Random(6)
    text = " ".join("".join(rng.choices("aeioulnrst", k=6)) for _ in range(30_000))
    run = language._predicted([("aa", text[:2_000]), ("bb", text[2_000:4_000])], 0)
    batch = pa.RecordBatch.from_arrays([pa.StructArray.from_arrays([pa.array([text] * 12)], names=["text"])], names=["row"])
    rows, most = peak_mb(run, [batch])
    assert rows == 12 and most < 40
