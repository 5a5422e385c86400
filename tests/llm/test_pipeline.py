"""Pipeline stages, one after another, against brute force."""

import random
import zlib

import corpus_pipeline
from test_llm import SCHEMA, brute_classes, brute_contamination, brute_repeats, corpus


def test_pipeline(spark, tmp_path):
    import sentencepiece

    from genoeval.llm import language, pieces

    rows = corpus()
    rng = random.Random(9)
    benchmark = [(1, " ".join(rows[8][1].split(" ")[100:130])), (2, "passage that no text has " * 3)]
    rng.shuffle(rows)
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    stage = dict(corpus_pipeline.STAGES)

    def held(name, given):
        out = stage[name](spark, given, str(tmp_path))
        assert name == names[-1] or out.columns == docs.columns
        out.write.parquet(str(tmp_path / name.replace(" ", "_")))
        return spark.read.parquet(str(tmp_path / name.replace(" ", "_")))

    now = {r[0]: r for r in rows}
    learned = any(r[2] and r[1] and zlib.crc32(str(r[0]).encode()) % 4 != 2 for r in rows)
    assert learned
    got = held(names[0], docs)
    now = {d: r for d, r in now.items() if r[1] and language._LETTER.search(r[1])}
    after = {r["doc_id"]: r for r in got.collect()}
    assert set(after) == set(now) and all(r["text"] == now[d][1] and r["source"] == now[d][3] for d, r in after.items())
    assert {r["lang"] for r in after.values()} <= {r[2] for r in rows if r[2]}
    now = {d: tuple(r) for d, r in after.items()}
    got = held(names[1], got)
    classes = brute_classes(list(now.values()))
    now = {d: r for d, r in now.items() if classes[d][0] == d}
    assert {r["doc_id"]: tuple(r) for r in got.collect()} == now
    got = held(names[2], got)
    removed = brute_repeats(list(now.values()), corpus_pipeline.PASSAGE)
    after = {r["doc_id"]: r for r in got.collect()}
    assert set(after) == {d for d in now if removed[d][1] < removed[d][0]}
    assert all(after[d]["text"] == now[d][1] for d in after if removed[d][1] == 0)
    assert all(len(after[d]["text"].encode()) <= removed[d][0] - removed[d][1] <= len(after[d]["text"].encode()) + 6 * removed[d][2] for d in after)
    assert all(after[d]["n_chars"] == len(after[d]["text"]) for d in after) and any(removed[d][1] for d in after)
    got2 = held(names[3], got)
    hits = brute_contamination([tuple(r) for r in after.values()], benchmark)
    assert {r["doc_id"] for r in got2.collect()} == {d for d in after if not hits[d][4]} and any(h[4] for h in hits.values())
    last = held(names[4], got2)
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    text = {r["doc_id"]: r["text"] for r in got2.collect()}
    assert {r["doc_id"]: (r["ids"], r["decoded"]) for r in last.collect()} == {d: (library.encode(t), library.decode(library.encode(t))) for d, t in text.items()}
    whole = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert whole == {r["doc_id"]: r["ids"] for r in last.collect()}
