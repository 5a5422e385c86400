"""The toxicity network: gradients, held-out accuracy, odd rows."""

import random
import zlib

import numpy as np
import pytest

from genoeval.llm import toxicity

DOCS, LABELS = "doc_id long, text string, lang string", "doc_id long, quality int, toxic int"


def test_gradients():
    """Every weight's gradient against a difference quotient, with sequences of all lengths."""
    rng = np.random.default_rng(0)
    network = toxicity.Network.fresh("abcdefgh", ["abc", "de"])
    network.weights = {k: w.astype(np.float64) for k, w in network.weights.items()}
    words, ids, lengths, y = ["hgfedcba", "abc", "fgh", "de", "a"], rng.integers(0, 5, (7, 4)), np.array([7, 5, 3, 0]), np.array([1, 0, 1, 0])

    def loss():
        z = network.logits(network.inputs(words), ids, lengths)
        return float((np.log1p(np.exp(z)) - y * z).sum())

    z = network.logits(network.inputs(words, True), ids, lengths, True)
    grads = network.gradients(1 / (1 + np.exp(-z)) - y, len(words))
    for name, w in network.weights.items():
        for _ in range(3):
            at = tuple(rng.integers(0, n) for n in w.shape)
            old, each = w[at], []
            for step in (1e-4, -1e-4):
                w[at] = old + step
                each.append(loss())
            w[at] = old
            assert (each[0] - each[1]) / 2e-4 == pytest.approx(float(grads[name][at]), rel=1e-3, abs=1e-5), name


def test_windows_cover_texts():
    for n in (0, 1, toxicity.WINDOW, toxicity.WINDOW + 1, 1000):
        starts = toxicity.window_starts(n)
        assert starts[0] == 0 and set(range(n)) <= {i for s in starts for i in range(s, s + toxicity.WINDOW)}
        assert all(b - a < toxicity.WINDOW for a, b in zip(starts, starts[1:], strict=False)) and (n <= toxicity.WINDOW or starts[-1] < n)


def some_docs(rng, count):
    parts = ["lo", "ra", "min", "te", "su", "ve", "na", "pol"]
    rows = []
    for i in range(count):
        words = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(20, 200))]
        toxic = rng.random() < 0.4
        if toxic:
            for _ in range(2 + len(words) // 30):
                words[rng.randrange(len(words))] = rng.choice(["zorgak", "Blixt", "quwefuk" + rng.choice(parts)])
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def learned(spark):
    rows = some_docs(random.Random(3), 600)
    docs = spark.createDataFrame([(i, t, "en") for i, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, 1, k) for i, _, k in rows] + [(None, 1, 1), (5000, 0, 0), (7, 1, None)], LABELS)
    return rows, docs, labels, toxicity.fit(docs, labels.filter(~toxicity.held_out()))


def test_held_out_accuracy(spark, learned):
    rows, docs, labels, model = learned
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, model).collect()}
    unseen = [(i, k) for i, _, k in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    right = sum((got[i]["score"] >= toxicity.LIMIT) == (k == 1) for i, k in unseen)
    assert len(unseen) > 150 and right / len(unseen) > 0.95
    assert model == toxicity.fit(docs.repartition(5), labels.filter(~toxicity.held_out()).repartition(3))


def test_odd_rows(spark, learned):
    _, docs, _, model = learned
    long = " ".join(["lora minte"] * 40_000)
    rows = [(1, None), (2, ""), (3, "!! 42 ..."), (4, long), (5, long + " zorgak Blixt zorgak"), (6, "zorgak blixt zorgak lo ra"), (6, "zorgak blixt zorgak lo ra"), (None, "lo ra"), (8, "x" * 100_000)]
    out = toxicity.toxicity(spark.createDataFrame([(i, t, i, 1.0) for i, t in rows], "doc_id long, text string, row long, score double"), model).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    by_id = {r["doc_id"]: r["score"] for r in out}
    assert by_id[1] == by_id[2] and by_id[5] > 0.7 and by_id[6] > 0.7 and by_id[4] < 0.7 and len({r["score"] for r in out if r["doc_id"] == 6}) == 1
    assert toxicity.toxicity(docs.limit(0), model).count() == 0


def test_score_does_not_depend_on_other_rows(learned):
    """A text alone, first, last and among others, in batches of any size, has one score to the last bit."""
    rows, _, _, model = learned
    scorer = toxicity.unpacked(model)
    texts = [toxicity.words_of(t) for t in ("zorgak blixt zorgak lo ra", "lo", "", rows[0][1], rows[1][1] * 3)]
    found = [set() for _ in texts]
    for n in [*range(20), 33, 100, 599]:
        others = [toxicity.words_of(r[1]) for r in rows[:n]]
        for given, at in ((others + texts, n), (texts + others, 0)):
            scorer.forget()
            for k, score in enumerate(scorer.score(given)[at : at + len(texts)].tolist()):
                found[k].add(score)
    for k, t in enumerate(texts):
        scorer.forget()
        found[k].add(float(scorer.score([t])[0]))
    assert [len(x) for x in found] == [1] * len(texts)


def test_one_label_or_none(spark):
    docs = spark.createDataFrame([(1, "a b", "en"), (2, None, "en")], DOCS)
    for labels, score in (([], 0.0), ([(1, 1, 1)], 1.0), ([(2, 1, 0)], 0.0), ([(9, 1, 1)], 0.0)):
        got = toxicity.predict_toxicity(docs, spark.createDataFrame(labels, LABELS).withColumn("doc_id", toxicity.F.col("doc_id")))
        assert {r["score"] for r in got.collect()} <= {score, 0.0} and got.columns == ["doc_id", "held_out", "score", "predicted"]
