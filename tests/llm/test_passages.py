"""Repeated passages of over 50 words that are shorter than op9's 400 bytes."""

import random
from collections import Counter

import pytest
from test_llm import SCHEMA, brute_repeats

from genoeval.llm import suffix_dedup
from genoeval.llm.queries import QUERIES

NAMES = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def brute_passages(rows, length, words):
    texts = [(d, (t or "").encode()) for d, t, *_ in rows]
    seen = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = {}
    for d, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs, at = [], 0
        while (a := gone.find(1, at)) >= 0:
            at = gone.find(0, a) if gone.find(0, a) >= 0 else len(t)
            inner = t[a:at].split()
            # A word that the run cuts in two is not whole.
            cut = int(a > 0 and not t[a - 1 : a].isspace() and not t[a : a + 1].isspace()) + int(at < len(t) and not t[at : at + 1].isspace() and not t[at - 1 : at].isspace())
            if len(inner) - cut > words:
                runs.append(at - a)
        out[d] = (len(runs), sum(runs))
    return out


def some_texts():
    rng = random.Random(17)
    word = lambda: "".join(rng.choice("abcdefghié") for _ in range(rng.randint(3, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    short, long, few = prose(52), prose(120), " ".join(word() * 5 for _ in range(14))
    marks = " | ".join(word() for _ in range(40))
    assert 256 <= len(short.encode()) < 400 < len(long.encode()) and 256 <= len(few.encode()) and 256 <= len(marks.encode()) < 400
    texts = [None, "", short, prose(30), long, long + " x", f"{long}{prose(9)} {long}"]
    for p in (short, few, marks, long, long[5:], short[:-1]):
        texts += [f"{prose(rng.randint(0, 60))} {p} {prose(rng.randint(0, 60))}" for _ in range(3)]
    return [(i, t, None, None, 0) for i, t in enumerate(texts)]


def test_query_finds_short_passages(spark, tmp_path):
    """Planted passages of 52 words, under 400 bytes: no byte of theirs is cut by contract, and every text with one says so."""
    rows = some_texts()
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in QUERIES["op9_suffix_array_dedup"](spark, str(tmp_path)).collect()}
    assert {d: tuple(r[n] for n in NAMES) for d, r in got.items()} == brute_repeats(rows, 400)
    expected = brute_passages(rows, suffix_dedup.PASSAGE, suffix_dedup.PASSAGE_WORDS)
    assert {d: (r["n_passages"], r["n_passage_bytes"]) for d, r in got.items()} == expected
    assert sum(r["n_passages"] > 0 and r["n_removed"] == 0 for r in got.values()) >= 6 and sum(r["n_passages"] == 0 for r in got.values()) >= 6


@pytest.mark.parametrize("length,passage,gram,cover", [(100, 40, 16, False), (60, 60, 20, False), (100, 40, 16, True)])
def test_both_lengths(spark, length, passage, gram, cover):
    """Long strings looked for inside short ones' stretches: periodic texts, stretches beside one another, rows twice, rows without an id."""
    rng = random.Random(23)
    noise = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    parts = [noise(n) for n in (passage - 1, passage, passage + 7, length - 1, length, length + 1, 3 * length)] + ["ab" * length, "z" * (length + 30), "Der " * length]
    texts = ["".join(rng.choice(parts) if rng.random() < 0.6 else noise(rng.randint(1, length)) for _ in range(rng.randint(1, 6))) for _ in range(40)] + [None, "", parts[4], "é" * length]
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    for given in (rows, [*rows, rows[3], rows[7], rows[7]]):
        expected, found = brute_repeats(given, length), brute_passages(given, passage, suffix_dedup.PASSAGE_WORDS)
        without = [(None if d % 5 == 0 else d, *r) for d, *r in given]
        got = suffix_dedup.remove_repeats(spark.createDataFrame(without, SCHEMA).repartition(3), length=length, gram=gram, cover=cover, passage=passage).collect()
        rest = [(None if d % 5 == 0 else d, *expected[d], *found[d]) for d, *_ in given]
        assert Counter((r["doc_id"], *(r[n] for n in NAMES), r["n_passages"], r["n_passage_bytes"]) for r in got) == Counter(rest)
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA), length=length, gram=gram, passage=length + 1)
