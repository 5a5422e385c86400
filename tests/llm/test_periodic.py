"""Periodic runs against every period tried at every place."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from genoeval.llm import periodic

SCHEMA = "doc_id long, text string"


def brute(words):
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def report(doc_id, text, planted):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    if planted and words and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g, n = zlib.crc32(str(doc_id).encode()) // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < e for s, e, q in found)]
    best = [None] * 4
    if found:
        from fractions import Fraction

        s, e, q = min(found, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]))
        best = [s, e - s, q, 1000 * (e - s) // q]
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
    return (doc_id, len(found), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def some_text(rng):
    n, k = rng.choice([1, 23, 24, 25, 60, 150]), rng.choice([1, 2, 3, 40])
    words = [f"w{rng.randrange(k)}" for _ in range(n)]
    for _ in range(rng.randrange(3)):
        a, p = rng.randrange(n), rng.randrange(1, n // 3 + 2)
        for i in range(a, min(n, a + p * rng.randrange(2, 7) + rng.randrange(p))):
            words[i] = words[a + (i - a) % p]
    return rng.choice([" ", "\n", " \t "]).join(words)


@pytest.mark.parametrize("planted", [False, True])
def test_texts(spark, planted):
    rng = random.Random(5)
    rows = [(i, some_text(rng)) for i in range(400)]
    rows += [(None, None), (7, None), (8, ""), (9, " \n\t\x0b\x0c\r "), (10, "a\u00a0b " * 30), (None, "x " * 40), (11, "x " * 40), (11, "x " * 40), (12, "\x1fq \x1fq\u2003 " * 20)]
    got = [tuple(r) for r in periodic.periodic_runs(spark.createDataFrame(rows, SCHEMA).repartition(3), planted).collect()]
    assert sorted(got, key=repr) == sorted((report(*r, planted) for r in rows), key=repr)


def test_words_with_many_periods():
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    nested = (([0] * 30 + [1]) * 6 + [2]) * 5
    thue = [bin(i).count("1") % 2 for i in range(2048)]
    for words in (b, nested, thue, [0] * 500, ([0] * 9 + [1]) * 60, list(range(100)) * 3, list(range(100)) * 3 + list(range(99))):
        assert [tuple(r) for r in periodic.runs(np.array(words)).tolist()] == brute(words)


def test_long_texts(spark):
    rows = [(1, "a b c " * 60_000), (2, " ".join(map(str, range(150_000)))), (3, " ".join(map(str, list(range(30_000)) * 4)))]
    out = {r["doc_id"]: r for r in periodic.periodic_runs(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [out[i]["n_runs"] for i in (1, 2, 3)] == [1, 0, 1]
    assert (out[1]["period"], out[1]["exponent_milli"], out[3]["period"], out[3]["length"]) == (3, 60_000_000, 30_000, 120_000)


def test_more_columns_and_no_rows(spark):
    docs = spark.createDataFrame([("s", 4, "z " * 30, 1)], "start string, doc_id int, text string, period int")
    assert periodic.periodic_runs(docs).first()["length"] == 30
    assert periodic.periodic_runs(docs.limit(0)).count() == 0
