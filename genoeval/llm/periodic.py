"""Periodic runs of words: maximal stretches that repeat a smallest period at least three times.

Occurrences of blocks inside a text are found as in internal pattern matching. Prefix doubling gives each place a name
for its next 1, 2, 4, ... words, and the suffix array; the suffixes that start with a block of 2^k words are an interval
of it. A run with a period q from L = 2^k to 2 L - 1 holds an aligned block of L words together with its copy q words
on. So each block asks a wavelet tree over the suffix array for the occurrences that start in the neighbouring window
[b + L, b + 2 L): how many there are, and the first, second and last of them (range successor). As the window is no longer
than the block they form an arithmetic progression. One or two give the candidates q themselves. Three and more mean
that block and occurrences lie in stretches with the progression's difference as period; a longer period must carry
one stretch onto the other, so only the distances of their starts and of their ends are candidates. Candidates are
extended both ways over the names, which makes them maximal, and the least period of a stretch is kept.

Texts are independent of each other: a slice of many goes through the same numpy steps at once, with names that never
agree between texts. A text is worked on whole, so memory follows the longest one: about 8 log2(words) bytes a word.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: A run has this many words and this many periods at least.
WORDS, PERIODS = 24, 3
#: Blocks start this far apart at least: any run of ``WORDS`` words still holds one with its copy.
STRIDE = 8
#: Words of texts that are worked on at once (or one text, where that is longer).
SLICE = 1 << 16

_SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


class Names:
    """Suffix array of ``symbols`` and, for each k, the place in it at which the suffixes alike in 2^k symbols begin."""

    def __init__(self, symbols: np.ndarray):
        n = self.n = len(symbols)
        self.sa = np.argsort(symbols, kind="stable").astype(np.int32)
        self.levels: list[np.ndarray] = []
        rank = np.empty(n, np.int32)
        open_, key = np.arange(n), symbols[self.sa]
        while True:
            new = np.ones(len(open_), bool)
            new[1:] = key[1:] != key[:-1]
            head = np.flatnonzero(new)
            size = np.diff(np.append(head, len(open_)))
            rank[self.sa[open_]] = np.repeat(open_[head], size)
            alike = np.repeat(size > 1, size)
            if not alike.any():
                return
            self.levels.append(rank.copy())
            open_ = open_[alike]
            at, step = self.sa[open_].astype(np.int64), 1 << (len(self.levels) - 1)
            after = at + step
            second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
            key = rank[at].astype(np.int64) * (n + 1) + second + 1
            order = np.argsort(key, kind="stable")
            self.sa[open_], key = at[order], key[order]

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Symbols alike from i and from j on (i < j)."""
        length = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            a, b = i + length, np.minimum(j + length, self.n - 1)
            length += np.where((j + length < self.n) & (self.levels[k][np.minimum(a, self.n - 1)] == self.levels[k][b]), 1 << k, 0)
        return length

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Symbols alike before i and before j (i < j)."""
        length = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            a = i - length - (1 << k)
            same = self.levels[k][np.maximum(a, 0)] == self.levels[k][np.maximum(j - length - (1 << k), 0)]
            length += np.where((a >= 0) & same, 1 << k, 0)
        return length


class WaveletTree:
    """Order statistics of intervals of an array of distinct numbers below its length, a bit a level."""

    def __init__(self, values: np.ndarray):
        self.n, self.zeros = len(values), []
        for bit in range(max(1, self.n.bit_length()) - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            sums = np.zeros(self.n + 1, np.int32)
            np.cumsum(~one, out=sums[1:])
            self.zeros.append((bit, sums))
            values = np.concatenate([values[~one], values[one]])

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of [lo, hi) are less than x."""
        all_, x = np.where(x >= self.n, hi - lo, -1), np.minimum(x, self.n - 1)
        count = np.zeros(len(lo), np.int64)
        for bit, zeros in self.zeros:
            a, b, one = zeros[lo], zeros[hi], (x >> bit & 1).astype(bool)
            count += np.where(one, b - a, 0)
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b)
        return np.where(all_ >= 0, all_, count)

    def nth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th least value of [lo, hi), from 0."""
        value = np.zeros(len(lo), np.int64)
        for bit, zeros in self.zeros:
            a, b = zeros[lo], zeros[hi]
            one = k >= b - a
            k = np.where(one, k - (b - a), k)
            value |= np.where(one, 1 << bit, 0)
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b)
        return value


def candidates(names: Names, tree: WaveletTree, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) of every copy of a block of 2^k words that may tell a period from 2^k to 2^(k+1) - 1."""
    length = 1 << k
    b = np.arange(0, names.n - length, max(length, STRIDE), dtype=np.int64)
    lo = names.levels[k][b].astype(np.int64)
    hi = lo + np.bincount(names.levels[k], minlength=names.n)[lo]
    some = hi - lo > 1
    b, lo, hi = b[some], lo[some], hi[some]
    before = tree.below(lo, hi, b + length)
    count = tree.below(lo, hi, b + 2 * length) - before
    some = count > 0
    b, lo, hi, before, count = b[some], lo[some], hi[some], before[some], count[some]
    first = tree.nth(lo, hi, before)
    two = count > 1
    second = tree.nth(lo[two], hi[two], before[two] + 1)
    pair = count[two] == 2
    start, step = [b[~two], b[two][pair], b[two][pair]], [(first - b)[~two], (first - b)[two][pair], (second - b[two])[pair]]
    # Progressions: the block's stretch of period ``gap``, and that of its occurrences.
    own, other, gap = b[two][~pair], first[two][~pair], (second - first[two])[~pair]
    left = other - names.behind(other, other + gap) - (own - names.behind(own, own + gap))
    right = other + names.ahead(other, other + gap) - (own + names.ahead(own, own + gap))
    for q in (left, right):
        fits = (q >= length) & (q < 2 * length) & (own + q < names.n)
        start.append(own[fits])
        step.append(q[fits])
    return np.concatenate(start), np.concatenate(step)


def runs(symbols: np.ndarray) -> np.ndarray:
    """(start, end, period) of all runs, by start, then period."""
    found = [np.zeros((0, 3), np.int64)]
    if len(symbols) >= WORDS:
        names = Names(symbols)
        tree = WaveletTree(names.sa.astype(np.int64)) if names.levels else None
        for k in range(len(names.levels)):
            b, q = candidates(names, tree, k)
            start, end = b - names.behind(b, b + q), b + q + names.ahead(b, b + q)
            long = end - start >= np.maximum(WORDS, PERIODS * q)
            found.append(np.stack([start[long], end[long], q[long]], axis=1))
    out = np.concatenate(found)
    out = out[np.lexsort((out[:, 2], out[:, 1], out[:, 0]))]
    least = np.ones(len(out), bool)  # a stretch's own period is its least, any other one a multiple
    least[1:] = (out[1:, :2] != out[:-1, :2]).any(axis=1)
    out = out[least]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def with_period(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """One in ten texts, by the CRC-32 of the decimal id, repeats a few of its words up to its end; see the contract."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def _reports(ids: list[int | None], texts: list[list[bytes]]) -> Iterator[tuple]:
    """One row a text: runs are looked for in all texts at once."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    symbols = np.empty(offsets[-1], np.int64)
    used = 0
    for words, at in zip(texts, offsets, strict=False):
        number: dict[bytes, int] = {}
        symbols[at : at + len(words)] = [number.setdefault(w, len(number) + used) for w in words]
        used += len(number)
    found = runs(symbols)
    owner = np.searchsorted(offsets, found[:, 0], side="right") - 1
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    for i, (doc_id, words) in enumerate(zip(ids, texts, strict=True)):
        mine = (found[first[i] : first[i + 1]] - [offsets[i], offsets[i], 0]).tolist()
        best: tuple = (None,) * 4
        if mine:
            top = mine[0]
            for r in mine[1:]:  # exact comparison of length / period; earlier ones win ties
                if (r[1] - r[0]) * top[2] > (top[1] - top[0]) * r[2]:
                    top = r
            length = top[1] - top[0]
            best = (top[0], length, top[2], 1000 * length // top[2])
            dropped = np.zeros(len(words) + 1, np.int64)
            for s, e, q in mine:
                dropped[s + q] += 1
                dropped[e] -= 1
            words = [words[j] for j in np.flatnonzero(np.cumsum(dropped[:-1]) == 0).tolist()]
        listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in mine)
        yield (doc_id, len(mine), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest())


def _tasks(planted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _SCHEMA.split(", ")]
        kinds = [pa.string() if c.endswith(" string") else pa.int64() for c in _SCHEMA.split(", ")]
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, rows = batch.column(0).to_pylist(), []
            some: list[list[bytes]] = []
            held, at = 0, 0
            for i, text in enumerate(batch.column(1)):
                words = (text.as_py() or "").encode().split()
                some.append(with_period(words, ids[i]) if planted else words)
                held += len(words)
                if held >= SLICE or i == len(ids) - 1:
                    rows += _reports(ids[at : i + 1], some)
                    some, held, at = [], 0, i + 1
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return run


def periodic_runs(docs: DataFrame, planted: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs of each text: their number, the one of greatest exponent, digests of all runs and of the text without repeats.

    Words are what stands between ASCII white space, compared byte by byte. ``planted`` gives one text in ten a period
    first. Null and empty texts have no words and no runs; a row without an id is never planted; repeated rows are rows
    of their own; other columns are not looked at.
    """
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(_tasks(planted), _SCHEMA)
