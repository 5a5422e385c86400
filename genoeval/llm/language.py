"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over labelled sample text. A text is parsed against each automaton
into longest matches; the language whose text explains it in the fewest phrases (per symbol) wins.

Whole texts are parsed, whatever their length. Pieces of ``PIECE`` symbols go in lockstep, all pieces of a slice at once:
one table lookup a symbol moves every piece to its next state and adds the phrases that ended. A piece whose
predecessor ended within a phrase is then parsed again from that state, up to the symbol where both parses meet, so
phrases run on from piece to piece as in a parse from left to right.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranges

#: The bounded training sample: languages (the most frequent), rows of each, and code points of a row that may be
#: drawn. Rows enter whole; a language whose rows are all longer gives its shortest one.
LANGUAGES, ROWS, LONGEST = 64, 32, 8_192
#: Symbols parsed in one piece.
PIECE = 128
#: Code points that are parsed at once (or one text, where that is longer).
SLICE = 1 << 20
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_GAP = 32


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, and offsets."""
    low = [t.lower() for t in texts]
    offsets = np.zeros(len(low) + 1, np.int64)
    np.cumsum([len(t) for t in low], out=offsets[1:])
    return np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32), offsets


_ALPHA: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _ALPHA:
        _ALPHA.append(np.fromiter((chr(c).isalpha() for c in range(0x110001 - 1)), bool, 0x110000))
    return _ALPHA[0]


def _without_gaps(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the letters of all texts, anything between words as one space, and offsets by text.

    Bytes are the alphabet of every script, so no letter shares a symbol with another one.
    """
    codes, offsets = _codes(texts)
    gap = ~_letters()[codes]
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    keep[offsets[:-1][offsets[:-1] < len(codes)]] = True
    kept = np.where(gap, np.uint32(_GAP), codes)[keep]
    sums = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(keep * (1 + (codes >= 0x80).astype(np.int8) * ~gap + (codes >= 0x800) * ~gap + (codes >= 0x10000) * ~gap), out=sums[1:])
    return np.frombuffer(kept.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8), sums[offsets]


class Alphabet:
    """Symbols of one language: 0 = between words, 1 = a byte that its sample never has, then its own bytes."""

    def __init__(self, data: np.ndarray):
        own = np.setdiff1d(np.unique(data), [_GAP])
        self.table = np.ones(256, np.uint16)
        self.table[_GAP] = 0
        self.table[own] = np.arange(2, 2 + len(own))
        self.size = 2 + len(own)


def automaton_table(symbols: list[int], size: int) -> np.ndarray:
    """Step table of the suffix automaton of ``symbols``: [state * (size + 1) + symbol] = next state * 4 + phrases ended.

    A symbol that does not continue the match ends a phrase and starts the next one; one that the text never
    had is a phrase of its own. Symbol ``size`` is padding: it ends what is open and stays at the root.
    """
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    width = size + 1
    table = np.empty((len(moves), width), np.int32)
    root = [moves[0].get(c) for c in range(size)]
    table[:, :size] = [2 * 1 if r is None else r * 4 + 1 for r in root]  # a broken match, then the symbol anew or alone
    table[0, :size] = [1 if r is None else r * 4 for r in root]
    table[:, size], table[0, size] = 1, 0
    count = [len(m) for m in moves]
    c, t = (np.fromiter(chain.from_iterable(x), np.int32, sum(count)) for x in (moves, (m.values() for m in moves)))
    table[np.repeat(np.arange(len(moves)), count), c] = t * 4
    return table.ravel()


def phrases(symbols: np.ndarray, offsets: np.ndarray, table: np.ndarray, size: int) -> np.ndarray:
    """Phrases of each text, parsed from left to right against one automaton's table."""
    counts = np.diff(offsets)
    pieces = -(-counts // PIECE)
    owner, step = ranges(pieces)
    start = offsets[owner] + step * PIECE
    left = np.minimum(PIECE, offsets[owner + 1] - start)
    # Longest first, so that the pieces still open are a prefix; place[p] is where piece p went.
    order = np.argsort(-left, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    start, left = start[order], left[order]
    if not len(order):
        return np.zeros(len(counts), np.int64)
    width = np.int32(size + 1)
    seen = np.zeros((PIECE, len(order)), np.int32)
    state, total = np.zeros(len(order), np.int32), np.zeros(len(order), np.int64)
    for i in range(int(left[0])):
        n = int(np.searchsorted(-left, -i, side="left"))  # pieces longer than i
        v = table[state[:n] * width + symbols[start[:n] + i]]
        seen[i, :n] = v
        total[:n] += v & 3
        state[:n] = v >> 2
    # Pieces go on from where their predecessors end.
    later = np.flatnonzero(step > 0)
    later = later[state[place[later - 1]] > 0]
    while len(later):
        now, at, i = state[place[later - 1]], place[later], 0
        on, changed = np.arange(len(later)), np.zeros(len(later), bool)
        while len(on):
            p = at[on]
            v = table[now[on] * width + symbols[start[p] + i]]
            old = seen[i, p]
            total[p] += (v & 3) - (old & 3)
            seen[i, p] = v
            now[on] = v >> 2
            i += 1
            apart, open_ = (v >> 2) != (old >> 2), i < left[p]
            changed[on[apart & ~open_]] = True
            on = on[apart & open_]
        state[at[changed]] = now[changed]
        later = later[changed] + 1
        later = later[later < len(step)]
        later = later[step[later] > 0]
    last = np.cumsum(pieces)[pieces > 0] - 1
    out = np.bincount(owner, total[place], len(counts)).astype(np.int64)
    out[pieces > 0] += state[place[last]] > 0
    return out


class Model:
    """Automata of the languages in ``samples`` (name, text); built once in each Python worker."""

    def __init__(self, samples: list[tuple[str, str]]):
        self.names = sorted({n for n, _ in samples})
        texts = [_without_gaps([" ".join(t for n, t in samples if n == name)])[0] for name in self.names]
        alphabets = [Alphabet(data) for data in texts]
        self.parts = [(a.table, automaton_table(a.table[data].tolist(), a.size), a.size) for a, data in zip(alphabets, texts, strict=True)]

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and score of each text. Score: by how much of its phrases the best language beats the next one."""
        letters, offsets = _without_gaps(texts)
        counts = np.zeros((len(texts), len(self.names)), np.int64)
        for k, (symbols, table, size) in enumerate(self.parts):
            counts[:, k] = phrases(symbols[letters], offsets, table, size)
        out = []
        for text, n in zip(texts, counts, strict=True):
            if not self.names or not _LETTER.search(text):
                out.append((UNKNOWN, 0.0))
                continue
            order = np.argsort(n, kind="stable")
            best, rest = int(n[order[0]]), int(n[order[1]]) if len(order) > 1 else 0
            out.append((self.names[order[0]], 1.0 if len(order) == 1 else (rest - best) / rest if rest else 0.0))
        return out


_MODELS: dict[int, Model] = {}


def training_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> list[tuple[str, str]]:
    """Labelled texts of at most ``ROWS`` rows of each of the ``LANGUAGES`` most frequent languages, whole.

    The rows are those with the least hash of their id among those of ``LONGEST`` code points at most, taken by a
    threshold that follows each language's count, so nothing is sorted or shuffled but the counts.
    """
    labelled = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 40)).alias("h")).filter("lang is not null and text is not null")
    short = F.char_length("text") <= LONGEST
    counted = labelled.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(short).alias("short"))
    counts = {r["lang"]: r for r in counted.orderBy(F.col("n").desc(), "lang").limit(LANGUAGES).collect()}
    if not counts:
        return []
    by_lang = lambda value: F.try_element_at(F.create_map(*[x for k, r in counts.items() for x in (F.lit(k), F.lit(value(r)))]), F.col("lang"))
    bound = by_lang(lambda r: min(1 << 40, int((1 << 40) * 0.8 * ROWS / max(1, r["short"]))))
    drawn = labelled.filter(F.col("lang").isin(*counts))
    rows = drawn.filter(short & (F.col("h") < bound)).groupBy("lang", "h").agg(F.min("text").alias("text")).collect()  # an id counts once
    out: dict[str, list[tuple[int, str]]] = {}
    for r in rows:
        out.setdefault(r["lang"], []).append((r["h"], r["text"]))
    if absent := [k for k in counts if k not in out]:  # no short row, or none under the threshold
        shortest = drawn.filter(F.col("lang").isin(*absent)).groupBy("lang").agg(F.min_by("text", F.struct(F.char_length("text"), "h", "text")).alias("text"))
        out |= {r["lang"]: [(0, r["text"])] for r in shortest.collect()}
    return [(k, t) for k in sorted(out) for _, t in sorted(out[k])[:ROWS]]


def _predicted(samples: list[tuple[str, str]], place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(tuple(samples))
        if key not in _MODELS:
            _MODELS.clear()
            _MODELS[key] = Model(samples)
        model = _MODELS[key]
        for batch in batches:
            texts = [t or "" for t in batch.column(0).field(place).to_pylist()]
            done: list[tuple[str, float]] = []
            at = 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size + len(texts[to]) <= SLICE):
                    size += len(texts[to])
                    to += 1
                done += model.predict(texts[at:to])
                at = to
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.float64())], names=["row", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs``'s id and text columns' rows as (row, lang_pred, score); ``row`` is a struct of all of ``docs``' columns.

    ``training`` has the labelled rows (null labels and texts are left out; of very many labels the ``LANGUAGES`` most
    frequent are learned). A text that is null or has no letter is
    ``und`` with score 0, as is every text when nothing was learned. Ties go to the language first by name. Repeated
    rows and ids are rows of their own.
    """
    samples = training_sample(training, id_col, text_col, lang_col)
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(_predicted(samples, docs.columns.index(text_col)), f"row {kind}, lang_pred string, score double")


def held_out(id_col: str = "doc_id") -> F.Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict_languages(docs: DataFrame) -> DataFrame:
    learned = docs.filter(~held_out())
    narrow = docs.select("doc_id", "text")
    found = identify(narrow, learned)
    return found.select(F.col("row.doc_id").alias("doc_id"), held_out("row.doc_id").alias("held_out"), "lang_pred", "score")
