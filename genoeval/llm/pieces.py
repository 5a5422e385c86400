"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A batch's distinct units (a run of spaces and what follows it) lie in one flat symbol array. A round looks up the
rank of every adjacent pair, takes the least rank of each unit, merges all its leftmost non-overlapping places at
once and compacts the array, until no unit has a pair left. Where a merge could bring up a pair that ranks as well
or better, or where scores tie, only the leftmost place is merged in that round, as the library's queue would.

Units never share a piece: no piece holds a space after another character, nor a line feed. That is checked when a
model is read; a model that fails the check is encoded a text at a time, as one unit.

What a task remembers of a unit are its ids as bytes; ids, decimals and decoded text are spelled from these a text at a
time, so a worker's memory is that of the model, ``CACHE_MOST`` short byte strings and ``SLICE`` bytes of text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import list_array, text_slices

SPACE = "▁"
#: Units remembered by a task before it starts over.
CACHE_MOST = 300_000
#: Bytes of text that are split into units at once (or one text, where that is longer).
SLICE = 1 << 18
#: Ids that are spelled at once.
_SPELLED = 1 << 16
_NONE = np.int32((1 << 31) - 1)


class PieceModel:
    """Tables of one model file: symbols, pair ranks and the byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.n = n
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        bytes_of = {i: bytes([b]) for b, i in self.byte_ids.items()}
        self.decoded = [bytes_of.get(i) or p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]
        self.decimal = [b"%d," % i for i in range(n)]
        self.unknown = model.unk_id()
        normal = [i for i in range(n) if not special[i]]
        self.symbol = {self.pieces[i]: i for i in normal}
        scores = {i: model.get_score(i) for i in normal}
        order = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        tied: set[float] = set()
        seen: set[float] = set()
        for s in scores.values():
            (tied if s in seen else seen).add(s)
        for i in normal:  # characters that only occur inside pieces are symbols as well
            for c in self.pieces[i]:
                self.symbol.setdefault(c, len(self.symbol) + n)
        self.of_code = -1 - np.arange(0x110000, dtype=np.int64)
        for c, i in self.symbol.items():
            if len(c) == 1:
                self.of_code[ord(c)] = i
        self.letters = {v: k for k, v in self.symbol.items() if v >= n}
        self.size = 1 << 18
        keys, ranks, made = [], [], []
        careful = np.zeros(self.size, bool)
        rank_of = {i: order[scores[i]] for i in normal}
        for i in normal:
            p = self.pieces[i]
            careful[i] |= scores[i] in tied
            for cut in range(1, len(p)):
                a, b = self.symbol.get(p[:cut]), self.symbol.get(p[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.size + b)
                    ranks.append(rank_of[i])
                    made.append(i)
                    for x in (a, b):
                        careful[x] |= rank_of[i] <= rank_of.get(x, -1)
        by = np.argsort(np.array(keys, np.int64))
        self.keys, self.ranks, self.made = np.array(keys, np.int64)[by], np.array(ranks, np.int64)[by], np.array(made, np.int64)[by]
        self.careful = careful
        plain = all(SPACE not in p.lstrip(SPACE) and "\n" not in p for p in self.symbol)
        self.unit = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n" if plain else "(?s).+")

    def units(self, text: str) -> list[str]:
        return self.unit.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def merge(self, units: list[str]) -> list[bytes]:
        """Ids of each unit after all merges, as bytes of 32-bit numbers."""
        symbols = self.of_code[np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)]
        owner = np.repeat(np.arange(len(units), dtype=np.int32), [len(u) for u in units])
        done = [b""] * len(units)
        rank, made = self._lookup(symbols[:-1], symbols[1:], owner[1:] == owner[:-1])
        rank, made = np.append(rank, _NONE), np.append(made, 0)
        while len(symbols):
            start = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            least = np.minimum.reduceat(rank, start)
            length = np.diff(np.append(start, len(symbols)))
            best = np.repeat(least, length)
            gone = best == _NONE
            ended = np.flatnonzero(least == _NONE)
            flat, ends = symbols[gone], np.cumsum(length[ended]).tolist()
            raw, outside = flat.astype(np.int32).tobytes(), (flat < 0) | (flat >= self.n)
            strange = set(owner[gone][outside].tolist())
            for s, z, u in zip([0, *ends], ends, owner[start[ended]].tolist(), strict=False):
                done[u] = self._known(flat[s:z].tolist()) if u in strange else raw[4 * s : 4 * z]
            place = np.flatnonzero((rank == best) & ~gone)
            if len(place):
                by = owner[place]
                new_unit = np.concatenate([[True], by[1:] != by[:-1]])
                run = new_unit.copy()
                run[1:] |= np.diff(place) > 1
                index = np.arange(len(place))
                leftmost = (index - np.maximum.accumulate(np.where(run, index, 0))) % 2 == 0
                risky = self.careful[made[place]]
                if risky.any():  # one careful merge makes its whole unit careful in this round
                    group = np.cumsum(new_unit) - 1
                    units_at_risk = np.zeros(group[-1] + 1, bool)
                    units_at_risk[group[risky]] = True
                    leftmost = np.where(units_at_risk[group], new_unit, leftmost)
                place = place[leftmost]
                symbols[place] = made[place]
                gone[place + 1] = True
            keep = ~gone
            to = np.cumsum(keep) - 1
            symbols, owner, rank, made = symbols[keep], owner[keep], rank[keep], made[keep]
            # Only pairs beside a merge have changed.
            if len(place):
                at = to[place]
                mark = np.zeros(len(symbols), bool)
                mark[at] = mark[np.maximum(at - 1, 0)] = True
                touched = np.flatnonzero(mark)
                rank[touched], made[touched] = _NONE, 0
                touched = touched[touched < len(symbols) - 1]
                rank[touched], made[touched] = self._lookup(symbols[touched], symbols[touched + 1], owner[touched] == owner[touched + 1])
        return done

    def _lookup(self, left: np.ndarray, right: np.ndarray, together: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of pairs, ``_NONE`` where they cannot merge."""
        pair = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        usable = (self.keys[at] == pair) & (left >= 0) & (right >= 0) & together
        return np.where(usable, self.ranks[at], _NONE).astype(np.int32), np.where(usable, self.made[at], 0)

    def _known(self, symbols: list[int]) -> bytes:
        """``merge``'s bytes for symbols of which some are no pieces: -1 - code point, or letters that only occur inside pieces."""
        out: list[int] = []
        for s in symbols:
            if 0 <= s < self.n:
                out.append(s)
            else:
                c = chr(-1 - s) if s < 0 else self.letters[s]
                out += [self.byte_ids[b] for b in c.encode()] if self.byte_ids else [self.unknown]
        return np.array(out, np.int32).tobytes()

    def joined(self, ids: np.ndarray) -> bytes:
        """The ids in decimals, joined by commas."""
        return _spelled(self.decimal, ids)[:-1]

    def text(self, ids: np.ndarray) -> bytes:
        """The decoded text, without the space that encoding puts before it."""
        return _spelled(self.decoded, ids)[1:]


def _spelled(table: list[bytes], ids: np.ndarray) -> bytes:
    parts = (ids[at : at + _SPELLED].tolist() for at in range(0, len(ids), _SPELLED))
    return b"".join([b"".join(map(table.__getitem__, part)) for part in parts])


_MODELS: dict[str, tuple[PieceModel, dict[str, bytes]]] = {}


def _loaded(path: str) -> tuple[PieceModel, dict]:
    if path not in _MODELS:
        _MODELS[path] = (PieceModel(path), {})
    return _MODELS[path]


def encode_texts(path: str, texts: list[str]) -> Iterator[np.ndarray]:
    """The ids of each text."""
    model, cache = _loaded(path)
    split = [model.units(t) for t in texts]
    seen: set[str] = set().union(*split)
    fresh = [u for u in seen if u not in cache]
    if len(cache) + len(fresh) > CACHE_MOST:
        cache.clear()
        fresh = list(seen)
    if fresh:
        cache.update(zip(fresh, model.merge(fresh), strict=True))
    for units in split:
        yield np.frombuffer(b"".join(map(cache.__getitem__, units)), np.int32)


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column(1).to_pylist()]


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache = _loaded(path)
        for batch, _, _ in text_slices(batches, most=SLICE):
            rows = [(len(ids), *(hashlib.sha256(spell(ids)).hexdigest() for spell in (model.joined, model.text))) for ids in encode_texts(path, _texts(batch))]
            n, ids, out = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(out)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        cache.clear()  # a worker outlives its tasks; its memory is for what comes next

    return run


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache = _loaded(path)
        for batch, _, _ in text_slices(batches, most=SLICE):
            ids = list(encode_texts(path, _texts(batch)))
            flat, counts = pa.array(np.concatenate(ids)), np.array([len(x) for x in ids])
            yield pa.RecordBatch.from_arrays([batch.column(0), list_array(flat, counts), pa.array([model.text(x).decode() for x in ids], pa.string())], names=["doc_id", "ids", "decoded"])
        cache.clear()

    return run


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): every whole text encoded, without begin or end ids, and decoded again.

    ``model`` is a path that exists on every executor. Null texts count as empty: no ids. Repeated rows and ids stay
    rows of their own; other columns are not read.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_encoded(model or default_model()), "doc_id long, ids array<int>, decoded string")


def encode_digest(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of the same encoding, without shipping the ids."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_digests(model or default_model()), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
