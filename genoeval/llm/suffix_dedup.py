"""Repeated byte strings, by sorting sampled suffix prefixes.

The suffix-array scheme sorts a sample of the suffixes, names them, and decides the rest by the sample they lead
to. A difference cover samples by position (two thirds of all bytes for triples, or 14 in 128 for a wide one), so
its first sort alone moves several times the corpus. Here the sample is a string synchronising set, which plays the
same part and is far sparser: the position of the least hash of ``GRAM`` bytes in every window of ``length`` bytes.
Equal windows then hold equal samples at equal offsets, and

1. samples are sorted by the name of their gram; a name that occurs once cannot lie in a repeated window;
2. the windows that lead to one sample form a run of starts; a run whose whole text (its prefix) has an equal
   neighbour is repeated, start by start;
3. runs that are still open are cut into ``CELL`` starts each, then into single starts, and named again
   (recursion); a cell whose common core has no equal neighbour is not repeated.

Passages of over 50 words are often shorter than ``LENGTH`` bytes. Where they are asked for too, all texts are searched
for strings of ``PASSAGE`` bytes, and those of ``LENGTH`` bytes only inside what that leaves: a string that occurs
again is made of shorter ones that do.

Names are 128-bit hashes. All three steps group narrow rows; counts are pre-aggregated, so thousands of copies of a
passage cost no more than other text, and nothing is collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BASES, NO_SPACE, ByteHash, Scratch, Words, list_array, mix, ranges, signed, text_slices

LENGTH, GRAM, CELL = 400, 64, 16
#: Passages of over 50 words: 51 words of five bytes with their space.
PASSAGE, PASSAGE_WORDS = 256, 50

#: A sample: its gram's hash, the hash of its run's text, its place, and its run of starts as ``at - before`` to ``lo + more``.
_SAMPLE = pa.struct([("fp", pa.int64()), ("h", pa.int64()), ("at", pa.int32()), ("before", pa.int32()), ("more", pa.int32())])
_SAMPLE_SQL = "array<struct<fp:long,h:long,at:int,before:int,more:int>>"


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` consecutive ones."""
    k = 1
    n = len(x) - width + 1
    while k * 2 <= width:
        x = np.minimum(x[:-k], x[k:])
        k *= 2
    return np.minimum(x[:n], x[width - k : width - k + n])


def difference_cover(most: int) -> tuple[int, np.ndarray]:
    """(v, cover) with v at most ``most``, the largest of the family v = 24 r^2 + 36 r + 13 with 6 r + 4 residues.

    For any i and j some shift d < v puts both i + d and j + d on the cover. Below 13 every place is on it (v = 1).
    """
    r = max((r for r in range(1 + int(most**0.5)) if 24 * r * r + 36 * r + 13 <= most), default=None)
    if r is None:
        return 1, np.zeros(1, np.int64)
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return 24 * r * r + 36 * r + 13, np.concatenate([[0], np.cumsum(steps)])


def _least_samples(g: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Places of the least gram of each window, with the run of starts that lead to each: (at, lo, hi)."""
    size = np.diff(offsets)
    # The place goes in the low bits: the least value is the leftmost least hash.
    low = np.uint64((1 << max(1, (len(g) - 1).bit_length())) - 1)
    least = _sliding_min((g & ~low) | np.arange(len(g), dtype=np.uint64), length - gram + 1)
    # A start is good if its window stays in its text.
    good = np.zeros(len(least) + 1, np.int8)
    big = np.flatnonzero(size >= length)
    good[offsets[big]] += 1
    good[np.minimum(offsets[big + 1] - length + 1, len(least))] -= 1
    good = np.cumsum(good[:-1]).astype(bool)
    at = (least & low).astype(np.int64)
    edge = np.ones(len(at), bool)
    edge[1:] = (at[1:] != at[:-1]) | (good[1:] != good[:-1])
    edge[offsets[big][offsets[big] < len(edge)]] = True
    lo = np.flatnonzero(edge)
    hi = np.append(lo[1:], len(at)) - 1
    keep = good[lo]
    return at[lo[keep]], lo[keep], hi[keep]


def _cover_samples(offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Places on a difference cover, counted from the start of each text, with the starts that lead to each: (at, lo, hi)."""
    v, cover = difference_cover(length - gram + 1)
    size = np.diff(offsets)
    owner, step = ranges(np.where(size >= length, (size - gram) // v + 1, 0))
    at = (step * v)[:, None] + cover
    owner = np.broadcast_to(owner[:, None], at.shape).ravel()
    at = at.ravel()
    lo, hi = np.maximum(at - v + 1, 0), np.minimum(at, size[owner] - length)
    keep = (lo <= hi) & (at + gram <= size[owner])
    base = offsets[owner[keep]]
    return at[keep] + base, lo[keep] + base, hi[keep] + base


def _samples(length: int, gram: int, cover: bool):
    """mapInArrow: (doc_id, key, samples)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_slices(batches):
            counts, found = np.zeros(batch.num_rows, np.int64), None
            if len(data) >= length:
                text = ByteHash(data, BASES[0])
                g = text.grams(gram)
                at, lo, hi = _cover_samples(offsets, length, gram) if cover else _least_samples(g, offsets, length, gram)
                owner = np.searchsorted(offsets, lo, side="right") - 1
                counts = np.bincount(owner, minlength=batch.num_rows)
                # Runs are equal if their texts, their lengths and their samples' places in them are.
                shape = ((at - lo) * np.int64(length) + (hi - lo)).astype(np.uint64)
                h = mix(text(lo, hi + length) + shape)
                found = [signed(g[at]), signed(h), *(x.astype(np.int32) for x in (at - offsets[owner], at - lo, hi - lo))]
            flat = pa.StructArray.from_arrays([pa.array(x) for x in found] if found else [pa.array([], f.type) for f in _SAMPLE], fields=list(_SAMPLE))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), list_array(flat, counts)], names=["doc_id", "key", "samples"])

    return run


_CELL = pa.struct([("fp", pa.int64()), ("cell", pa.int32()), ("at", pa.int32()), ("o1", pa.int64()), ("o2", pa.int64()), ("core", pa.int64()), ("ident", pa.int64()), ("known", pa.bool_())])
_CELL_SQL = "array<struct<fp:long,cell:int,at:int,o1:long,o2:long,core:long,ident:long,known:boolean>>"


def _cells(length: int, width: int):
    """mapInArrow: rows with (doc_id, key, text, runs) give the cells of ``width`` starts of each run.

    Cells are aligned to the run's sample, so equal windows fall into equal cells. A cell that sticks out of its text
    has an outer text like no other (its stand-in is made of the row, the sample's place and the cell's number); single
    starts that lie outside are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_slices(batches):
            pad = length + 2 * width
            # Every text gets room on both sides.
            size = np.diff(offsets)
            base = offsets[:-1] + pad * (2 * np.arange(batch.num_rows) + 1)
            owner, at = ranges(size)
            wide = np.zeros(len(data) + 2 * pad * batch.num_rows, np.uint8)
            wide[base[owner] + at] = data
            first, second = ByteHash(wide, BASES[0]), ByteHash(wide, BASES[1])
            lists = batch.column(batch.schema.get_field_index("runs"))
            n = lists.value_lengths().to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(batch.num_rows), n)
            runs = lists.flatten()
            fp, place, lo, hi, known = (runs.field(c).to_numpy(zero_copy_only=False) for c in ("fp", "at", "lo", "hi", "known"))
            cell_lo, cell_hi = (lo - place).astype(np.int64) // width, (hi - place).astype(np.int64) // width
            which, step = ranges(cell_hi - cell_lo + 1)
            cell = cell_lo[which] + step
            start = place[which] + cell * width
            mine, shift = rows[which], base[rows[which]]
            a, z = start + shift, start + shift + width - 1
            out = []
            ids = batch.column(0).to_numpy().view(np.uint64)[mine] * np.uint64(BASES[0]) + batch.column(1).to_numpy().view(np.uint64)[mine]
            ident = mix(mix(ids + place[which].astype(np.uint64) * np.uint64(BASES[1])) + cell.astype(np.uint64) * np.uint64(BASES[0]) + fp[which].view(np.uint64))
            outside = (start < 0) | (start + width - 1 + length > size[mine])
            core_outside = (start + width - 1 < 0) | (start + length > size[mine])
            place_in = mix(fp[which].view(np.uint64) + cell.astype(np.uint64) * np.uint64(BASES[0]))
            o1, o2 = (np.where(outside, mix(ident + np.uint64(k)), mix(h(a, z + length) + place_in)) for k, h in enumerate((first, second)))
            core = np.where(core_outside, mix(ident + np.uint64(2)), mix(first(z, a + length) + place_in))
            inside = ~outside if width == 1 else np.ones(len(start), bool)
            fields = (fp[which], cell.astype(np.int32), start.astype(np.int32), *(signed(x) for x in (o1, o2, core, ident)), known[which])
            flat = pa.StructArray.from_arrays([pa.array(x[inside]) for x in fields], fields=list(_CELL))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), list_array(flat, np.bincount(mine[inside], minlength=batch.num_rows))], names=["doc_id", "key", "cells"])

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str, *others: Column) -> DataFrame:
    """(doc_id, key, text): id and text hash together tell rows apart; rows equal in both share their result.

    Neither is null, as both are joined on: a row without an id has a second hash of its text in its place, and its
    key says so.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = F.col(id_col).cast("long")
    return docs.select(F.coalesce(own, F.xxhash64(F.lit("no id"), text)).alias("doc_id"), F.xxhash64(text, own.isNull()).alias("key"), text.alias("text"), own.alias("id"), *others)


def repeated_starts(keyed: DataFrame, length: int = LENGTH, gram: int = GRAM, cover: bool = False, scratch: Scratch | None = None) -> DataFrame:
    """Runs of starts whose ``length``-byte string also starts elsewhere: (doc_id, key, lo, hi), runs may touch."""
    scratch = scratch or Scratch(keyed.sparkSession, "repeats")
    mine = _named_runs(scratch, keyed, length, gram, cover)
    yes = mine.filter("n > 1").select("doc_id", "key", "lo", "hi")
    pending = mine.filter("goes_on").select("doc_id", "key", F.struct("fp", "at", "lo", "hi", (F.col("n") > 1).alias("known")).alias("run"))
    for width in (CELL, 1):
        found, pending = _named_cells(scratch, keyed, pending, length, width)
        yes = yes.unionByName(found)
    return yes


def _named_runs(scratch: Scratch, keyed: DataFrame, length: int, gram: int, cover: bool) -> DataFrame:
    """Runs of starts whose gram occurs again, how often their whole text does (n), and whether they need a closer look."""
    found = keyed.filter(F.octet_length("text") >= length).mapInArrow(_samples(length, gram, cover), f"doc_id long, key long, samples {_SAMPLE_SQL}")
    # The run in one word, as every column of a shuffled row takes eight bytes.
    run = F.shiftleft(F.col("at").cast("long"), 32) + F.shiftleft(F.col("before").cast("long"), 16) + F.col("more")
    samples = scratch.keep("samples", found.select("doc_id", "key", F.inline("samples")).select("doc_id", "key", "fp", "h", run.alias("run")))
    # Sorted by the grams' names: a gram that occurs once closes its run.
    grams = scratch.keep("grams", samples.groupBy("fp").agg(F.count("*").alias("n")).filter("n > 1").select("fp"))
    rows = scratch.keep("again", samples.join(grams, "fp", "left_semi"))
    scratch.drop("samples", "grams")
    # Then by the names of the whole runs; one run of each name stands in for all of them.
    ident = F.xxhash64("doc_id", "key", "run")
    # Both sides of the join by gram are tables, so that a gram in very many runs is split over tasks.
    runs = scratch.keep("named", rows.groupBy("fp", "h").agg(F.count("*").alias("n"), F.min(ident).alias("one")))
    lone = scratch.keep("lone", runs.groupBy("fp").agg((F.min("n") == 1).alias("open")))
    names = scratch.keep("names", runs.join(lone, "fp"))
    at, before, more = F.shiftright("run", 32), F.shiftright("run", 16).bitwiseAND(F.lit(0xFFFF)), F.col("run").bitwiseAND(F.lit(0xFFFF))
    goes_on = F.col("open") & ((F.col("n") == 1) | (ident == F.col("one")))
    lo = at - before
    mine = scratch.keep("runs", rows.join(names, ["fp", "h"]).select("doc_id", "key", "fp", *(x.cast("int").alias(c) for x, c in ((at, "at"), (lo, "lo"), (lo + more, "hi"))), "n", goes_on.alias("goes_on")))
    scratch.drop("again", "named", "lone", "names")
    return mine


def _named_cells(scratch: Scratch, keyed: DataFrame, pending: DataFrame, length: int, width: int) -> tuple[DataFrame, DataFrame | None]:
    """Cells of the pending runs: those found repeated (lo, hi), and the runs that still need a closer look."""
    lists = pending.groupBy("doc_id", "key").agg(F.collect_set("run").alias("runs"))
    found = lists.join(keyed, ["doc_id", "key"]).select("doc_id", "key", "text", "runs").mapInArrow(_cells(length, width), f"doc_id long, key long, cells {_CELL_SQL}")
    cells = scratch.keep(f"cells-{width}", found.select("doc_id", "key", F.inline("cells")))
    # One stand-in of each text that is known to be repeated counts for all of them.
    name = ["o1", "o2"]
    texts = scratch.keep(f"outer-{width}", cells.groupBy(*name, "core").agg(F.count("*").alias("n"), F.max("known").alias("known"), F.min("ident").alias("one")))
    cores = texts.groupBy("core").agg(F.sum("n").alias("total"), F.min(F.when(F.col("known"), 2).otherwise(F.col("n"))).alias("least")).filter("total > 1")
    cores = scratch.keep(f"cores-{width}", cores)
    state = texts.join(cores, "core").select(*name, (F.col("known") | (F.col("n") > 1)).alias("sure"), "one", (F.col("least") == 1).alias("open")).filter("sure or open")
    state = scratch.keep(f"texts-{width}", state)
    goes_on = F.col("open") & (~F.col("sure") | (F.col("ident") == F.col("one")))
    named = scratch.keep(f"named-{width}", cells.join(state, name).select("doc_id", "key", "fp", "cell", "at", "known", "sure", goes_on.alias("goes_on")))
    scratch.drop(f"cells-{width}", f"outer-{width}", f"cores-{width}", f"texts-{width}")
    yes = named.filter("sure and not known").select("doc_id", "key", F.col("at").alias("lo"), (F.col("at") + width - 1).alias("hi"))
    # The finer cells keep their alignment: the sample's place is start - cell * width.
    run = F.struct("fp", (F.col("at") - F.col("cell") * width).cast("int").alias("at"), F.col("at").alias("lo"), (F.col("at") + width - 1).cast("int").alias("hi"), F.col("sure").alias("known"))
    return yes, None if width == 1 else named.filter("goes_on").select("doc_id", "key", run.alias("run"))


def _marked(batch: pa.RecordBatch, offsets: np.ndarray, names: tuple[str, str], length: int, more: int) -> np.ndarray:
    """Bytes from a run's first start to ``more`` bytes after its last; the lists of starts are columns of the batch."""
    lows, highs = (batch.column(batch.schema.get_field_index(c)) for c in names)
    n = np.nan_to_num(lows.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    rows = np.repeat(np.arange(batch.num_rows), n)
    lo = lows.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    hi = highs.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    lo, hi = np.maximum(lo, 0), np.minimum(hi, np.diff(offsets)[rows] - length)
    some = lo <= hi
    rows, lo, hi = rows[some], lo[some], hi[some]
    mark = np.zeros(offsets[-1] + 1, np.int64)
    np.add.at(mark, offsets[rows] + lo, 1)
    np.add.at(mark, offsets[rows] + hi + more, -1)
    return np.cumsum(mark[:-1]) > 0


def _first(marked: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The first byte of each run of marked ones; runs end with their text."""
    start = marked.copy()
    start[1:] &= ~marked[:-1]
    edge = offsets[:-1][np.diff(offsets) > 0]
    start[edge] = marked[edge]
    return start


def _runs(marked: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last byte of each run of marked ones."""
    start = _first(marked, offsets)
    return np.flatnonzero(start), np.flatnonzero(marked & np.append(~marked[1:] | start[1:], True)[: len(marked)])


def _passages(marked: np.ndarray, data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """By text: the runs of marked bytes with more than ``words`` whole words between spaces, and their bytes."""
    count = len(offsets) - 1
    if not marked.any():
        return np.zeros(count, np.int64), np.zeros(count, np.int64)
    a, z = _runs(marked, offsets)
    found = Words(data, offsets, NO_SPACE)
    long = np.searchsorted(found.end, z + 1, side="right") - np.searchsorted(found.start, a) > words
    owner, size = np.searchsorted(offsets, a[long], side="right") - 1, z[long] + 1 - a[long]
    out = np.zeros(count, np.int64)
    np.add.at(out, owner, size)
    return np.bincount(owner, minlength=count), out


def _stretches(passage: int, length: int):
    """mapInArrow: (doc_id, key, text, lo, hi) to the texts' stretches of repeated strings, those of ``length`` bytes at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_slices(batches):
            a, z = _runs(_marked(batch, offsets, ("lo", "hi"), passage, 1), offsets)
            some = z - a + passage >= length
            a, z = a[some], z[some] + passage
            owner = np.searchsorted(offsets, a, side="right") - 1
            ids = [batch.column(i).take(pa.array(owner)) for i in (0, 1)]
            texts = pa.array([data[i:j].tobytes() for i, j in zip(a, z, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*ids, pa.array((a - offsets[owner]).astype(np.int32)), texts], names=["doc_id", "key", "base", "text"])

    return run


def _cut(length: int, with_text: bool, passage: int | None = None):
    """mapInArrow: (doc_id, text, lo, hi) to the spans removed and what is kept; with ``passage``, its runs are (short_lo, short_hi)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_slices(batches):
            size = np.diff(offsets)
            gone = _marked(batch, offsets, ("lo", "hi"), length, length)
            start = _first(gone, offsets)
            sums = np.concatenate([[0], np.cumsum(gone)])
            starts = np.concatenate([[0], np.cumsum(start)])
            removed, spans = sums[offsets[1:]] - sums[offsets[:-1]], starts[offsets[1:]] - starts[offsets[:-1]]
            kept = [(data[a:z][~gone[a:z]] if r else data[a:z]).tobytes() for a, z, r in zip(offsets[:-1], offsets[1:], removed, strict=True)]
            head = [batch.column(0), pa.array(size), pa.array(removed), pa.array(spans)]
            if with_text:  # bytes of characters that were cut in two go as well
                yield pa.RecordBatch.from_arrays([*head, pa.array([k.decode(errors="ignore") for k in kept], pa.string()), *(batch.column(i) for i in range(4, batch.num_columns))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", *batch.schema.names[4:]])
            else:
                found = _passages(_marked(batch, offsets, ("short_lo", "short_hi"), passage, passage), data, offsets, PASSAGE_WORDS) if passage else ()
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["n_passages", "n_passage_bytes"] if passage else [])]
                yield pa.RecordBatch.from_arrays([*head, pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), *(pa.array(x) for x in found)], names=names)

    return run


def _lists(spans: DataFrame) -> DataFrame:
    return spans.groupBy("doc_id", "key").agg(F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("runs"))


def _both_lengths(keyed: DataFrame, length: int, passage: int, gram: int, cover: bool) -> DataFrame:
    """(doc_id, key, lo, hi, short_lo, short_hi): runs of starts of strings of both lengths, ``passage`` being the shorter.

    All starts of a longer repeated string's shorter ones are repeated and follow one another, so it lies in one
    stretch of such starts, and no other stretch holds that place: the stretches are texts of their own.
    """
    scratch = Scratch(keyed.sparkSession, "passages")
    spans = scratch.keep("short", _lists(repeated_starts(keyed, passage, gram, cover, scratch)).select("doc_id", "key", F.col("runs.lo").alias("lo"), F.col("runs.hi").alias("hi")))
    scratch.drop("runs", *(f"named-{width}" for width in (CELL, 1)))
    found = spans.join(keyed, ["doc_id", "key"]).select("doc_id", "key", "text", "lo", "hi")
    found = found.mapInArrow(_stretches(passage, length), "doc_id long, key long, base int, text binary")
    stretches = scratch.keep("stretches", found.withColumn("part", F.xxhash64("key", "base")))
    inside = repeated_starts(stretches.select("doc_id", F.col("part").alias("key"), "text"), length, gram, cover).withColumnRenamed("key", "part")
    places = stretches.select("doc_id", "part", "key", "base").distinct()
    whole = inside.join(places, ["doc_id", "part"]).select("doc_id", "key", (F.col("lo") + F.col("base")).alias("lo"), (F.col("hi") + F.col("base")).alias("hi"))
    short = spans.withColumnsRenamed({"lo": "short_lo", "hi": "short_hi"})
    return short.join(_lists(whole), ["doc_id", "key"], "left").select("doc_id", "key", F.col("runs.lo").alias("lo"), F.col("runs.hi").alias("hi"), "short_lo", "short_hi")


def _with_spans(docs: DataFrame, id_col: str, text_col: str, length: int, gram: int, cover: bool, others: list[str]) -> DataFrame:
    keyed = _keyed(docs, id_col, text_col).drop("id")
    spans = _lists(repeated_starts(keyed, length, gram, cover))
    extra = F.struct(*[F.col(c) for c in others]).alias("others") if others else F.lit(None).cast("int").alias("others")
    whole = _keyed(docs, id_col, text_col, extra)
    return whole.join(spans, ["doc_id", "key"], "left").select(F.col("id").alias("doc_id"), "text", F.col("runs.lo").alias("lo"), F.col("runs.hi").alias("hi"), "others")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, cover: bool = False, passage: int | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for each row of ``docs``.

    Every byte covered by a ``length``-byte string (up to 65,535) that also starts elsewhere, in this text or another,
    is removed. With ``cover`` the samples lie on a difference cover; results are the same.
    Null and empty texts have no bytes. Two rows with equal texts are each other's copies, also under one id.
    Rows equal in id and text are one string's two copies as well, and rows without an id are rows like others. Empty
    tables give no rows. With ``passage``, a length between ``gram`` and ``length``, (n_passages, n_passage_bytes) follow:
    the maximal runs covered by strings of that length that occur again, those of more than ``PASSAGE_WORDS`` whole words between spaces.
    """
    columns = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if passage is None:
        return _with_spans(docs, id_col, text_col, length, gram, cover, []).mapInArrow(_cut(length, False), columns)
    if not gram <= passage <= length:
        raise ValueError("passage must lie between gram and length")
    spans = _both_lengths(_keyed(docs, id_col, text_col).drop("id"), length, passage, gram, cover)
    found = _keyed(docs, id_col, text_col).join(spans, ["doc_id", "key"], "left").select(F.col("id").alias("doc_id"), "text", "lo", "hi", "short_lo", "short_hi")
    return found.mapInArrow(_cut(length, False, passage), f"{columns}, n_passages long, n_passage_bytes long")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, cover: bool = False) -> DataFrame:
    """``docs`` with the repeated bytes cut out of the texts; texts of which nothing is left, and null texts, stay as empty."""
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    found = _with_spans(docs, id_col, text_col, length, gram, cover, others)
    kind = found.schema["others"].dataType.simpleString()
    cut = found.mapInArrow(_cut(length, True), f"doc_id long, n_bytes long, n_removed long, n_spans long, kept string, others {kind}")
    return cut.select(*[F.col("doc_id").alias(c) if c == id_col else F.col("kept").alias(c) if c == text_col else F.col("others")[c].alias(c) for c in docs.columns])
