"""Benchmark decontamination by winnowing.

Both sides hash every ``GRAM`` consecutive words and keep, of each run of ``window - GRAM + 1`` grams, the least (the leftmost
of equal ones), each place once. Two texts that share ``window`` consecutive words keep the same fingerprint in
the same place of that span, so no shared span is missed. Documents drop fingerprints that a filter of fixed size
rules out; the others are joined to the benchmark's on the fingerprint alone. A hit is then extended to the windows that
chose it, up to ``window - GRAM`` words to either side, whose 128-bit keys must be equal too. Neither join
multiplies: both meet distinct fingerprints and distinct windows. Items with fewer words than a window are one
window, matched by their own length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MAX_SLICE, Scratch, Words, bit_filter, list_array, may_be_in, ranges, run_hashes, sha_hex, signed, text_slices

WINDOW, GRAM = 10, 5

_WINDOW = pa.struct([("pos", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64())])
_FINGERPRINT = pa.struct([("fp", pa.int64()), ("len", pa.int32()), ("windows", pa.list_(_WINDOW))])


def _winnowed(words: Words, hashes: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Every whole window: (text, first word, the gram it chooses, that gram's hash, two keys)."""
    g = run_hashes(hashes, GRAM)
    owner, at = ranges(np.maximum(np.diff(words.of) - window + 1, 0))
    first = words.of[owner] + at
    chosen = first.copy()
    for d in range(1, window - GRAM + 1):
        chosen = np.where(g[first + d] < g[chosen], first + d, chosen)
    return owner, at, chosen, g[chosen], run_hashes(hashes, window, 1)[first], run_hashes(hashes, window, 2)[first]


def _short(words: Words, hashes: np.ndarray, n: int, whole: bool) -> tuple[np.ndarray, ...]:
    """Runs of ``n`` words, too short to be winnowed: all of them, or only texts that have exactly ``n``."""
    size = np.diff(words.of)
    owner, at = ranges((size == n).astype(int) if whole else np.maximum(size - n + 1, 0))
    first = words.of[owner] + at
    k1, k2 = run_hashes(hashes, n, 1)[first], run_hashes(hashes, n, 2)[first]
    return owner, at, first, k1, k1, k2


def _candidates(window: int, items: bool, lengths: tuple[int, ...], wanted: Broadcast | None):
    """A mapInArrow function: (id, n_words, fingerprints) by row; a fingerprint has the windows that chose it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_slices(batches, most=MAX_SLICE):
            words = Words(data, offsets)
            hashes = words.hashes()
            parts = [(*_winnowed(words, hashes, window), window)]
            parts += [(*_short(words, hashes, n, items), n) for n in (range(1, window) if items else lengths)]
            found = []
            for owner, at, chosen, fp, k1, k2, n in parts:
                if wanted is not None:
                    keep = may_be_in(wanted, fp)
                    owner, at, chosen, fp, k1, k2 = owner[keep], at[keep], chosen[keep], fp[keep], k1[keep], k2[keep]
                found.append((owner, at, chosen, fp, k1, k2, np.full(len(fp), n, np.int32)))
            owner, at, chosen, fp, k1, k2, n = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((at, chosen, n, owner))
            owner, at, chosen, fp, k1, k2, n = (x[order] for x in (owner, at, chosen, fp, k1, k2, n))
            new = np.ones(len(owner), bool)  # windows of a text that chose the same gram follow each other
            new[1:] = (owner[1:] != owner[:-1]) | (n[1:] != n[:-1]) | (chosen[1:] != chosen[:-1])
            head = np.flatnonzero(new)
            flat = pa.StructArray.from_arrays([pa.array(at), pa.array(signed(k1)), pa.array(signed(k2))], fields=list(_WINDOW))
            chosen_by = list_array(flat, np.diff(np.append(head, len(owner))))
            prints = pa.StructArray.from_arrays([pa.array(signed(fp[head])), pa.array(n[head]), chosen_by], fields=list(_FINGERPRINT))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(words.of)), list_array(prints, np.bincount(owner[head], minlength=batch.num_rows))], names=["id", "n_words", "found"])

    return run


_SCHEMA = "id long, n_words long, found array<struct<fp:long,len:int,windows:array<struct<pos:long,k1:long,k2:long>>>>"
_KEY = ["k1", "k2", "len"]


def _hits(own: DataFrame, items: DataFrame, item_col: str, item_text_col: str, window: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Numbered rows of ``own`` (id, text), the benchmark's windows, and the rows' windows that are among them."""
    scratch = Scratch(own.sparkSession, "benchmark")
    printed = items.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).alias("text")).mapInArrow(_candidates(window, True, (), None), _SCHEMA)
    bench = scratch.keep("items", printed.select(F.col("id").alias("item"), F.inline("found")).select("item", "fp", "len", F.inline("windows")).drop("pos"))
    lengths = tuple(sorted(r["len"] for r in bench.select("len").distinct().collect() if r["len"] != window))  # fewer than ``window``
    wanted = bit_filter(bench, "fp")
    scanned = scratch.keep("found", own.mapInArrow(_candidates(window, False, lengths, wanted), _SCHEMA.replace("id long", f"id {own.schema['id'].dataType.simpleString()}", 1)).withColumn("row", F.monotonically_increasing_id()))
    joined = scanned.select("row", F.inline("found")).join(bench.select("fp", "len").distinct(), ["fp", "len"], "left_semi")
    extended = joined.select("row", "len", F.inline("windows")).join(bench.select(*_KEY).distinct(), _KEY)
    return scanned, bench, extended


def _words_in(hits: F.Column) -> F.Column:
    """Words under sorted (pos, len) intervals that may overlap."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def add(a: F.Column, h: F.Column) -> F.Column:
        end = h["pos"] + h["len"]
        return F.struct((a["n"] + F.greatest(F.lit(0), end - F.greatest(a["end"], h["pos"]))).alias("n"), F.greatest(a["end"], end).alias("end"))

    return F.aggregate(hits, start, add, lambda a: a["n"])


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row for each row of ``docs``: (doc_id, n_words, n_hit, n_items, item_ids, hits).

    ``hits`` are the (start word, length) of windows found. Null and empty texts have no words; an item without
    words has no window. Rows that repeat an id are judged each on their own; items that repeat an id share it.
    Other columns of either table are not read. An empty ``items`` leaves every document clean.
    """
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    scanned, bench, hits = _hits(own, items, item_col, item_text_col, window)
    covered = hits.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("pos", "len"))).alias("hits")).select("row", "hits", _words_in(F.col("hits")).alias("n_hit"))
    by_item = hits.select("row", *_KEY).distinct().join(bench.select("item", *_KEY).distinct(), _KEY).groupBy("row").agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("item_ids"))
    none = F.array().cast("array<string>")
    return (
        scanned.select("row", "id", "n_words").join(covered, "row", "left").join(by_item, "row", "left")
        .select(F.col("id").alias("doc_id"), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("item_ids", none).alias("item_ids"), "hits")
    )


def contamination_digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = contamination(docs, items)
    return found.select("doc_id", "n_words", "n_hit", "n_items", sha_hex(F.array_join("item_ids", ",")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that have a hit; each row is judged by its own text, and ``id_col`` does not matter."""
    key = F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    scanned, _, hits = _hits(docs.select(key.alias("id"), F.col(text_col).alias("text")), items, "item_id", "text", WINDOW)
    gone = scanned.join(hits.select("row").distinct(), "row", "left_semi").select(F.col("id").alias("key")).distinct()
    return docs.select(key.alias("key"), F.struct(*docs.columns).alias("whole")).join(gone, "key", "left_anti").select("whole.*")
