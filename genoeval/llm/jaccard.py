"""N-gram Jaccard join with Bayesian candidate pruning.

Texts become sets of five-word shingles (64-bit hashes). Rows with equal sets are one class member each of the
same representative, so copies are never paired. Representatives that share a band of MinHash values are
candidates; a candidate pair's MinHash values are compared ``STEP`` at a time, and the pair is dropped as soon
as the posterior probability (uniform prior) that its similarity reaches the threshold is below ``tolerance``.
What is left is verified on the exact sets.

Pairs never become rows: a bucket of candidates is worked through in blocks of ``BLOCK`` representatives, a
large bucket as all its pairs of blocks dealt over tasks. There a block is one row, so that rows (members, then blocks)
do not grow with the square of a bucket. A pair counts only in the first band that holds it.
A block returns link counts and a spanning forest of its links, which is all that classes need.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, Words, bit_filter, may_be_in, mix, ranges, run_hashes, signed, text_slices

SHINGLE, THRESHOLD = 5, 0.8
#: 27 bands of 3: a pair at 0.8 shares no band with probability 3.9e-9. STEP values are compared at a time; at 0.8 the
#: pruning loses a pair with probability 2.9e-9, all steps together. More similar pairs are lost more rarely.
BANDS, ROWS, STEP, TOLERANCE = 27, 3, 8, 2e-10
#: A block has this many sets, and this many bytes of shingles, in the mean; two blocks meet in a task.
BLOCK, BLOCK_BYTES = 256, 8 << 20

def posterior_below(matches: int, compared: int, threshold: float) -> float:
    """P(similarity >= threshold) after ``matches`` of ``compared`` equal MinHash values, uniform prior."""
    n = compared + 1
    return sum(comb(n, i) * threshold**i * (1 - threshold) ** (n - i) for i in range(matches + 1))


def least_matches(threshold: float, tolerance: float, hashes: int = BANDS * ROWS) -> dict[int, int]:
    """By number of values compared, the fewest matches with which a pair goes on."""
    return {n: next(m for m in range(n + 1) if posterior_below(m, n, threshold) >= tolerance) for n in range(STEP, hashes + 1, STEP)}


def _shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes by text, sorted: (hashes, first by text). A text of 1 to k-1 words has one shingle, all its words."""
    h, size = words.hashes(), np.diff(words.of)
    owner, at = ranges(np.maximum(size - k + 1, 0))
    parts = [(owner, run_hashes(h, k)[words.of[owner] + at])]
    for n in range(1, k):
        few = np.flatnonzero(size == n)
        if len(few):
            parts.append((few, run_hashes(h, n)[words.of[few]]))
    owner, g = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((g, owner))
    owner, g = owner[order], g[order]
    new = np.ones(len(g), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (g[1:] != g[:-1])
    owner, g = owner[new], g[new]
    return g, np.searchsorted(owner, np.arange(len(size) + 1))


def _set_keys(g: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set; the sums do not depend on order and the sets are distinct."""
    out = []
    for seed in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        sums = np.zeros(len(g) + 1, np.uint64)
        np.cumsum(mix(g ^ np.uint64(seed)), out=sums[1:])
        out.append(mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64)))
    return out[0], out[1]


_SEEDS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _signatures(g: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash values, 32 bits each, by text with at least one shingle."""
    out = np.empty((len(first) - 1, len(_SEEDS)), np.uint32)
    base = mix(g.copy())
    for i, seed in enumerate(_SEEDS):
        x = base * seed
        x ^= x >> np.uint64(29)
        out[:, i] = np.minimum.reduceat((x * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32), first[:-1])
    return out


def _sets(k: int, wanted: Broadcast | None = None):
    """mapInArrow: rows with words give (..., s1, s2, size, body), all columns but the text first; size is the shingles' number.

    The body is the signature; with the bits of ``wanted``, it is the sorted shingles, of the sets whose bit is set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_slices(batches):
            words = Words(data, offsets)
            g, first = _shingles(words, k)
            has = np.flatnonzero(np.diff(first))
            kept = np.append(first[has], len(g))
            s1, s2 = _set_keys(g, kept)
            size = np.diff(kept)
            if wanted is not None:
                on = may_be_in(wanted, s1)
                body = [g[kept[x] : kept[x + 1]].tobytes() for x in on]
                has, s1, s2, size = has[on], s1[on], s2[on], size[on]
            else:
                body = [x.tobytes() for x in _signatures(g, kept)] if len(has) else []
            names = [c for c in batch.schema.names if c != "text"]
            own = [batch.column(c).take(pa.array(has)) for c in names]
            yield pa.RecordBatch.from_arrays([*own, pa.array(signed(s1)), pa.array(signed(s2)), pa.array(size), pa.array(body, pa.binary())], names=[*names, "s1", "s2", "size", "body"])

    return run


def _band_keys(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band, by representative."""
    s = signatures.astype(np.uint64).reshape(len(signatures), BANDS, ROWS)
    total = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F), s.shape[:2]).copy()
    for i in range(ROWS):
        total = mix(total + s[:, :, i] * np.uint64(0xE7037ED1A0B428DB + 2 * i))
    return total


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = _band_keys(np.frombuffer(b"".join(batch.column("body").to_pylist()), np.uint32).reshape(batch.num_rows, -1))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("rep").to_numpy(), BANDS)), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)), pa.array(signed(keys.ravel())), pa.array(np.repeat(batch.column("size").to_numpy(), BANDS))], names=["rep", "band", "key", "size"])


def _alive(left: np.ndarray, right: np.ndarray, same: bool, band: int, least: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (left row, right row) first met in this band and not pruned."""
    i, j = np.triu_indices(len(left), 1) if same else (x.ravel() for x in np.indices((len(left), len(right))))
    for b in range(band):
        keep = ~(left[i, b * ROWS : b * ROWS + ROWS] == right[j, b * ROWS : b * ROWS + ROWS]).all(1)
        i, j = i[keep], j[keep]
    matches = np.zeros(len(i), np.int64)
    for n, few in least.items():
        matches += (left[i, n - STEP : n] == right[j, n - STEP : n]).sum(1)
        keep = matches >= few
        i, j, matches = i[keep], j[keep], matches[keep]
    return i, j


def _linked(i: np.ndarray, j: np.ndarray, sets: list[np.ndarray], other: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs reach the threshold, from exact intersections of the sets, a few thousand shingles at a time."""
    own, theirs = np.unique(i), np.unique(j)
    a, b = np.searchsorted(own, i), np.searchsorted(theirs, j)
    size_a, size_b = np.array([len(sets[x]) for x in own]), np.array([len(other[x]) for x in theirs])
    flat = np.concatenate([sets[x] for x in own] + [other[x] for x in theirs])
    _, column = np.unique(flat, return_inverse=True)
    row = np.repeat(np.arange(len(own) + len(theirs)), np.concatenate([size_a, size_b]))
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(own), len(theirs)), np.float32)
    width = 8192
    for at in range(0, int(column[-1]) + 1, width):
        lo, hi = np.searchsorted(column, (at, at + width))
        m = np.zeros((len(own) + len(theirs), width), np.float32)
        m[row[lo:hi], column[lo:hi] - at] = 1
        common += m[: len(own)] @ m[len(own) :].T
    c = common[a, b].astype(np.int64)
    total = size_a[a] + size_b[b] - c
    return c * 1_000_000 >= total * round(threshold * 1_000_000)


#: A block of a bucket; a pair of blocks.
_ONE, _PAIR = ("key", "band", "side", "blocks"), ("key", "band", "i", "j")
_LISTS = {"reps": pa.int64(), "bodies": pa.binary(), "copies": pa.int64(), "shingles": pa.binary(), "links": pa.int64(), "to": pa.int64()}
_HEAD = "key long, band int, side int, blocks int"


def _groups(batches: Iterator[pa.RecordBatch], by: tuple[str, ...]) -> Iterator[tuple[tuple, dict]]:
    """Rows sorted by ``by`` as (that, columns); a group may span batches."""
    held: list[pa.RecordBatch] = []

    def close() -> tuple[tuple, dict]:
        t = pa.Table.from_batches(held)
        return tuple(t.column(c)[0].as_py() for c in by), {c: t.column(c) for c in t.column_names}

    for batch in batches:
        if not batch.num_rows:
            continue
        ids = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in by])
        cuts = [0, *(np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.slice(a, z - a)
            if held and a == 0 and any(held[0].column(c)[0].as_py() != part.column(c)[0].as_py() for c in by) or held and a:
                yield close()
                held = []
            held.append(part)
    if held:
        yield close()


def _row(key: int, band: int, side: int, blocks: int, **lists) -> pa.RecordBatch:
    """One block with lists by member."""
    head = [pa.array([key]), *(pa.array([x], pa.int32()) for x in (band, side, blocks))]
    return pa.RecordBatch.from_arrays([*head, *(pa.array([v], pa.list_(_LISTS[n])) for n, v in lists.items())], names=[*_ONE, *lists])


def _flat(rows: dict, name: str) -> list | np.ndarray:
    """A list column's members, block after block."""
    flat = pc.list_flatten(rows[name].combine_chunks())
    return flat.to_numpy() if pa.types.is_integer(flat.type) else flat.to_pylist()


def _sides(rows: dict) -> np.ndarray:
    return np.repeat(rows["side"].to_numpy(), pc.list_value_length(rows["reps"]).to_numpy())


def _signature_rows(bodies: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(bodies), np.uint32).reshape(len(bodies), -1)


def _survivors(least: dict[int, int]):
    """mapInArrow: of a bucket of one block, the members that have a pair left after pruning; a larger bucket's blocks as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, band, side, blocks), rows in _groups(batches, _ONE):
            rep, bodies = rows["rep"].to_numpy(), rows["body"].to_pylist()
            if blocks > 1:
                yield _row(key, band, side, blocks, reps=rep, bodies=bodies)
                continue
            s = _signature_rows(bodies)
            on = np.unique(np.concatenate(_alive(s, s, True, band, least)))
            if len(on):
                yield _row(key, band, side, blocks, reps=rep[on], bodies=None)

    return run


def _pair_survivors(least: dict[int, int]):
    """mapInArrow: the members of each pair of blocks that have a pair left, by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, band, i, j), rows in _groups(batches, _PAIR):
            s, side, rep = _signature_rows(_flat(rows, "bodies")), _sides(rows), _flat(rows, "reps")
            left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
            a, b = _alive(s[left], s[right], i == j, band, least)
            on = np.unique(np.concatenate([left[a], right[b]]))
            for k in np.unique(side[on]).tolist():
                yield _row(key, band, k, rows["blocks"][0].as_py(), reps=rep[on[side[on] == k]])

    return run


def _linked_members(s: np.ndarray, sets: list[np.ndarray], copies: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool, band: int, least: dict[int, int], threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(members with links, links counted in copies, members to which they go): the last span the links."""
    links, to = np.zeros(len(s), np.int64), np.arange(len(s))
    a, b = _alive(s[left], s[right], same, band, least)
    if len(a):
        yes = _linked(a, b, [sets[x] for x in left], [sets[x] for x in right], threshold)
        a, b = left[a[yes]], right[b[yes]]
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        while True:  # the least row that each one reaches
            was = to.copy()
            np.minimum.at(to, a, to[b])
            np.minimum.at(to, b, to[a])
            if (was == to).all():
                break
    on = np.flatnonzero(links)
    return on, links[on], to[on]


def _verified(least: dict[int, int], threshold: float):
    """mapInArrow: a bucket of one block gives members, their links and where these go; a larger bucket's blocks stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, band, side, blocks), rows in _groups(batches, _ONE):
            rep, copies = rows["rep"].to_numpy(), rows["copies"].to_numpy()
            bodies, shingles = rows["body"].to_pylist(), rows["shingles"].to_pylist()
            if blocks > 1:
                yield _row(key, band, side, blocks, reps=rep, copies=copies, bodies=bodies, shingles=shingles, links=None, to=None)
                continue
            every = np.arange(len(rep))
            on, links, to = _linked_members(_signature_rows(bodies), [np.frombuffer(x, np.uint64) for x in shingles], copies, every, every, True, band, least, threshold)
            if len(on):
                yield _row(key, band, side, blocks, reps=rep[on], copies=None, bodies=None, shingles=None, links=links, to=rep[to])

    return run


def _pair_verified(least: dict[int, int], threshold: float):
    """mapInArrow: (rep, links, to) of the members of each pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, band, i, j), rows in _groups(batches, _PAIR):
            side, rep, sets = _sides(rows), _flat(rows, "reps"), [np.frombuffer(x, np.uint64) for x in _flat(rows, "shingles")]
            left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
            on, links, to = _linked_members(_signature_rows(_flat(rows, "bodies")), sets, _flat(rows, "copies"), left, right, i == j, band, least, threshold)
            yield pa.RecordBatch.from_arrays([pa.array(rep[on]), pa.array(links), pa.array(rep[to])], names=["rep", "links", "to"])

    return run


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each component of undirected edges (a, b), by alternating star contractions.

    The neighbours' minima are kept as tables of their own before they are joined back, so that Spark sees both
    sides' sizes: small ones are broadcast, and a centre's many edges are split over tasks.
    """
    scratch = Scratch(edges.sparkSession, "components")
    e = scratch.keep("0", edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before, step = None, 0
    while True:
        # Large star: larger neighbours go to the least neighbour. Small star: smaller ones do.
        step += 1
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = scratch.keep(f"{step}-large", both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        e = scratch.keep(f"{step}-half", both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())
        low = scratch.keep(f"{step}-small", e.groupBy("a").agg(F.min("b").alias("m")))
        e = scratch.keep(f"{step}", e.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*").filter("a <> b").distinct())
        scratch.drop(str(step - 1), f"{step}-large", f"{step}-half", f"{step}-small")
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == before or not now["n"]:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def _own(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def _wordless(text_col: str) -> Column:
    return F.col(text_col).isNull() | ~F.col(text_col).rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def _classes(own: DataFrame, shingle: int, threshold: float, tolerance: float) -> tuple[DataFrame, DataFrame]:
    """Rows with words of ``own`` (id, ..., text), by set (s1, s2); and each set's root, links and the first row of its class.

    The first row has the least id (null ids last), then the least of the columns that follow.
    """
    least = least_matches(threshold, tolerance)
    columns = [f for f in own.schema if f.name != "text"]
    sets = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns) + ", s1 long, s2 long, size long, body binary"
    scratch = Scratch(own.sparkSession, "jaccard")
    signed_rows = scratch.keep("rows", own.mapInArrow(_sets(shingle), sets))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), *(f.name for f in columns)))
    # A set is known by 128 bits; its representative is a number of its own, as ids may repeat.
    reps = scratch.keep("sets", signed_rows.groupBy("s1", "s2").agg(first.alias("first"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("body").alias("body")).withColumn("rep", F.monotonically_increasing_id()))
    bands = scratch.keep("bands", reps.select("rep", "size", "body").mapInArrow(_bands, "rep long, band int, key long, size long"))
    # A bucket is dealt into blocks by number and by bytes of shingles, so that long texts do not fill a task.
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.least(F.col("n"), F.ceil(F.col("bytes") / BLOCK_BYTES))).cast("int")
    buckets = bands.groupBy("band", "key").agg(F.count("*").alias("n"), (8 * F.sum("size")).alias("bytes")).filter("n > 1").select("band", "key", blocks.alias("blocks"))
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(F.col("side"), o).alias("i"), F.greatest(F.col("side"), o).alias("j")))
    members = bands.join(buckets, ["band", "key"]).select("key", "band", mine.alias("side"), "blocks", "rep")
    bodies = reps.select("rep", "body", "copies")

    def by_block(rows: DataFrame) -> DataFrame:
        return rows.repartition("key", "band", "side").sortWithinPartitions(*_ONE)

    def in_pairs(blocks: DataFrame, columns: list[str]) -> DataFrame:
        return blocks.filter("blocks > 1").select("key", "band", "side", "blocks", *columns, F.inline(others)).repartition(*_PAIR).sortWithinPartitions(*_PAIR)

    pruned = scratch.keep("pruned", by_block(members.join(bodies.drop("copies"), "rep").select(*_ONE, "rep", "body")).mapInArrow(_survivors(least), f"{_HEAD}, reps array<long>, bodies array<binary>"))
    several = in_pairs(pruned, ["reps", "bodies"]).mapInArrow(_pair_survivors(least), f"{_HEAD}, reps array<long>")
    several = several.groupBy(*_ONE).agg(F.array_distinct(F.flatten(F.collect_list("reps"))).alias("reps"))
    left = scratch.keep("left", pruned.filter("blocks = 1").select(*_ONE, "reps").unionByName(several).select(*_ONE, F.explode("reps").alias("rep")))
    # Shingles are made again, for one row of each set that has a pair left.
    needed = scratch.keep("needed", left.select("rep").distinct().join(reps.select("rep", "s1", "s2", "first"), "rep"))
    again = own.mapInArrow(_sets(shingle, bit_filter(needed, "s1")), sets)
    same = [F.col("first")[f.name].eqNullSafe(F.col(f"own.{f.name}")) for f in columns]
    shingles = again.alias("own").join(needed.alias("needed"), [F.col(f"own.{c}") == F.col(f"needed.{c}") for c in ("s1", "s2")] + same).groupBy("rep").agg(F.first("body").alias("shingles"))
    found = by_block(left.join(bodies, "rep").join(shingles, "rep").select(*_ONE, "rep", "copies", "body", "shingles")).mapInArrow(_verified(least, threshold), f"{_HEAD}, reps array<long>, copies array<long>, bodies array<binary>, shingles array<binary>, links array<long>, to array<long>")
    found = scratch.keep("found", found)
    single = found.filter("blocks = 1").select(F.inline(F.arrays_zip(F.col("reps").alias("rep"), "links", "to")))
    checked = single.unionByName(in_pairs(found, ["reps", "copies", "bodies", "shingles"]).mapInArrow(_pair_verified(least, threshold), "rep long, links long, to long"))
    links = scratch.keep("links", checked.groupBy("rep", "to").agg(F.sum("links").alias("links")))
    roots = connected(links.select(F.col("rep").alias("a"), F.col("to").alias("b")))
    counts = links.groupBy("rep").agg(F.sum("links").alias("links"))
    per_rep = reps.select("rep", "s1", "s2", "first", "copies").join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    per_rep = scratch.keep("roots", per_rep)
    names = scratch.keep("names", per_rep.groupBy("root").agg(F.min("first").alias("first")))
    scratch.drop("bands", "pruned", "left", "needed", "found")
    return signed_rows, per_rep.drop("first").join(names, "root").join(counts, "rep", "left").select("root", "s1", "s2", "first", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row for each row of ``docs``: (doc_id, class_id, n_links).

    ``n_links`` counts the other rows whose set has Jaccard similarity ``threshold`` or more, equal texts included;
    ``class_id`` is the least id of the rows joined by links. A text of fewer words than a shingle is one
    shingle. Rows without a word (null, empty, punctuation) have no set: no link, and their own id as class.
    Rows that repeat an id are rows of their own. Empty tables give no rows; other columns are not read.
    """
    own = _own(docs, id_col, text_col)
    signed_rows, per_set = _classes(own, shingle, threshold, tolerance)
    linked = signed_rows.select("id", "s1", "s2").join(per_set, ["s1", "s2"]).select(F.col("id").alias("doc_id"), F.col("first.id").alias("class_id"), "n_links")
    wordless = own.filter(_wordless("text")).select(F.col("id").alias("doc_id"), F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return linked.unionByName(wordless)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class, also where ids repeat or are null: that of the least id, null ids last.

    Of several such rows the one with the least digest of id and text stays, and any one of rows equal in both.
    Rows without a word are classes of their own and stay.
    """
    # Id and text tell rows apart as far as it matters here, so rows need no number and no copy.
    key = F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text_col), F.lit(""))))).alias("key")
    own = docs.select(F.col(id_col).cast("long").alias("id"), key, F.col(text_col).alias("text"))
    _, per_set = _classes(own, SHINGLE, THRESHOLD, TOLERANCE)
    first = per_set.select("first.key").distinct()
    whole = docs.filter(~_wordless(text_col)).select(key, F.struct(*docs.columns).alias("whole"))
    kept = whole.dropDuplicates(["key"]).join(first, "key", "left_semi").select("whole.*")
    return kept.unionByName(docs.filter(_wordless(text_col)))
