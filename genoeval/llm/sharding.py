"""Sharding by a minimax contiguous partition; DataFrame functions only.

Rows with equal texts form one atomic group. Groups are ordered by the digest of their text, which no
source or hot key can skew (groups larger than a fair share first), and cut into ``shards`` contiguous runs so that the largest run is as small
as possible: the smallest capacity for which a greedy walk needs no more than ``shards`` runs. Within that capacity the cuts
are spread evenly, so that one group larger than a fair share does not leave other shards empty.

The walk only ever asks for "the last group end at or below a position". A histogram of group ends, of
bounded size, brackets that answer from both sides, so most capacities are decided from the histogram;
the positions that still matter are read again at a finer grain until the capacity is settled exactly.
The driver holds at most ``bins`` histogram rows and ``shards`` cuts, whatever the input.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

BINS = 40_000
#: Rows that a run of groups, or a part of a shard, holds about at most: more rows make more of them.
RUN_ROWS = 100_000


def _ends(groups: DataFrame) -> DataFrame:
    """End position of each group in digest order, by two-level running sums: (key, end)."""
    by_chunk = groups.groupBy("chunk").agg(F.sum("bytes").alias("chunk_bytes"))
    before = by_chunk.select("chunk", (F.sum("chunk_bytes").over(Window.orderBy("chunk")) - F.col("chunk_bytes")).alias("before"))
    inside = F.sum("bytes").over(Window.partitionBy("chunk").orderBy("key"))
    return groups.withColumn("inside", inside).join(F.broadcast(before), "chunk").select("key", (F.col("before") + F.col("inside")).alias("end"))


class _Ends:
    """What is known of the group ends: disjoint bins (least, greatest) in order, made finer where that is asked for."""

    def __init__(self, ends: DataFrame, total: int, bins: int):
        self.ends, self.bins, self.known = ends, bins, [(0, 0)]
        self.refine([(1, total)])

    def refine(self, spans: list[tuple[int, int]]) -> None:
        """Read the ends of these spans again, ``bins`` bins over all of them; spans cover whole bins."""
        merged: list[tuple[int, int]] = []
        for a, z in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(z, merged[-1][1]))
            else:
                merged.append((a, z))
        width = max(1, sum(z - a + 1 for a, z in merged) // self.bins)
        inside = F.exists(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(z).alias("z")) for a, z in merged]), lambda w: F.col("end").between(w["a"], w["z"]))
        rows = self.ends.filter(inside).groupBy(F.expr(f"end div {width}").alias("bin")).agg(F.min("end").alias("low"), F.max("end").alias("high")).collect()
        kept = [k for k in self.known if k == (0, 0) or not any(a <= k[0] and k[1] <= z for a, z in merged)]  # position 0 is no group's end
        self.known = sorted(kept + [(r["low"], r["high"]) for r in rows])
        self.low, self.high = [k[0] for k in self.known], [k[1] for k in self.known]

    def floor(self, position: int) -> tuple[int, int]:
        """Bounds on the last end at or below a position."""
        i = bisect_right(self.low, position) - 1
        return (self.high[i],) * 2 if self.high[i] <= position else (self.low[i], position)

    def ceiling(self, position: int) -> tuple[int, int]:
        """Bounds on the first end at or above a position (the last end, beyond it)."""
        i = min(bisect_left(self.high, position), len(self.low) - 1)
        return (self.low[i],) * 2 if self.low[i] >= position else (position, self.high[i])

    def span(self, low: int, high: int) -> tuple[int, int]:
        """The whole bins that hold a range."""
        i, j = max(0, bisect_right(self.low, low) - 1), max(0, bisect_right(self.low, high) - 1)
        return self.low[i], max(high, self.high[j])


def _walk(ends: _Ends, capacity: int, shards: int, bound: int) -> list[int]:
    """Greedy cuts when every uncertain answer is the lower (bound 0) or the upper (1) one."""
    cuts = [0]
    for _ in range(shards):
        cuts.append(ends.floor(cuts[-1] + capacity)[bound])
    return cuts


def _search(known: _Ends, total: int, largest: int, shards: int) -> tuple[int, list[int]]:
    low, high = max(largest, -(-total // shards)) - 1, max(largest, -(-total // shards)) + largest
    while True:

        def bisect(bound: int, lo: int, hi: int) -> int:
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (lo, mid) if _walk(known, mid, shards, bound)[-1] >= total else (mid, hi)
            return hi

        high = bisect(0, low, high)  # surely feasible
        low = bisect(1, low, high) - 1  # surely not
        a, z = _walk(known, low + 1, shards, 0), _walk(known, high, shards, 1)
        if high - low == 1 and a == z:
            return high, a
        known.refine([known.span(x, y) for x, y in zip(a, z, strict=True)])


def smallest_capacity(ends: DataFrame, total: int, largest: int, shards: int, bins: int = BINS) -> tuple[int, list[int]]:
    """The least feasible capacity and its greedy cuts (positions, ``shards`` + 1 of them)."""
    return _search(_Ends(ends, total, bins), total, largest, shards)


def even_cuts(ends: DataFrame, total: int, largest: int, shards: int, bins: int = BINS) -> tuple[int, list[int]]:
    """The least feasible capacity, and cuts within it that spread what is left evenly over the shards still to fill.

    Each cut lies at the group end nearest to its even share, not past the capacity, and not before the earliest
    place from which the rest still fits.
    """
    known = _Ends(ends, total, bins)
    capacity, _ = _search(known, total, largest, shards)
    while True:
        unsure: list[tuple[int, int]] = []

        def exact(bounds: tuple[int, int], pick: int, unsure: list = unsure) -> int:
            if bounds[0] != bounds[1]:
                unsure.append(known.span(*bounds))
            return bounds[pick]

        need = [total]
        for _ in range(shards):
            need.append(exact(known.ceiling(max(0, need[-1] - capacity)), 1))
        need.reverse()
        cuts = [0]
        for k in range(1, shards):
            share = cuts[-1] + (total - cuts[-1]) // (shards - k + 1)
            before, after = exact(known.floor(min(share, cuts[-1] + capacity)), 0), exact(known.ceiling(share), 1)
            near = after if after <= cuts[-1] + capacity and (before <= cuts[-1] or after - share < share - before) else before
            cuts.append(max(near, need[k], cuts[-1]))
        if not unsure:
            return capacity, [*cuts, total]
        known.refine(unsure)


def _huge(groups: DataFrame, total: int, shards: int) -> list[str]:
    """Groups larger than the fair share of what is left: fewer than ``shards`` of them can exist."""
    out: list[str] = []
    for r in groups.orderBy(F.desc("bytes"), "key").limit(shards).collect():
        if len(out) + 1 >= shards or r["bytes"] * (shards - len(out)) <= total:
            break
        out.append(r["key"])
        total -= r["bytes"]
    return out


def shard_contiguous(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16) -> DataFrame:
    """Put every row into one of ``shards`` shards: (id, size, text_crc32, law, shard, slot, grown_shard).

    A null text has ``overhead`` bytes and no checksum of its own (0, as for no bytes); nulls are one group, apart
    from empty texts. Ties cannot occur between groups (digests differ); equal rows keep equal keys and get
    neighbouring slots. An empty table gives no rows. Other columns of ``docs`` are not read.
    """
    raw = F.encode(F.col(text_col), "UTF-8")
    # Texts are read and hashed once; all that follows works on these narrow rows.
    scratch = Scratch(docs.sparkSession, "shards")
    rows = scratch.keep("rows", docs.select(
        F.col(id_col).alias("doc_id"), (F.coalesce(F.octet_length(text_col), F.lit(0)) + F.lit(overhead)).cast("long").alias("size"),
        F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"), F.coalesce(F.md5(raw), F.lit("")).alias("key"),
    ))
    groups = scratch.keep("groups", rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")))
    total = groups.agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("most"), F.sum("n").alias("n")).first()
    huge = _huge(groups, total["bytes"] or 0, shards)
    if huge:  # they come first
        first = lambda df: df.withColumn("key", F.when(F.col("key").isin(*huge), F.concat(F.lit("!"), "key")).otherwise(F.col("key")))
        rows, groups = first(rows), first(groups)
    digits = next((d for d in (3, 4) if (total["n"] or 0) <= RUN_ROWS * 16**d), 5)
    groups = groups.withColumn("chunk", F.when(F.col("key").rlike("^[0-9a-f]"), F.conv(F.substring("key", 1, digits), 16, 10).cast("int")).otherwise(0))
    cut_keys = []
    if total["n"]:
        ends = scratch.keep("ends", _ends(groups))
        _, cuts = even_cuts(ends, total["bytes"], total["most"], shards)
        cut_keys = sorted(r["key"] for r in ends.filter(F.col("end").isin(cuts[1:-1])).select("key").collect())
    # A row's shard is the number of cuts before its key: no join, so no hot key.
    shard = F.lit(0)
    for k in cut_keys:
        shard += (F.col("key") > k).cast("int")
    parts = max(16, -(-(total["n"] or 0) // (shards * RUN_ROWS)))
    placed = rows.withColumn("shard", shard.cast("int")).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int"))
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("in_part"))
    before = counts.select("shard", "part", (F.sum("in_part").over(Window.partitionBy("shard").orderBy("part")) - F.col("in_part")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("key", "doc_id"))
    return (
        placed.withColumn("inside", inside).join(before, ["shard", "part"])
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("inside") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )
