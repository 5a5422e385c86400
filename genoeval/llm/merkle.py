"""A dataset manifest: hash trees over ordered rows, with a proof for every row.

Every node is labelled with the interval of leaf ranks that it covers, in its tree and level. A node's parent at the
next level is the one whose interval contains its own: both fall into the same bucket of ``WIDTH ** level`` ranks, so
ancestors are attached by equi-joins on (tree, bucket) with the containment as condition, and the siblings of a node
are what is left of its parent's interval without its own. Nodes of a level are a table; a tree is as high as its
leaves need, and trees of any number and any height go through the same jobs, level by level.

Ranks come from one range-partitioned sort: a row's place in its partition, plus the rows of its tree in the partitions
before, which are as many as there are partitions. No key, however frequent, is in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import Scratch, sha_hex

#: Children of a node.
WIDTH = 8
#: The columns of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_BITS = 33  # of a partition's rows in monotonically_increasing_id


def encoded(value: Column) -> Column:
    """A value so that sequences of them are unambiguous: ``-`` for null, else its UTF-8 length, ``:`` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


@F.arrow_udf(StringType())
def ascii_lower(text: pa.Array) -> pa.Array:
    """A-Z lower-cased, anything else as it is (``translate`` takes a hundred times as long, ``lower`` changes more)."""
    return pc.ascii_lower(text)


def leaf_digest(*values: Column) -> Column:
    return sha_hex(F.concat(*[encoded(v) for v in values]))


def ranked(scratch: Scratch, name: str, rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``lo`` (place in the row's ``tree``, from 0), ``hi`` = lo + 1 and ``size`` (rows of the tree).

    Nulls come first, strings go by bytes. Rows that are equal in ``order`` take places in any order, so ``order`` ends
    with whatever tells rows apart.
    """
    dealt = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    stored = scratch.keep(f"{name}-sorted", dealt.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _BITS).alias("_part")
    runs = stored.groupBy("tree", part).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy("tree")
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = scratch.keep(f"{name}-runs", runs.select("tree", "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("size")))
    placed = stored.withColumn("_part", F.shiftright("_at", _BITS)).join(runs, ["tree", "_part"])
    return placed.withColumn("lo", F.col("_at") + F.col("_shift")).withColumn("hi", F.col("lo") + 1).drop("_at", "_part", "_shift")


@dataclass
class Trees:
    """Leaves (tree, lo, hi, size, digest, other columns), and by level above them (tree, bucket, lo, hi, size, digest, children)."""

    leaves: DataFrame
    levels: list[DataFrame]

    def roots(self) -> DataFrame:
        """(tree, digest): the nodes that cover all of their tree."""
        out = self.leaves.filter("size = 1").select("tree", "digest")
        for level in self.levels:
            out = out.union(level.filter("hi - lo = size").select("tree", "digest"))
        return out


def build(scratch: Scratch, name: str, rows: DataFrame, order: list[str]) -> Trees:
    """The hash tree of each ``tree`` of rows (tree, digest, other columns), whose leaves ascend by ``order``."""
    leaves = ranked(scratch, name, rows, order)
    most = leaves.agg(F.max("size")).first()[0] or 0
    nodes, levels, width = leaves, [], WIDTH
    while WIDTH * most > width:  # the highest tree's root has all leaves in one bucket
        others = [c for c in nodes.columns if c not in ("tree", "bucket", "lo", "hi", "size", "digest", "children")]
        child = F.struct("lo", "hi", "digest", *others)
        grouped = nodes.filter("hi - lo < size").groupBy("tree", F.expr(f"lo div {width}").alias("bucket")).agg(F.sort_array(F.collect_list(child)).alias("children"), F.first("size").alias("size"))
        digest = sha_hex(F.array_join(F.transform("children", lambda c: c["digest"]), ""))
        level = grouped.select("tree", "bucket", F.col("children")[0]["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"), "size", digest.alias("digest"), "children")
        nodes = scratch.keep(f"{name}-{len(levels) + 1}", level)
        levels.append(nodes)
        width *= WIDTH
    return Trees(leaves, levels)


def _step(siblings: Column, lo: Column, hi: Column) -> Column:
    """What stands beside [lo, hi) in its parent's interval, as one step of a proof."""
    joined = lambda c: F.array_join(F.transform(c, lambda s: s["digest"]), "")
    return F.array(F.struct(joined(F.filter(siblings, lambda s: s["hi"] <= lo)).alias("left"), joined(F.filter(siblings, lambda s: s["lo"] >= hi)).alias("right")))


def proofs(trees: Trees, context: DataFrame) -> DataFrame:
    """The leaves with ``path``: steps (left, right) from the leaf to the root, then those of their tree's ``context``.

    ``context`` has a row a tree: tree, path, and columns that every leaf gets.
    """
    given = [c for c in context.columns if c not in ("tree", "path")]
    own = [c for c in trees.leaves.columns if c not in ("tree", "lo", "hi", "size")]
    above, width = None, WIDTH ** (len(trees.levels) + 1)  # of a parent's bucket
    for level in reversed(trees.levels):
        nodes = level.filter("hi - lo = size").select("tree", "bucket", "lo", "hi", "children").join(context, "tree")
        if above is not None:
            parents = above.select("tree", F.col("bucket").alias("up"), F.col("lo").alias("plo"), F.col("hi").alias("phi"), F.col("children").alias("siblings"), "path", *given)
            inner = level.filter("hi - lo < size").select("tree", "bucket", "lo", "hi", "children", F.expr(f"lo div {width}").alias("up")).join(parents, ["tree", "up"]).filter("plo <= lo and hi <= phi")
            steps = F.concat(_step(F.col("siblings"), F.col("lo"), F.col("hi")), "path")
            nodes = nodes.unionByName(inner.select("tree", "bucket", "lo", "hi", "children", steps.alias("path"), *given))
        above = nodes
        width //= WIDTH
    alone = trees.leaves.filter("size = 1").join(context, "tree").select("tree", "lo", *own, "path", *given)
    if above is None:
        return alone
    leaf = above.select("tree", "children", "path", *given, F.explode("children").alias("c"))
    steps = F.concat(_step(F.col("children"), F.col("c.lo"), F.col("c.hi")), "path")
    return leaf.select("tree", F.col("c.lo").alias("lo"), *[F.col(f"c.{c}").alias(c) for c in own], steps.alias("path"), *given).unionByName(alone)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the steps of its proof give."""
    return F.aggregate(path, leaf, lambda acc, p: sha_hex(F.concat(p["left"], acc, p["right"])))


def proof_digest(path: Column) -> Column:
    return sha_hex(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""))


def manifest(rows: DataFrame, group: str, order: list[str], leaf: str = "leaf") -> DataFrame:
    """``rows`` with subroot, root, path and lo: a tree of each value of ``group``, and one over their roots.

    Leaves ascend by ``order`` (nulls first), equal ones by digest, so results do not depend on how rows lie; rows
    alike in all of it are alike. Groups ascend, null first, strings by bytes. An empty table gives no rows. Columns of
    ``rows`` are kept, whatever their names, but for those made here.
    """
    scratch = Scratch(rows.sparkSession, "merkle")
    kept = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")
    # Stored before they are sorted: a range partition reads its input twice.
    keyed = scratch.keep("keyed", rows.select(encoded(F.col(group)).alias("tree"), *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(order)], F.col(leaf).alias("digest"), kept))
    keys = [f"k{i}" for i in range(len(order))]
    trees = build(scratch, "rows", keyed, [*keys, "digest"])
    # An encoded group has its length before it, so the order of groups is that of their values.
    value = F.when(F.col("tree") != "-", F.expr("substring(tree, instr(tree, ':') + 1)"))
    groups = trees.roots().select(F.lit("").alias("tree"), value.alias("value"), F.col("tree").alias("of"), "digest")
    top = build(scratch, "groups", scratch.keep("roots", groups), ["value"])
    whole = top.roots().select("tree", F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.col("digest").alias("root"))
    context = proofs(top, whole).select(F.col("of").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    return proofs(trees, scratch.keep("context", context)).select("row.*", "lo", "subroot", "root", "path")


def verify_digest(docs: DataFrame) -> DataFrame:
    """Every row's leaf, proof and the root that its possibly tampered copy folds to.

    A row is tampered with where 3 divides the CRC-32 of its decimal id: its text's A-Z are lower-cased. Null ids and
    null texts are never changed. Null values, empty texts and repeated rows are leaves like others.
    """
    values = [F.col(c) for c in FIELDS]
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    leaf = leaf_digest(*values)
    claimed = F.when(chosen, leaf_digest(*values[:-1], ascii_lower(F.when(chosen, F.col("text"))))).otherwise(leaf)
    rows = docs.select("doc_id", "lang", leaf.alias("leaf"), claimed.alias("claimed"))
    out = manifest(rows, "lang", ["doc_id"])
    back = folded(F.col("claimed"), F.col("path"))
    out = out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), back.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
