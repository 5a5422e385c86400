"""Intersections, alignments and set operations between two site tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.genotypes import is_ambiguous

POSITION, VARIANT = ["chrom", "pos"], ["chrom", "pos", "ref", "alt"]


def common_samples(a: DataFrame, b: DataFrame, order: str = "sample") -> DataFrame:
    """Samples of ``a`` that ``b`` has, by name or by ``sample_idx`` of ``a``."""
    return a.join(b.select("sample").distinct(), "sample", "left_semi").orderBy(order)


def missing_samples(requested: DataFrame, available: DataFrame, examples: int = 5) -> DataFrame:
    return requested.join(available, "sample", "left_anti").orderBy("sample").limit(examples)


def common_positions(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select(*POSITION).intersect(b.select(*POSITION))


def semi_positions(sites: DataFrame, positions: DataFrame) -> DataFrame:
    return sites.join(positions, POSITION, "left_semi")


def ambiguous_loci(a: DataFrame, b: DataFrame, names: tuple[str, str] = ("imputed", "truth")) -> DataFrame:
    """Distinct ambiguous records of both sides with their source."""
    parts = [x.filter(is_ambiguous(F.col("ref"), F.col("alt"))).select(*VARIANT, F.lit(n).alias("source")) for x, n in zip((a, b), names, strict=True)]
    return parts[0].union(parts[1]).distinct()


def drop_ambiguous(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables without the positions at which either has an ambiguous record."""
    gone = ambiguous_loci(a, b).select(*POSITION).distinct()
    return a.join(gone, POSITION, "left_anti"), b.join(gone, POSITION, "left_anti")


def isec(imputed: DataFrame, truth: DataFrame) -> DataFrame:
    """One full outer join on the exact variant: columns of both (suffixes _imputed, _truth) and ``side``."""
    left = imputed.select(*VARIANT, *[F.col(c).alias(f"{c}_imputed") for c in imputed.columns if c not in VARIANT], F.lit(True).alias("in_imputed"))
    right = truth.select(*VARIANT, *[F.col(c).alias(f"{c}_truth") for c in truth.columns if c not in VARIANT], F.lit(True).alias("in_truth"))
    side = F.when(F.col("in_imputed") & F.col("in_truth"), "matched").when(F.col("in_imputed"), "imputed_only").otherwise("truth_only")
    return left.join(right, VARIANT, "full_outer").withColumn("side", side).drop("in_imputed", "in_truth")


def align(truth: DataFrame, imputed: DataFrame) -> DataFrame:
    """Truth with the imputed columns of its position; truth loci that imputed lacks raise when read."""
    other = imputed.select(*POSITION, *[F.col(c).alias(f"{c}_imputed") for c in imputed.columns if c not in POSITION], F.lit(True).alias("found"))
    checked = F.when(F.col("found"), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("no imputed record at "), "chrom", F.lit(":"), F.col("pos").cast("string"))))
    return truth.join(other, POSITION, "left").withColumn("found", checked).filter("found").drop("found")


def allele_mismatches(imputed: DataFrame, truth: DataFrame) -> DataFrame:
    """Record pairs at one position whose REF or ALT differ."""
    a = imputed.select(*POSITION, F.col("ref").alias("ref_imputed"), F.col("alt").alias("alt_imputed"))
    b = truth.select(*POSITION, F.col("ref").alias("ref_truth"), F.col("alt").alias("alt_truth"))
    return a.join(b, POSITION).filter("ref_imputed <> ref_truth OR alt_imputed <> alt_truth")


def mismatches_of(joined: DataFrame) -> DataFrame:
    """The same pairs, out of ``isec``'s result: a position's records of both sides, which are few, are paired inside the row."""
    allele = F.struct("ref", "alt")
    at = joined.groupBy(*POSITION).agg(F.collect_list(F.when(F.col("side") != "truth_only", allele)).alias("i"), F.collect_list(F.when(F.col("side") != "imputed_only", allele)).alias("t"))
    pairs = at.filter((F.size("i") + F.size("t") > 2) | ((F.size("i") == 1) & (F.size("t") == 1))).select(*POSITION, F.explode("i").alias("i"), "t").select(*POSITION, "i", F.explode("t").alias("t"))
    return pairs.select(*POSITION, F.col("i.ref").alias("ref_imputed"), F.col("i.alt").alias("alt_imputed"), F.col("t.ref").alias("ref_truth"), F.col("t.alt").alias("alt_truth")).filter("ref_imputed <> ref_truth OR alt_imputed <> alt_truth")


def dedup_first(sites: DataFrame, keys: list[str] | None = None, order: str = "rec_ord") -> DataFrame:
    """The first record of each position (or of ``keys``) in record order."""
    rank = F.row_number().over(Window.partitionBy(*(keys or POSITION)).orderBy(order))
    return sites.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def duplicates_removed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Multiset difference: the records that deduplication took away."""
    return before.select(*VARIANT).exceptAll(after.select(*VARIANT))


def position_divergence(a: DataFrame, b: DataFrame) -> DataFrame:
    """Positions that only one side has, with that side."""
    left, right = a.select(*POSITION), b.select(*POSITION)
    return left.subtract(right).withColumn("only_in", F.lit("a")).union(right.subtract(left).withColumn("only_in", F.lit("b")))


def ds_with_gp(ds: DataFrame, gp: DataFrame) -> DataFrame:
    """Dosage by (chrom, pos, sample), from genotype probabilities where it is null. See ``assert_dosages``."""
    keys = [*POSITION, "sample"]
    return ds.join(gp.select(*keys, F.col("ds").alias("gp_ds")), keys, "left").withColumn("ds", F.coalesce("ds", "gp_ds")).drop("gp_ds")


def assert_dosages(ds: DataFrame, what: str) -> None:
    """A table without a single dosage, also after the fallback, is refused."""
    if ds.filter("ds is not null").isEmpty():
        raise ValueError(f"{what}: no dosage in DS or GP")


def assert_same_positions(a: DataFrame, b: DataFrame) -> None:
    """Both tables must hold the same positions; the first that only one has are named."""
    odd = position_divergence(a, b).orderBy(*POSITION).limit(5).collect()
    if odd:
        raise ValueError(f"positions differ, e.g. {[tuple(r) for r in odd]}")


def genome_wide(parts: list[DataFrame]) -> DataFrame:
    """Chromosomes one after another, columns that only some have filled with nulls."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
