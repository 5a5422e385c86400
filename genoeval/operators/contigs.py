"""Chromosome names: style, renaming, restriction, selection."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.genotypes import canonical_chrom

CHROMOSOMES = 17


def default_chroms(n: int = CHROMOSOMES) -> list[str]:
    return [f"Chr{i:02d}" for i in range(1, n + 1)]


def style_of(name: Column) -> Column:
    return F.when(name.isNull(), None).when(name.rlike("^Chr[0-9]+"), "ChrNN").when(name.rlike("^chr[0-9]+"), "chrN").when(name.rlike("^[0-9]+$"), "N").otherwise("other")


def contig_style(sites: DataFrame, order: str = "rec_ord") -> str | None:
    """Style of the first record; None for an empty table. Only the least record order is read."""
    row = sites.agg(F.min_by("chrom", order).alias("chrom")).select(style_of(F.col("chrom")).alias("style")).first()
    return row["style"]


def normalize_contigs(sites: DataFrame, style: str | None, n: int = CHROMOSOMES) -> DataFrame:
    """Rename chr1 or 1 to Chr01 and so on; names in ChrNN style, and names outside the map, stay as they are."""
    if style == "ChrNN" or style is None:
        return sites
    prefix = "chr" if style == "chrN" else ""
    names = F.create_map(*[x for i in range(1, n + 1) for x in (F.lit(f"{prefix}{i}"), F.lit(f"Chr{i:02d}"))])
    return sites.withColumn("chrom", F.coalesce(F.try_element_at(names, F.col("chrom")), F.col("chrom")))


def canonical_name(name: str) -> str | None:
    """``canonical_chrom`` of one name, for names of files."""
    m = re.fullmatch(r"(?:chr)?(?:Chr)?([0-9]+)", name)
    return f"Chr{int(m[1]):02d}" if m and int(m[1]) <= 99 else None


def restrict_contigs(sites: DataFrame, chroms: list[str] | None = None) -> DataFrame:
    return sites.filter(F.col("chrom").isin(*(chroms or default_chroms())))


def canonicalize(sites: DataFrame) -> DataFrame:
    """Canonical names, other contigs dropped; ``contig`` keeps the name. See ``assert_one_contig``."""
    return sites.withColumn("contig", F.col("chrom")).withColumn("chrom", canonical_chrom(F.col("contig"))).filter("chrom is not null")


def clashing_contigs(sites: DataFrame) -> DataFrame:
    """Chromosomes to which more than one contig resolves."""
    named = sites if "contig" in sites.columns else canonicalize(sites)
    return named.groupBy("chrom").agg(F.sort_array(F.collect_set("contig")).alias("contigs")).filter(F.size("contigs") > 1)


def assert_one_contig(sites: DataFrame, what: str) -> None:
    """Two contigs of one chromosome (Chr1 and chr01) must not be mixed."""
    clashes = clashing_contigs(sites).orderBy("chrom").limit(5).collect()
    if clashes:
        raise ValueError(f"{what}: {'; '.join(', '.join(r['contigs']) + ' are all ' + r['chrom'] for r in clashes)}")


def standardise_panel(sites: DataFrame, order: str = "rec_ord") -> DataFrame:
    """Panel contigs: unchanged if the first starts with chr in any case, else mapped from bare numbers."""
    first = sites.agg(F.min_by("chrom", order).alias("chrom")).first()["chrom"]
    return sites if first is None or first.lower().startswith("chr") else normalize_contigs(sites, "N")


def select_chroms(truth: DataFrame, imputed: DataFrame, requested: list[str] | None = None) -> DataFrame:
    """Chromosomes on both sides, in numeric order; Chr00 only if it is requested."""
    both = truth.select("chrom").distinct().intersect(imputed.select("chrom").distinct())
    keep = F.col("chrom").isin(*requested) if requested else F.col("chrom") != "Chr00"
    return both.filter(keep).withColumn("number", F.substring("chrom", 4, 2).cast("int")).orderBy("number").select("chrom")


def chroms_of(manifest: DataFrame, order: str = "ord") -> DataFrame:
    """Distinct chromosomes in order of first appearance."""
    return manifest.groupBy("chrom").agg(F.min(order).alias("first_ord"))
