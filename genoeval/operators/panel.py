"""Reference panel cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sites import filter_panel


def panel_report(sites: DataFrame, rate: float = 0.95) -> DataFrame:
    """(chrom, total, removed, kept, min_valid_gt_rate); chromosomes come from ``sites``."""
    return report_of(filter_panel(sites, rate), rate)


def report_of(judged: DataFrame, rate: float = 0.95) -> DataFrame:
    """The same from sites with ``keep``."""
    counted = judged.groupBy("chrom").agg(F.count("*").alias("total"), F.count_if(~F.col("keep")).alias("removed"), F.count_if("keep").alias("kept"))
    return counted.withColumn("min_valid_gt_rate", F.lit(float(rate)))


#: Fixed file names of a chromosome's panel, relative to the panel's folder, in order; callers add those of their own set-up.
PANEL_FILES = ("standardised/{}_chr.vcf.gz", "{}_chr.vcf.gz", "panel.snps.clean__{}.vcf.gz", "{}.vcf.gz")


def choose_panel_files(listing: DataFrame, chroms: DataFrame, candidates: tuple[str, ...] = PANEL_FILES) -> DataFrame:
    """One file a chromosome out of (path, length): phased first, then beagle, then any other; empty files never.

    Within a kind the fixed names come first, in their order, then names that start with the chromosome and ``_``, ``.``
    or ``-``, by name; so Chr1 does not match Chr10.
    """
    from pyspark.sql import Window

    files = listing.filter("length > 0").withColumn("name", F.element_at(F.split("path", "/"), -1))
    fixed = F.array(*[F.struct(F.lit(i).alias("at"), F.format_string(c.replace("{}", "%s"), "chrom").alias("file")) for i, c in enumerate(candidates)])
    named = chroms.select("chrom", F.inline(fixed))
    by_name = files.join(named, F.col("path").endswith(F.concat(F.lit("/"), F.col("file"))) & (F.element_at(F.split("file", "/"), -1) == F.col("name"))).select("chrom", "path", "name", "at")
    start = F.regexp_extract("name", r"^([^_.-]+)[_.-].*\.vcf\.gz$", 1)
    loose = files.withColumn("chrom", start).join(chroms, "chrom").select("chrom", "path", "name", F.lit(len(candidates)).alias("at"))
    kind = F.when(F.col("name").rlike(r"phased\.vcf\.gz$"), 0).when(F.col("name").rlike(r"beagle\.vcf\.gz$"), 1).otherwise(2)
    rank = F.row_number().over(Window.partitionBy("chrom").orderBy("kind", "at", "name", "path"))
    return by_name.union(loose).withColumn("kind", kind).withColumn("rank", rank).filter("rank = 1").select("chrom", "path")
