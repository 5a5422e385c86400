"""Evaluation against whole-genome truth, from site tables or VCF text to metrics."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import chunks, contigs, incremental, joins, metrics
from ..operators.sites import Thresholds, assert_format, assert_reference, biallelic_snps, canonical_region, filter_reasons, in_region, site_filter
from ..sources import vcf
from ..sources.scratch import children, shared_folder


def evaluate(retained: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """(sample_idx, maf_bin, sums, r, r2) of retained matched sites with raw call arrays; bin -1 is overall."""
    pairs = retained.withColumn("x", metrics.imputed_dosages(F.col("imputed_gt"))).withColumn("y", metrics.mask_truth(F.col("truth_gt"), F.col("gq"), F.col("dp"), t))
    return metrics.finalize_stats(metrics.sample_stats(pairs))


@dataclass
class WgsResult:
    """All tables of one evaluation; each is lazy over the same stored join. ``counts`` and ``masks`` merge over chromosomes."""

    joined: DataFrame
    variant_metrics: DataFrame
    sample_metrics: DataFrame
    site_filtered: DataFrame
    imputed_only: DataFrame
    truth_only: DataFrame
    allele_mismatches: DataFrame
    counts: DataFrame
    masks: DataFrame
    sample_stats: DataFrame
    filter_summary: DataFrame
    masking_summary: DataFrame
    observed: dict[str, int] = field(default_factory=dict)


@dataclass
class Side:
    """One input: raw site rows, the samples of their calls, the files read, and its chromosomes where their names say them."""

    sites: DataFrame
    samples: DataFrame
    paths: list[str]
    chroms: list[str] | None = None


def vcf_side(spark: SparkSession, path: str) -> Side:
    return Side(vcf.read_vcf(spark, path), vcf.read_vcf_samples(spark, path), [path])


def chunk_side(spark: SparkSession, folder: str, manifest: DataFrame | None = None) -> Side:
    """Chunk files of a run, overlaps trimmed; windows come from their names. Chunks that ``manifest`` lists must be there."""
    found = vcf.chunk_files(spark, folder)
    if not found:
        raise ValueError(f"{folder} has no chunk")
    if manifest is not None:
        chunks.assert_chunks(manifest, [f[1:4] + f[5:] for f in found])
    windows = spark.createDataFrame([f[:4] for f in found], "chunk_id string, chrom string, start long, end long")
    sites = chunks.stitch_chunks(vcf.read_chunks(spark, found), windows).drop("chunk_id")
    return Side(sites, vcf.read_vcf_samples(spark, [f[4] for f in found]), [f[4] for f in found], sorted({contigs.canonical_name(f[1]) or f[1] for f in found}))


def truth_side(spark: SparkSession, folder: str, suffix: str = "_consolidated.vcf.gz") -> Side:
    """A file a chromosome; names say which."""
    found = vcf.truth_files(spark, folder, suffix)
    if not found:
        raise ValueError(f"{folder} has no truth file")
    paths = sorted(found.values())
    return Side(vcf.read_vcf(spark, paths), vcf.read_vcf_samples(spark, paths), paths, sorted(found))


def store_side(side: Side, path: str, samples: list[str], chroms: list[str] | None, region: str | None, truth: bool, seen: Observation | None = None) -> DataFrame:
    """Typed sites of one side under ``path``: canonical contigs, selection, calls in sample order. The only scan of its text."""
    sites = contigs.canonicalize(side.sites)
    if chroms:
        sites = contigs.restrict_contigs(sites, chroms)
    sites = vcf.select_samples(in_region(sites, region), side.samples, samples)
    sites = vcf.with_format_fields(sites, ["GT", "GQ", "DP"] if truth else ["GT"])
    if truth:
        sites = vcf.with_info(sites)
    return vcf.ingest(sites.drop("calls", "info"), path, seen)


def stored_chroms(spark: SparkSession, path: str) -> list[str]:
    """The chromosomes of a stored side, by its folders."""
    return sorted(c.split("=", 1)[1] for c in children(spark, path) if c.startswith("CHROM_="))


def checked_side(stored: DataFrame, what: str, bases: DataFrame | None = None) -> DataFrame:
    """Biallelic SNPs of a stored side, exact duplicates gone.

    Two contigs of one chromosome, records without GT, and (where ``bases`` is given) a REF that is not the reference
    base raise.
    """
    contigs.assert_one_contig(stored, what)
    assert_format(stored, "GT", what)
    snps = biallelic_snps(stored)
    if bases is not None:
        assert_reference(snps, bases, what)
    return joins.dedup_first(snps, joins.VARIANT).drop("format", "contig", "rec_ord")


def results(joined: DataFrame, dimension: DataFrame, t: Thresholds) -> WgsResult:
    """All tables out of the stored join of both sides."""
    matched = joined.filter("side = 'matched'").withColumnRenamed("site_filter_pass_truth", "site_filter_pass").withColumnRenamed("site_filter_reasons_truth", "site_filter_reasons")
    kept = matched.filter("site_filter_pass")
    pairs = kept.withColumn("x", metrics.imputed_dosages(F.col("imputed_gt"))).withColumn("y", metrics.mask_truth(F.col("truth_gt"), F.col("gq"), F.col("dp"), t))
    ids = [F.col("id_imputed").alias("id"), "id_truth"]
    mismatches = joins.mismatches_of(joined)
    plain = joined.select("chrom", "pos", "side", *[F.col(f"{c}_truth").alias(c) for c in ("qual", "qd", "sor", "fs", "mq", "mq_rank_sum", "read_pos_rank_sum", "site_filter_pass")])
    stats = metrics.sample_stats(pairs)
    counts = metrics.filter_counts(plain, filter_reasons(t))
    masks = metrics.masking_counts(kept, dimension, t)
    return WgsResult(
        joined=joined,
        variant_metrics=metrics.variant_metrics_wgs(pairs).select(*joins.VARIANT, *ids, "n_pairs", "truth_alt_frequency", "truth_maf", "r", "r2", "concordance"),
        sample_metrics=metrics.sample_report(stats, dimension),
        site_filtered=matched.filter("not site_filter_pass").select(*joins.VARIANT, *ids, "site_filter_pass", "site_filter_reasons"),
        imputed_only=joined.filter("side = 'imputed_only'").select(*joins.VARIANT, F.col("id_imputed").alias("id")),
        truth_only=joined.filter("side = 'truth_only'").select(*joins.VARIANT, F.col("id_truth").alias("id")),
        allele_mismatches=mismatches,
        counts=counts,
        masks=masks,
        sample_stats=stats.join(dimension, "sample_idx"),
        filter_summary=metrics.filter_totals(counts, t),
        masking_summary=metrics.masking_totals(masks),
    )


def common(ours: DataFrame, theirs: DataFrame, samples: list[str] | None) -> list[str]:
    """The samples asked for, or those both sides have, in the imputed side's order."""
    if samples is not None:
        asked = ours.sparkSession.createDataFrame([(s,) for s in samples], "sample string")
        for name, side in (("imputed", ours), ("truth", theirs)):
            if absent := [r["sample"] for r in joins.missing_samples(asked, side).collect()]:
                raise ValueError(f"{name}: samples not in input: {', '.join(absent)}")
    chosen = samples if samples is not None else [r["sample"] for r in joins.common_samples(ours, theirs, "sample_idx").collect()]
    if not chosen:
        raise ValueError("no common samples")
    if len(set(chosen)) < len(chosen):
        raise ValueError("a sample is asked for twice")
    return chosen


def evaluate_stored(spark: SparkSession, ours: DataFrame, theirs: DataFrame, folder: str, chosen: list[str], t: Thresholds = Thresholds(), bases: DataFrame | None = None) -> WgsResult:
    """Every table of an evaluation out of two stored sides; their join is stored under ``folder``. No exact match raises.

    ``observed`` has the join's records by side, counted while it was written.
    """
    left, right = checked_side(ours, "imputed", bases), checked_side(theirs, "truth", bases)
    joined = joins.isec(left, site_filter(right, t)).withColumnRenamed("gt_imputed", "imputed_gt").withColumnRenamed("gt_truth", "truth_gt").withColumnRenamed("gq_truth", "gq").withColumnRenamed("dp_truth", "dp")
    seen = Observation()
    joined.observe(seen, *[F.count_if(F.col("side") == s).alias(s) for s in ("matched", "imputed_only", "truth_only")]).write.mode("overwrite").parquet(f"{folder}/joined")
    joined = spark.read.schema(joined.schema).parquet(f"{folder}/joined")
    counts = {s: incremental.observed(seen, s) for s in ("matched", "imputed_only", "truth_only")}
    if not counts["matched"]:
        raise ValueError("no exact shared variant")
    out = results(joined, spark.createDataFrame([(s, i) for i, s in enumerate(chosen)], "sample string, sample_idx int"), t)
    out.observed = counts
    return out


def evaluate_sides(spark: SparkSession, imputed: Side, truth: Side, folder: str, samples: list[str] | None = None, chroms: list[str] | None = None, region: str | None = None, t: Thresholds = Thresholds(), bases: DataFrame | None = None) -> WgsResult:
    """Every table of an evaluation; both sides and their join are stored under ``folder``, so that text is read once.

    All chromosomes go through the same jobs.
    """
    chosen, region = common(imputed.samples, truth.samples, samples), canonical_region(region, chroms)
    ours = store_side(imputed, f"{folder}/imputed", chosen, chroms, region, False)
    theirs = store_side(truth, f"{folder}/truth", chosen, chroms, region, True)
    return evaluate_stored(spark, ours, theirs, folder, chosen, t, bases)


def evaluate_vcf(spark: SparkSession, imputed_path: str, truth_path: str, samples: list[str] | None = None, region: str | None = None, t: Thresholds = Thresholds(), bases: DataFrame | None = None) -> WgsResult:
    """Samples default to those both files have, in the imputed file's order."""
    return evaluate_sides(spark, vcf_side(spark, imputed_path), vcf_side(spark, truth_path), shared_folder(spark, "wgs"), samples, None, region, t, bases)
