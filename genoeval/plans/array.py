"""Evaluation against array truth, and all-against-all sample matching; both share the preparation of two VCFs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import genotypes as g
from ..operators import contigs, incremental, joins, metrics, pairwise
from ..operators.sites import assert_unique, biallelic_snps, in_region
from ..sources import sinks, vcf
from ..sources.files import manifest_value
from ..sources.scratch import delete, has_content, input_files, shared_folder
from ..sources.vcf import ingest


@dataclass
class Prepared:
    """Both sides over the same unambiguous positions, and what was taken away."""

    imputed: DataFrame
    truth: DataFrame
    duplicates_removed: DataFrame
    ambiguous_removed: DataFrame


#: What the imputed side is scored by: hard calls, dosages, dosages with probabilities where they are absent, probabilities.
FIELDS = {"GT": ("GT",), "DS": ("DS",), "DS,GP": ("DS", "GP"), "GP": ("GP",)}


def read_side(spark: SparkSession, path: str, samples: list[str], region: str | None, snps_only: bool = True, fields: tuple[str, ...] = ("GT",)) -> DataFrame:
    """Renamed contigs of Chr01 to Chr17, region and SNP filters, GT (and other fields) by sample."""
    raw = vcf.read_vcf(spark, path)
    sites = contigs.restrict_contigs(contigs.normalize_contigs(raw, contigs.contig_style(raw)))
    sites = in_region(biallelic_snps(sites) if snps_only else sites, region)
    sites = vcf.select_samples(sites, vcf.read_vcf_samples(spark, path), samples)
    names = list(dict.fromkeys(("GT", *fields)))
    return vcf.with_format_fields(sites, names).select(*joins.VARIANT, "id", *[n.lower() for n in names], "rec_ord")


def prepare(imputed: DataFrame, truth: DataFrame) -> Prepared:
    """Common positions only, first record of each, no locus that is strand-ambiguous on either side."""
    both = joins.common_positions(imputed, truth)
    a, b = joins.semi_positions(imputed, both), joins.semi_positions(truth, both)
    first_a, first_b = joins.dedup_first(a), joins.dedup_first(b)
    gone = joins.duplicates_removed(a, first_a).withColumn("source", F.lit("imputed")).union(joins.duplicates_removed(b, first_b).withColumn("source", F.lit("truth")))
    ambiguous = joins.ambiguous_loci(first_a, first_b)
    left, right = joins.drop_ambiguous(first_a, first_b)
    return Prepared(left, right, gone, ambiguous)


def translated(p: Prepared, field: str = "GT") -> DataFrame:
    """Aligned sites with A/B arrays of both sides, dosages x and y, and ``exceptions``.

    With another ``field`` than GT, x is the imputed dosage in units of ``genotypes.UNIT``, put together inside the row.
    """
    both = joins.align(p.truth.drop("rec_ord"), p.imputed.drop("rec_ord"))
    ours = F.transform("gt_imputed", lambda c: g.translate_by_bases(c, F.col("ref_imputed"), F.col("alt_imputed")))
    theirs = F.transform("gt", g.translate_by_index)
    coded = both.withColumn("_ours", ours).withColumn("_theirs", theirs)
    ab = lambda c: F.transform(c, lambda v: v["gt"])
    coded = coded.withColumn("ab_imputed", ab("_ours")).withColumn("ab_truth", ab("_theirs")).withColumn("y", F.transform("ab_truth", g.ab_dosage))
    if field == "GT":
        return coded.withColumn("x", F.transform("ab_imputed", g.ab_dosage))
    none = F.transform("gt_imputed", lambda c: F.lit(None).cast("string"))
    of = lambda n: F.col(f"{n.lower()}_imputed") if n in FIELDS[field] else none
    return coded.withColumn("x", g.dosages_in_row(of("DS"), of("GP")))


def exceptions(sites: DataFrame) -> DataFrame:
    """(source, chrom, pos, ref, alt, context, gt, problem, extra) of calls that could not be translated."""
    out = None
    for source, coded, calls in (("imputed", "_ours", "gt_imputed"), ("truth", "_theirs", "gt")):
        side = sites.select(*joins.VARIANT, F.posexplode(F.arrays_zip(F.col(coded).alias("c"), F.col(calls).alias("raw"))).alias("i", "p")).filter("p.c.problem is not null")
        part = side.select(F.lit(source).alias("source"), *joins.VARIANT, F.concat(F.lit("sample_col="), (F.col("i") + 6).cast("string")).alias("context"), F.col("p.raw").alias("gt"), F.col("p.c.problem").alias("problem"), F.col("p.c.extra").alias("extra"))
        out = part if out is None else out.union(part)
    return out


@dataclass
class ArrayResult:
    sample_metrics: DataFrame
    variant_metrics: DataFrame
    concordance: DataFrame
    duplicates_removed: DataFrame
    ambiguous_removed: DataFrame
    exceptions: DataFrame
    sites: DataFrame
    site_count: int = 0


def evaluate_array(spark: SparkSession, imputed_path: str, truth_path: str, samples: list[str] | None = None, region: str | None = None, field: str = "GT") -> ArrayResult:
    """Samples default to the sorted intersection. No common position raises, as do ``field``s without a single dosage."""
    if samples is None:
        shared = joins.common_samples(vcf.read_vcf_samples(spark, imputed_path), vcf.read_vcf_samples(spark, truth_path))
        samples = [r["sample"] for r in shared.collect()]
    if not samples:
        raise ValueError("no common samples")
    return score(spark, stored_sides(spark, imputed_path, truth_path, samples, region, shared_folder(spark, "array"), FIELDS[field]), samples, shared_folder(spark, "array-sites"), field)


def stored_sides(spark: SparkSession, imputed_path: str, truth_path: str, samples: list[str], region: str | None, folder: str, fields: tuple[str, ...] = ("GT",)) -> Prepared:
    """Both sides' typed sites, stored once, then prepared; checks and results read these, not the text."""
    ours = ingest(read_side(spark, imputed_path, samples, region, fields=fields), f"{folder}/imputed")
    return prepare(ours, ingest(read_side(spark, truth_path, samples, region), f"{folder}/truth"))


def score(spark: SparkSession, p: Prepared, samples: list[str], folder: str, field: str = "GT") -> ArrayResult:
    """Translated sites are stored under ``folder``; every result reads them. No common site, repeated positions, positions that differ and no dosage raise."""
    assert_unique(p.imputed, joins.POSITION, "imputed")
    joins.assert_same_positions(p.imputed, p.truth)
    sites, seen = translated(p, field), Observation()
    some = F.count_if(F.exists("x", lambda v: v.isNotNull())).alias("with_dosage")
    sites.observe(seen, F.count(F.lit(1)).alias("sites"), some).write.mode("overwrite").parquet(folder)
    sites = spark.read.schema(sites.schema).parquet(folder)
    n = incremental.observed(seen, "sites")
    if not n:
        raise ValueError("no common site is left")
    if field != "GT" and not incremental.observed(seen, "with_dosage"):
        raise ValueError(f"no dosage in {field}")
    dimension = spark.createDataFrame([(s, i) for i, s in enumerate(samples)], "sample string, sample_idx int")
    unit = 1 if field == "GT" else g.UNIT
    return ArrayResult(
        sample_metrics=metrics.sample_metrics(sites, dimension, unit),
        variant_metrics=metrics.variant_metrics_array(sites, unit).select("chrom", "pos", "id", "maf", "n_non_missing", "r", "r2", "concordance"),
        concordance=metrics.concordance_matrix(sites, unit).select(*joins.VARIANT, "id", "agree"),
        duplicates_removed=p.duplicates_removed, ambiguous_removed=p.ambiguous_removed, exceptions=exceptions(sites), sites=sites, site_count=n,
    )


def run_array(spark: SparkSession, imputed_path: str, truth_path: str, root: str, samples: list[str] | None = None, region: str | None = None, force: bool = False, field: str = "GT") -> list[str]:
    """The array evaluation on disk: A/B tables, metrics, concordance and reports. Returns the steps that were done.

    A step whose outputs are there and not empty is left out, unless ``force`` is set; the audit keeps every step's counts.
    """
    incremental.assert_mode(spark, root, "array")
    if samples is None:
        samples = [r["sample"] for r in joins.common_samples(vcf.read_vcf_samples(spark, imputed_path), vcf.read_vcf_samples(spark, truth_path)).collect()]
    if not samples:
        raise ValueError("no common samples")
    steps = {
        "samples": ("common_samples",), "translation": ("imputed_ab", "truth_ab", "qc/translation_exceptions"), "reports": ("qc/duplicates_removed", "qc/ambiguous_removed"),
        "metrics": ("per_sample_metrics", "per_variant_metrics"), "concordance": ("concordance",),
    }
    due = [s for s, outputs in steps.items() if force or not all(has_content(spark, f"{root}/{o}") for o in outputs)]
    audit = incremental.AuditLog()
    if set(due) - {"samples"}:
        p = stored_sides(spark, imputed_path, truth_path, samples, region, f"{root}/_work", FIELDS[field])
        out = score(spark, p, samples, f"{root}/_work/sites", field)
        n = out.site_count
    for step in due:
        if step == "samples":
            sinks.write_tsv(spark.createDataFrame([(s,) for s in samples], "sample string"), f"{root}/common_samples")
            audit.step(step, None, len(samples))
        elif step == "translation":
            sinks.write_ab(out.sites.select(*joins.VARIANT, "id", F.col("ab_imputed").alias("ab")), samples, f"{root}/imputed_ab")
            sinks.write_ab(out.sites.select(*joins.VARIANT, "id", F.col("ab_truth").alias("ab")), samples, f"{root}/truth_ab")
            sinks.write_tsv(out.exceptions, f"{root}/qc/translation_exceptions", "NA", one_file=False)
            audit.step(step, n, n)
        elif step == "reports":
            gone = out.ambiguous_removed.select("chrom", "pos").distinct().count()
            sinks.write_tsv(out.duplicates_removed, f"{root}/qc/duplicates_removed", "NA", one_file=False)
            sinks.write_tsv(out.ambiguous_removed, f"{root}/qc/ambiguous_removed", "NA", one_file=False)
            audit.step(step, n + gone, n, "unambiguous positions")
        elif step == "metrics":
            sinks.write_tsv(metrics.report_columns(out.sample_metrics), f"{root}/per_sample_metrics", "NA")
            sinks.write_partitioned(out.variant_metrics, f"{root}/per_variant_metrics", parts=sinks.position_parts(out.sites))
            audit.step(step, n, n)
        else:
            sinks.write_partitioned(out.concordance, f"{root}/concordance")
            audit.step(step, n, n)
    if due:
        sinks.write_tsv(audit.frame(spark), f"{root}/audit", "NA")
        delete(spark, f"{root}/_work")
    return due


def match_samples(spark: SparkSession, query_path: str, truth_path: str, region: str | None = None, queries: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(ranked pairs, best matches) of all samples, or the ``queries`` of the first file, against all of the second; names may differ."""
    folder = shared_folder(spark, "matching")
    q, t = matching_samples(spark, query_path, truth_path, queries)
    sites = matching_sites(spark, query_path, truth_path, q, t, region, folder)
    pairs = stored_pairs(spark, sites, q, t, folder)
    ranked = pairwise.rank_matches(pairs)
    return ranked, pairwise.best_matches(pairs)


def matching_samples(spark: SparkSession, query_path: str, truth_path: str, queries: list[str] | None) -> tuple[DataFrame, DataFrame]:
    """(sample, sample_idx) of both sides, numbered as their calls will be; asked-for samples that are not there raise."""
    q, t = vcf.read_vcf_samples(spark, query_path), vcf.read_vcf_samples(spark, truth_path)
    if queries is None:
        return q, t
    asked = spark.createDataFrame([(s, i) for i, s in enumerate(queries)], "sample string, sample_idx int")
    if absent := [r["sample"] for r in joins.missing_samples(asked, q).collect()]:
        raise ValueError(f"query: samples not in input: {', '.join(absent)}")
    return asked, t


def matching_sites(spark: SparkSession, query_path: str, truth_path: str, q: DataFrame, t: DataFrame, region: str | None, folder: str, audit: incremental.AuditLog | None = None) -> DataFrame:
    """Sites with dosage arrays q and t; both sides and the sites are stored under ``folder``."""
    names = [[r["sample"] for r in x.orderBy("sample_idx").collect()] for x in (q, t)]
    sides, seen = [], [Observation(), Observation(), Observation()]
    for name, path, wanted, s in zip(("query", "truth"), (query_path, truth_path), names, seen, strict=False):
        sides.append(ingest(read_side(spark, path, wanted, region), f"{folder}/{name}", s))
    sites = translated(prepare(*sides)).select(*joins.VARIANT, F.col("x").alias("q"), F.col("y").alias("t"))
    sites.observe(seen[2], F.count(F.lit(1)).alias("sites")).write.mode("overwrite").parquet(f"{folder}/sites")
    if audit is not None:
        n = incremental.observed(seen[2], "sites")
        for name, s in zip(("query", "truth"), seen, strict=False):
            audit.step(f"{name} sites kept", incremental.observed(s, "records"), n, "common, first of their position, unambiguous")
    return spark.read.schema(sites.schema).parquet(f"{folder}/sites")


def stored_pairs(spark: SparkSession, sites: DataFrame, q: DataFrame, t: DataFrame, folder: str) -> DataFrame:
    """Every pair's counts, stored; no pair with a shared call raises."""
    pairs, seen = pairwise.pairwise_concordance(sites, q, t), Observation()
    pairs.observe(seen, F.count_if(F.col("n_compared") > 0).alias("compared")).write.mode("overwrite").parquet(f"{folder}/pairs")
    if not incremental.observed(seen, "compared"):
        raise ValueError("no pair of samples has a shared call")
    return spark.read.schema(pairs.schema).parquet(f"{folder}/pairs")


def run_matching(spark: SparkSession, query_path: str, truth_path: str, root: str, region: str | None = None, force: bool = False, queries: list[str] | None = None) -> list[str]:
    """Sample matching on disk: sites, all pairs with their ranks, best matches, manifests, audit. Returns the steps that were done.

    A step whose output is there and not empty is left out, unless ``force`` is set or a step before it was done; inputs or a
    region other than those of the manifest are refused without ``force``.
    """
    incremental.assert_mode(spark, root, "matching")
    paths = [x for p in (query_path, truth_path) for x, _ in input_files(spark, p)]
    listing = spark.read.format("binaryFile").load(paths).select("path", "length", F.col("modificationTime").alias("modified"))
    signature = incremental.run_signature(listing, {"region": region or "", "query": query_path, "truth": truth_path, "queries": ",".join(queries or [])}).first()["signature"]
    if has_content(spark, f"{root}/run_manifest"):
        before = manifest_value(spark, f"{root}/run_manifest", "signature")
        if before != signature and not force:
            raise ValueError(f"{root} holds results of other inputs; use force to replace them")
    audit, done = incremental.AuditLog(), []
    due = lambda name: force or bool(done) or not has_content(spark, f"{root}/{name}")
    read = lambda name: spark.read.parquet(f"{root}/{name}")
    q, t = matching_samples(spark, query_path, truth_path, queries)
    if due("sites"):
        matching_sites(spark, query_path, truth_path, q, t, region, f"{root}/_work", audit).write.mode("overwrite").parquet(f"{root}/sites")
        done.append("sites")
    if due("pairs"):
        stored_pairs(spark, read("sites").select("q", "t"), q, t, f"{root}/_work")
        ranked, seen = pairwise.rank_matches(read("_work/pairs")).orderBy("query", "match_rank"), Observation()
        ranked.observe(seen, F.count(F.lit(1)).alias("pairs")).write.mode("overwrite").parquet(f"{root}/pairs")
        audit.step("pairs", None, incremental.observed(seen, "pairs"))
        done.append("pairs")
    if due("best"):
        best, seen = pairwise.best_matches(read("pairs")), Observation()
        ties = F.count_if("tie_flag").alias("ties")
        best.orderBy(F.col("best_concordance").desc_nulls_last(), "query").observe(seen, F.count(F.lit(1)).alias("queries"), ties).write.mode("overwrite").parquet(f"{root}/best")
        audit.step("best matches", None, incremental.observed(seen, "queries"), f"{incremental.observed(seen, 'ties')} with ties")
        sinks.write_tsv(read("best").orderBy(F.col("best_concordance").desc_nulls_last(), "query"), f"{root}/best_matches", "NA")
        done.append("best")
    if done:
        outputs = [("dataset", f"{root}/{n}", d) for n, d in (("sites", "shared sites"), ("pairs", "all pairs, ranked"), ("best", "best and second match"))]
        sinks.write_tsv(sinks.output_manifest(spark, [*outputs, ("report", f"{root}/best_matches", "best matches, surest first")]), f"{root}/output_manifest", "NA")
        sinks.write_tsv(audit.frame(spark), f"{root}/audit", "NA")
        sinks.write_tsv(sinks.manifest(spark, {"query": query_path, "truth": truth_path, "region": region or "", "signature": signature, "schema": incremental.SCHEMA_VERSION}), f"{root}/run_manifest", "NA")
        delete(spark, f"{root}/_work")
    return done
