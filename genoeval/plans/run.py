"""A whole-genome evaluation on disk that can be resumed by chromosome.

Datasets lie under ``versions/<n>``, one version for each run that computed something. A manifest says which version
each chromosome is in; readers follow the newest complete manifest, and writing that one folder publishes a run. A run
that dies before leaves the previous state as it was.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.genotypes import canonical_chrom
from ..operators import incremental, metrics
from ..operators.sites import Thresholds, canonical_region
from ..sources import sinks
from ..sources.fasta import read_fasta
from ..sources.scratch import children, delete
from .wgs import Side, chunk_side, common, evaluate_stored, store_side, stored_chroms, truth_side, vcf_side

_SITE = "pos int, ref string, alt string"
_SUMS = "n long, sx long, sy long, sxx long, syy long, sxy long"
#: Datasets by chromosome: the results' attribute that they hold, and their columns beside CHROM.
DATASETS = {
    "variant_metrics": ("variant_metrics", f"{_SITE}, id string, id_truth string, n_pairs long, truth_alt_frequency double, truth_maf double, r double, r2 double, concordance double"),
    "site_filtered": ("site_filtered", f"{_SITE}, id string, id_truth string, site_filter_pass boolean, site_filter_reasons string"),
    "imputed_only": ("imputed_only", f"{_SITE}, id string"), "truth_only": ("truth_only", f"{_SITE}, id string"),
    "allele_mismatches": ("allele_mismatches", "pos int, ref_imputed string, alt_imputed string, ref_truth string, alt_truth string"),
    "sample_stats": ("sample_stats", f"sample_idx int, maf_bin int, {_SUMS}, sample string"),
    "filter_counts": ("counts", "section string, reason string, count long"), "masking_counts": ("masks", "sample string, reason string, count long"),
}
_CHECKPOINT = "chrom string, signature string, version string, outputs array<string>"


def listing(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, length, modified, chrom) of input files; contents are not read. ``chrom`` is null where the name has none."""
    files = spark.read.format("binaryFile").load(list(paths)).select("path", "length", F.col("modificationTime").alias("modified"))
    named = F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"^(?:.*[._])?([Cc]hr[0-9]+)[._]", 1)
    return files.withColumn("chrom", canonical_chrom(F.nullif(named, F.lit(""))))


def _newest(spark: SparkSession, root: str) -> str | None:
    """The newest manifest that was written to its end."""
    for name in sorted(children(spark, f"{root}/manifests"), reverse=True):
        if "_SUCCESS" in children(spark, f"{root}/manifests/{name}"):
            return name
    return None


def checkpoints(spark: SparkSession, root: str) -> DataFrame:
    """(chrom, signature, version, outputs) of every chromosome that is published."""
    name = _newest(spark, root)
    return spark.createDataFrame([], _CHECKPOINT) if name is None else spark.read.schema(_CHECKPOINT).parquet(f"{root}/manifests/{name}")


def publish(spark: SparkSession, root: str, rows: list[tuple]) -> None:
    """A new manifest; then versions that neither it nor the one before names are deleted, so readers under way go on."""
    before = _newest(spark, root)
    name = f"{int(before or 0) + 1:08d}"
    spark.createDataFrame(rows, _CHECKPOINT).coalesce(1).write.mode("overwrite").parquet(f"{root}/manifests/{name}")
    named = {r[2] for r in rows} | ({r["version"] for r in spark.read.schema(_CHECKPOINT).parquet(f"{root}/manifests/{before}").collect()} if before else set())
    for version in children(spark, f"{root}/versions"):
        if version not in named:
            delete(spark, f"{root}/versions/{version}")


def outputs_of(spark: SparkSession, root: str, version: str, chrom: str) -> list[str]:
    """The files of a chromosome in every dataset; names only."""
    return sorted(f"{name}/{f}" for name in DATASETS for f in children(spark, f"{root}/versions/{version}/{name}/CHROM={chrom}") if f.endswith(".parquet"))


def dataset(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A dataset as published: each chromosome from its version, none where it has no row. Filters on CHROM prune folders."""
    schema = f"{DATASETS[name][1]}, CHROM string"
    by_version: dict[str, list[str]] = {}
    for r in checkpoints(spark, root).collect():
        by_version.setdefault(r["version"], []).append(r["chrom"])
    out = spark.createDataFrame([], schema)
    for version, chroms in sorted(by_version.items()):
        if children(spark, f"{root}/versions/{version}/{name}"):
            out = out.union(spark.read.schema(schema).parquet(f"{root}/versions/{version}/{name}").filter(F.col("CHROM").isin(*chroms)))
    return out


def finalize(spark: SparkSession, root: str, t: Thresholds) -> None:
    """Reports over all chromosomes that are there: samples, filter counts with the configuration, masked calls."""
    named = lambda name: dataset(spark, root, name).withColumnRenamed("CHROM", "chrom")
    stats = named("sample_stats")
    sinks.write_tsv(metrics.report_columns(metrics.sample_report(stats, stats.select("sample", "sample_idx").distinct())), f"{root}/per_sample_metrics", "NA")
    sinks.write_tsv(metrics.filter_totals(named("filter_counts"), t), f"{root}/qc/filter_summary", "NA")
    sinks.write_tsv(metrics.masking_totals(named("masking_counts")), f"{root}/qc/genotype_masking_summary", "NA")


def _known_chroms(spark: SparkSession, root: str, inputs: str, found: list[str] | None = None) -> list[str] | None:
    """The chromosomes that earlier runs found in inputs of this digest; ``found`` is kept for later ones."""
    path = f"{root}/_inputs/{inputs}"
    if found is not None:
        spark.createDataFrame([(c,) for c in found], "chrom string").coalesce(1).write.mode("overwrite").parquet(path)
        return found
    try:
        return sorted(r["chrom"] for r in spark.read.schema("chrom string").parquet(path).collect())
    except AnalysisException:
        return None


def run_sides(spark: SparkSession, imputed: Side, truth: Side, root: str, chroms: list[str] | None = None, samples: list[str] | None = None, t: Thresholds = Thresholds(), force: bool = False, bases: DataFrame | None = None, region: str | None = None) -> list[str]:
    """Evaluate the chromosomes that are absent, stale or incomplete in one pass, publish them, then write the totals.

    Returns the chromosomes that were computed. ``chroms`` defaults to those both sides have: by the names of files, by
    what an earlier run saw in the same inputs, or by the folders of the stored sides; text is scanned once a side at
    most, and not at all where nothing is to be done. A chromosome's signature covers the inputs that concern it,
    samples, region and thresholds; results of another signature are refused without ``force``. A chromosome is
    incomplete if a file that its checkpoint names is gone. Counts of the audit are observed while data are written.
    """
    incremental.assert_mode(spark, root, "wgs")
    chosen, region = common(imputed.samples, truth.samples, samples), canonical_region(region, chroms)
    config = {"samples": ",".join(chosen), "thresholds": repr(t), "region": region or "", "reference": str(bases is not None)}
    files = listing(spark, *imputed.paths, *truth.paths)
    inputs = incremental.run_signature(files, {"region": region or ""}).first()["signature"]
    work, audit, seen = f"{root}/_work", incremental.AuditLog(), (Observation(), Observation())
    stored: tuple[DataFrame, DataFrame] | None = None

    def store(which: list[str] | None) -> tuple[DataFrame, DataFrame]:
        return tuple(store_side(side, f"{work}/{name}", chosen, which, region, name == "truth", s) for side, name, s in zip((imputed, truth), ("imputed", "truth"), seen, strict=True))  # type: ignore[return-value]

    if chroms is None:
        if imputed.chroms is not None and truth.chroms is not None:
            chroms = [c for c in truth.chroms if c in imputed.chroms and c != "Chr00"]
        else:
            chroms = _known_chroms(spark, root, inputs)
        if chroms is None:
            stored = store(None)
            theirs = stored_chroms(spark, f"{work}/truth")
            chroms = _known_chroms(spark, root, inputs, [c for c in stored_chroms(spark, f"{work}/imputed") if c in theirs and c != "Chr00"])
    tasks = incremental.chrom_signatures(spark.createDataFrame([(c,) for c in chroms], "chrom string"), files, config)
    wanted = {r["chrom"]: r["signature"] for r in tasks.collect()}
    done = {r["chrom"]: r for r in checkpoints(spark, root).collect()}
    stale = sorted(c for c, s in wanted.items() if c in done and done[c]["signature"] != s)
    if stale and not force:
        raise ValueError(f"{root} holds results of other inputs or settings for {', '.join(stale)}; use force to replace them")
    complete = {c for c in wanted if c in done and c not in stale and set(done[c]["outputs"]) <= set(outputs_of(spark, root, done[c]["version"], c))}
    pending = sorted(wanted if force else set(wanted) - complete)
    audit.step("chromosomes", len(wanted), len(pending), "asked for, pending")
    if pending:
        ours, theirs = stored or store(pending)
        for name, s in zip(("imputed", "truth"), seen, strict=True):
            audit.step(f"{name} records read", None, incremental.observed(s, "records"))
        which = F.col("chrom").isin(*pending)
        out = evaluate_stored(spark, ours.filter(which), theirs.filter(which), work, chosen, t, bases)
        n = out.observed
        audit.step("imputed sites matched", n["matched"] + n["imputed_only"], n["matched"])
        audit.step("truth sites matched", n["matched"] + n["truth_only"], n["matched"])
        version = f"{int(_newest(spark, root) or 0) + 1:08d}"
        delete(spark, f"{root}/versions/{version}")  # what a run that died may have left
        parts = sinks.position_parts(out.joined)
        for name, (attribute, schema) in DATASETS.items():
            rows = Observation()
            columns = [c.split()[0] for c in schema.split(", ")]
            sinks.write_partitioned(getattr(out, attribute).select("chrom", *columns).observe(rows, F.count(F.lit(1)).alias("rows")), f"{root}/versions/{version}/{name}", parts=parts)
            audit.step(f"{name} written", None, incremental.observed(rows, "rows"))
            if name == "site_filtered":
                audit.step("matched sites retained", n["matched"], n["matched"] - incremental.observed(rows, "rows"))
        publish(spark, root, [(c, wanted[c], version, outputs_of(spark, root, version, c)) for c in pending] + [(c, r["signature"], r["version"], r["outputs"]) for c, r in done.items() if c not in pending])
    delete(spark, work)
    finalize(spark, root, t)
    kept = {
        **dict(metrics.config_values(t)), "imputed": ",".join(imputed.paths), "truth": ",".join(truth.paths), "samples": ",".join(chosen), "region": region or "", "schema": incremental.SCHEMA_VERSION,
        "comparison_field": "GT", "genotype_encoding": "ALT_COUNT_0_1_2", "intersection_key": "CHROM:POS:REF:ALT", **{f"signature_{c}": s for c, s in wanted.items()}, "outputs": f"{root}/versions", **{f"output_{n}": n for n in DATASETS},
    }
    sinks.write_tsv(sinks.manifest(spark, kept), f"{root}/run_manifest", "NA")
    sinks.write_tsv(sinks.output_manifest(spark, [*[("dataset", f"{root}/versions/*/{n}", f"{n} by chromosome, as the newest manifest says") for n in DATASETS], ("report", f"{root}/per_sample_metrics", "samples, worst first"), ("report", f"{root}/qc/filter_summary", "site counts and configuration"), ("report", f"{root}/qc/genotype_masking_summary", "masked calls")]), f"{root}/output_manifest", "NA")
    sinks.write_tsv(audit.frame(spark), f"{root}/audit", "NA")
    return pending


def run_wgs(spark: SparkSession, imputed_path: str | None, truth_path: str | None, root: str, chroms: list[str] | None = None, samples: list[str] | None = None, t: Thresholds = Thresholds(), force: bool = False, chunks_dir: str | None = None, truth_dir: str | None = None, bases: DataFrame | None = None, region: str | None = None, fasta: str | None = None, manifest: DataFrame | None = None) -> list[str]:
    """``run_sides`` over VCF text: the imputed side a file or a folder of chunks, the truth a file or a folder of one a chromosome.

    ``fasta`` (with its index beside it) or ``bases`` turn the check of REF on; chunks that ``manifest`` lists must be there.
    """
    if (imputed_path is None) == (chunks_dir is None) or (truth_path is None) == (truth_dir is None):
        raise ValueError("give one imputed input and one truth input")
    if fasta is not None:
        bases = read_fasta(spark, fasta)
    imputed = vcf_side(spark, imputed_path) if imputed_path else chunk_side(spark, chunks_dir, manifest)
    truth = vcf_side(spark, truth_path) if truth_path else truth_side(spark, truth_dir)
    return run_sides(spark, imputed, truth, root, chroms, samples, t, force, bases, region)
