"""Reference panel preparation: from a folder of VCF text to cleaned sites by chromosome, with a report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import contigs, panel
from ..operators.sites import filter_panel
from ..sources import sinks, vcf
from ..sources.scratch import delete


def panel_files(spark: SparkSession, folder: str, chroms: list[str], candidates: tuple[str, ...] = panel.PANEL_FILES) -> dict[str, str]:
    """The panel file of each chromosome; one without a file raises."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.vcf.gz").load(folder).select("path", "length")
    found = {r["chrom"]: r["path"] for r in panel.choose_panel_files(listing, spark.createDataFrame([(c,) for c in chroms], "chrom string"), candidates).collect()}
    if absent := [c for c in chroms if c not in found]:
        raise ValueError(f"{folder} has no panel for {', '.join(absent)}")
    return found


def prepare_panel(spark: SparkSession, folder: str, out: str, chroms: list[str], rate: float = 0.95, candidates: tuple[str, ...] = panel.PANEL_FILES) -> DataFrame:
    """Sites with enough phased and no missing calls, as Parquet by chromosome under ``out``; returns the report.

    Text is split once, into a working table by chromosome; the report names each input and output.
    """
    chosen = panel_files(spark, folder, chroms, candidates)
    raw = vcf.read_vcf(spark, list(chosen.values()))
    named = contigs.restrict_contigs(contigs.standardise_panel(raw), chroms)
    stored = vcf.ingest(vcf.with_format_fields(named, ["GT"]).select("chrom", "pos", "id", "ref", "alt", "gt"), f"{out}/_work")
    judged = filter_panel(stored, rate)
    sinks.write_partitioned(judged.filter("keep").drop("keep"), f"{out}/panel")
    files = spark.createDataFrame([(c, p, f"{out}/panel/CHROM={c}") for c, p in chosen.items()], "chrom string, input_vcf string, output string")
    report = files.join(panel.panel_report(stored, rate), "chrom", "left").select("chrom", "input_vcf", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "removed", "kept")], F.lit(float(rate)).alias("min_valid_gt_rate"), "output").orderBy("chrom")
    sinks.write_tsv(report, f"{out}/panel_report", "NA")
    delete(spark, f"{out}/_work")
    return spark.read.option("sep", "\t").option("header", True).schema(report.schema).csv(f"{out}/panel_report")
