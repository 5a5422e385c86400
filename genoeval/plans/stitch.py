"""Overlapping chunk outputs of a run, stitched into one genome-wide table on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import chunks, incremental
from ..sources import files, sinks, vcf
from ..sources.scratch import children, has_content


def done_chroms(spark: SparkSession, root: str) -> list[str]:
    """Chromosomes that are stitched already."""
    return sorted(c.split("=", 1)[1] for c in children(spark, f"{root}/calls") if c.startswith("CHROM=") and any(f.endswith(".parquet") for f in children(spark, f"{root}/calls/{c}")))


def run_stitch(spark: SparkSession, folder: str, root: str, chroms: list[str] | None = None, manifest: str | None = None, force: bool = False) -> list[str]:
    """Stitch the chunks of each chromosome: a chunk ends before the next one starts, one that would be empty raises.

    ``manifest`` is a chunk manifest; chunks of a chosen chromosome that it lists and that have no file with content
    are refused before anything is written, and files that it does not list are left out. Chosen chromosomes default to those
    with chunks; ones without any are named in the audit and skipped, and none at all raises. Chromosomes that are
    there already are skipped, unless ``force`` is set. All others go through the same jobs. ``calls`` is the
    genome-wide table, by chromosome. Returns the chromosomes that were stitched.
    """
    incremental.assert_mode(spark, root, "stitch")
    found = [f for f in vcf.chunk_files(spark, folder) if f[5] > 0]
    listed = files.read_chunk_manifest(spark, manifest) if manifest else None
    if listed is not None:
        mine = listed.filter(F.col("chrom").isin(*chroms)) if chroms else listed
        chunks.assert_chunks(mine, [(*f[1:4], f[5]) for f in found])
        asked = {(r["chrom"], r["start"], r["end"]) for r in mine.select("chrom", "start", "end").collect()}
        found = [f for f in found if f[1:4] in asked]
    audit = incremental.AuditLog()
    have = sorted({f[1] for f in found})
    for absent in sorted(set(chroms or []) - set(have)):
        audit.step(f"{absent} skipped", 0, 0, "no chunk")
    chosen = [c for c in have if not chroms or c in chroms]
    if not chosen:
        raise ValueError(f"{folder}: no chunk of a chosen chromosome")
    there = [] if force else done_chroms(spark, root)
    pending = [c for c in chosen if c not in there]
    for c in sorted(set(chosen) - set(pending)):
        audit.step(f"{c} skipped", None, None, "stitched before")
    if pending:
        use = [f for f in found if f[1] in pending]
        windows = spark.createDataFrame([f[:4] for f in use], "chunk_id string, chrom string, start long, end long")
        for r in chunks.trim_chunks(windows).filter("trimmed").orderBy("chrom", "start").collect():
            audit.step(f"{r['chunk_id']} trimmed", r["end"], r["trim_end"], "last base")
        before, after = Observation(), Observation()
        one = F.count(F.lit(1))
        sites = vcf.read_chunks(spark, use).observe(before, one.alias("records"))
        kept = chunks.stitch_chunks(sites, windows).observe(after, one.alias("records"))
        sinks.write_calls(kept.select("chrom", "pos", "id", "ref", "alt", "qual", "info", "format", "calls"), f"{root}/calls")
        audit.step("records", incremental.observed(before, "records"), incremental.observed(after, "records"), "outside their chunk's part")
        samples = vcf.read_vcf_samples(spark, [f[4] for f in use])
        sinks.write_tsv(samples, f"{root}/samples")
    outputs = [("dataset", f"{root}/calls/CHROM={c}", f"stitched calls of {c}") for c in done_chroms(spark, root)]
    sinks.write_tsv(sinks.output_manifest(spark, [*outputs, ("dataset", f"{root}/calls", "genome-wide calls")]), f"{root}/output_manifest", "NA")
    sinks.write_tsv(audit.frame(spark), f"{root}/audit", "NA")
    return pending


def stitched(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(calls, samples) of a stitched run."""
    if not has_content(spark, f"{root}/samples"):
        raise ValueError(f"{root} holds no stitched run")
    names = spark.read.option("sep", "\t").option("header", True).schema("sample string, sample_idx int").csv(f"{root}/samples")
    return spark.read.parquet(f"{root}/calls"), names
