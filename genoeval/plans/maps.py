"""Genetic maps for all chromosomes of a run: chosen, read, checked and written in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import incremental, maps
from ..operators.contigs import canonicalize
from ..sources import files, sinks, vcf
from ..sources.scratch import input_files


def map_files(spark: SparkSession, chroms: list[str], folder: str | None = None, one_file: str | None = None) -> dict[str, str]:
    """The map file of each chromosome: its own in ``folder``, by name, or ``one_file`` for all. A chromosome without one raises."""
    if (folder is None) == (one_file is None):
        raise ValueError("give a folder of maps or one map")
    if one_file is not None:
        return dict.fromkeys(chroms, one_file)
    listing = spark.createDataFrame([(p,) for p, _ in input_files(spark, f"{folder.rstrip('/')}/*")], "path string")
    found = {r["chrom"]: r["path"] for r in maps.choose_map_files(listing, spark.createDataFrame([(c,) for c in chroms], "chrom string")).collect()}
    if absent := [c for c in chroms if c not in found]:
        raise ValueError(f"{folder} has no map for {', '.join(absent)}")
    return found


def read_maps(spark: SparkSession, chosen: dict[str, str]) -> DataFrame:
    """(chrom, position, rate, cm) of every chromosome; a file that several share is read once."""
    by_file: dict[str, list[str]] = {}
    for chrom, path in chosen.items():
        by_file.setdefault(path, []).append(chrom)
    out = None
    for path, chroms in sorted(by_file.items()):
        part = files.read_genetic_map(spark, path).drop("chrom").crossJoin(F.broadcast(spark.createDataFrame([(c,) for c in chroms], "chrom string")))
        out = part if out is None else out.unionByName(part)
    return out.select("chrom", "position", "rate", "cm")


def assert_maps(rows: DataFrame) -> None:
    """Positions must be there, and cM must not fall along a chromosome; neighbours meet within a chromosome's task."""
    from pyspark.sql import Window

    before = F.lag("cm").over(Window.partitionBy("chrom").orderBy("position"))
    wrong = rows.withColumn("before", before).filter("position is null or cm is null or cm < before").orderBy("chrom", "position").limit(5).collect()
    if wrong:
        raise ValueError(f"maps fall or lack values, e.g. at {', '.join(str(r['chrom']) + ':' + str(r['position']) for r in wrong)}")


def prepare_maps(spark: SparkSession, root: str, chroms: list[str], folder: str | None = None, one_file: str | None = None, fai: str | None = None, sites_vcf: str | None = None) -> DataFrame:
    """Maps by chromosome under ``root``, as Parquet and as map text; returns the report (chrom, source, rows, last_cm).

    The maps come from files (``folder`` or ``one_file``), from an index's lengths at a constant rate (``fai``), or from the
    positions of a panel's records (``sites_vcf``); exactly one of these.
    """
    if sum(x is not None for x in (folder, one_file, fai, sites_vcf)) != 1:
        raise ValueError("give one source of maps")
    names = spark.createDataFrame([(c,) for c in chroms], "chrom string")
    if fai is not None:
        rows, source = maps.constant_rate_map(files.read_fai(spark, fai, chroms).join(names, "chrom", "left_semi")), dict.fromkeys(chroms, fai)
    elif sites_vcf is not None:
        rows, source = maps.variant_anchored_map(canonicalize(vcf.read_vcf(spark, sites_vcf)).join(names, "chrom", "left_semi")), dict.fromkeys(chroms, sites_vcf)
    else:
        source = map_files(spark, chroms, folder, one_file)
        rows = read_maps(spark, source)
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).withColumnRenamed("chrom", "CHROM").repartition("CHROM").sortWithinPartitions("CHROM", "position").write.mode("overwrite").partitionBy("CHROM").parquet(f"{root}/maps")
    stored = spark.read.schema("position long, rate double, cm double, CHROM string").parquet(f"{root}/maps").withColumnRenamed("CHROM", "chrom")
    assert_maps(stored)
    sinks.write_map_text(stored, f"{root}/text")
    origin = spark.createDataFrame(sorted(source.items()), "chrom string, source string")
    report = origin.join(stored.groupBy("chrom").agg(F.count("*").alias("rows"), F.max("cm").alias("last_cm")), "chrom", "left").select("chrom", "source", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), "last_cm").orderBy("chrom")
    sinks.write_tsv(report, f"{root}/map_report", "NA")
    audit = incremental.AuditLog()
    audit.step("maps", None, incremental.observed(seen, "rows"), f"{len(chroms)} chromosomes")
    sinks.write_tsv(audit.frame(spark), f"{root}/audit", "NA")
    return spark.read.option("sep", "\t").option("header", True).option("nullValue", "NA").schema(report.schema).csv(f"{root}/map_report")
