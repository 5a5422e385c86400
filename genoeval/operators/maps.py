"""Simple genetic maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _with_cm(df: DataFrame, rate: float) -> DataFrame:
    first = F.first("position").over(Window.partitionBy("chrom").orderBy("position"))
    return df.select("chrom", "position", F.lit(float(rate)).alias("rate"), F.round((F.col("position") - first) / 1e6, 6).alias("cm"))


def constant_rate_map(lengths: DataFrame, step: int = 1000, rate: float = 1.0) -> DataFrame:
    """Positions step, 2*step, ... up to each length; cM grows by one a million bases from the first, whatever the rate."""
    steps = lengths.filter(F.col("length") >= step).select("chrom", F.explode(F.sequence(F.lit(step).cast("long"), F.col("length").cast("long"), F.lit(step).cast("long"))).alias("position"))
    return _with_cm(steps, rate)


def variant_anchored_map(sites: DataFrame, rate: float = 1.0) -> DataFrame:
    """A row for each distinct site position."""
    return _with_cm(sites.select("chrom", F.col("pos").cast("long").alias("position")).distinct(), rate)


#: File names of a chromosome's genetic map, in order of choice.
MAP_FILES = ("{}.map", "{}.txt", "{}.txt.gz", "genetic_map.{}.txt", "genetic_map.{}.txt.gz", "genetic_map_{}.txt", "genetic_map_{}.txt.gz", "{}_genetic_map.txt", "{}_genetic_map.txt.gz")


def choose_map_files(listing: DataFrame, chroms: DataFrame) -> DataFrame:
    """(chrom, path): the first fixed name that is there, else the first by name that holds the chromosome and ends in txt, txt.gz or map."""
    files = listing.withColumn("name", F.element_at(F.split("path", "/"), -1))
    at = F.array_position(F.array(*[F.format_string(m.replace("{}", "%s"), "chrom") for m in MAP_FILES]), F.col("name"))
    held = files.join(chroms, F.col("name").contains(F.col("chrom"))).filter(F.col("name").rlike(r"\.(txt|txt\.gz|map)$"))
    rank = F.row_number().over(Window.partitionBy("chrom").orderBy(F.when(at > 0, at).otherwise(len(MAP_FILES) + 1), "name"))
    return held.withColumn("rank", rank).filter("rank = 1").select("chrom", "path")
