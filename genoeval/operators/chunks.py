"""Chunk files, assignment of sites to windows, and stitching of overlapping chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BUFFER, BIN = 500_000, 1_000_000


def parse_chunk_lines(lines: DataFrame, buffer: int = BUFFER) -> DataFrame:
    """Lines (value, ord) of a chunk file: blank, comment and header lines go; 3 to 5 fields, with or without a chunk id first.

    The first field is a chromosome if it starts with chr; else the second is; else a fourth number over 1000 makes the
    first one a chunk id. Coordinates that are not digits raise when the result is read.
    """
    f = F.split(F.trim("value"), r"\s+")
    field = lambda i: F.try_element_at(f, F.lit(i))
    first = F.lower(field(1))
    rows = lines.filter((F.trim("value") != "") & ~F.trim("value").startswith("#") & ~first.isin("chr", "chrom", "chunk"))
    digits = field(4).rlike("^[0-9]+$")
    with_id = F.when(first.startswith("chr"), False).when(F.lower(field(2)).startswith("chr"), True).otherwise(F.coalesce(digits & (F.when(digits, field(4)).cast("long") > 1000), F.lit(False)))
    pick = lambda i: F.when(F.col("with_id"), field(i + 1)).otherwise(field(i))

    def number(c: Column, what: str) -> Column:
        return F.when(c.rlike("^[0-9]+$"), c.cast("long")).otherwise(F.raise_error(F.concat(F.lit(f"chunk file: bad {what}: "), F.coalesce(F.col("value"), F.lit("")))).cast("long"))

    found = rows.withColumn("with_id", with_id).withColumn("chrom", pick(1)).withColumn("start", number(pick(2), "start")).withColumn("end", number(pick(3), "end"))
    found = found.withColumn("buffer", F.when(pick(4).isNull(), F.lit(buffer)).otherwise(number(F.coalesce(pick(4), F.lit("0")), "buffer")))
    made = F.concat_ws("_", "chrom", F.col("start").cast("string"), F.col("end").cast("string"))
    return found.select(F.when(F.col("with_id"), field(1)).otherwise(made).alias("chunk_id"), "chrom", "start", "end", F.col("buffer").cast("long").alias("buffer"), "ord")


def read_chunk_file(spark: SparkSession, path: str, buffer: int = BUFFER) -> DataFrame:
    lines = spark.read.text(path).withColumn("ord", F.monotonically_increasing_id())
    return parse_chunk_lines(lines, buffer)


def region_chunks(chroms: DataFrame, start: int, end: int, buffer: int = BUFFER) -> DataFrame:
    """One window for every chromosome."""
    return chroms.select(F.concat_ws("_", "chrom", F.lit(str(start)), F.lit(str(end))).alias("chunk_id"), "chrom", F.lit(start).cast("long").alias("start"), F.lit(end).cast("long").alias("end"), F.lit(buffer).cast("long").alias("buffer"))


def missing_chunks(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Chunks without a file that has content; ``files`` is (chrom, start, end, length)."""
    return manifest.join(files.filter("length > 0"), ["chrom", "start", "end"], "left_anti")


def assert_chunks(manifest: DataFrame, files: list[tuple[str, int, int, int]]) -> None:
    """Every chunk of the manifest must have a file with content; the first that have none are named."""
    have = manifest.sparkSession.createDataFrame(files, "chrom string, start long, end long, length long")
    absent = missing_chunks(manifest, have).orderBy("chrom", "start").limit(5).collect()
    if absent:
        raise ValueError(f"chunks without a file: {', '.join(r['chunk_id'] for r in absent)}")


def assign_chunks(sites: DataFrame, chunks: DataFrame, with_buffer: bool = True, width: int = BIN) -> DataFrame:
    """A row for each site and window that covers it: windows are cut into bins of ``width``, so the join is on equal keys."""
    pad = F.col("buffer") if with_buffer else F.lit(0)
    windows = chunks.select("chunk_id", "chrom", (F.col("start") - pad).alias("lo"), (F.col("end") + pad).alias("hi"))
    windows = windows.withColumn("bin", F.explode(F.sequence(F.expr(f"greatest(lo, 0) div {width}"), F.expr(f"hi div {width}"))))
    return sites.withColumn("bin", F.expr(f"pos div {width}").cast("long")).join(windows, ["chrom", "bin"]).filter("pos between lo and hi").drop("bin", "lo", "hi")


def trim_chunks(chunks: DataFrame, order: str = "start") -> DataFrame:
    """Adds ``trim_end`` = the base before the next chunk and ``trimmed``; a chunk that loses everything raises when read."""
    after = F.lead("start").over(Window.partitionBy("chrom").orderBy(order))
    end = F.coalesce(F.least(F.col("end"), after - 1), F.col("end"))
    cut = chunks.withColumn("trim_end", end).withColumn("trimmed", F.col("trim_end") < F.col("end"))
    checked = F.when(F.col("trim_end") < F.col("start"), F.raise_error(F.concat(F.lit("chunk lies within the next one: "), "chunk_id")).cast("long")).otherwise(F.col("trim_end"))
    return cut.withColumn("trim_end", checked)


def stitch_chunks(sites: DataFrame, chunks: DataFrame) -> DataFrame:
    """Sites (with chunk_id) of overlapping chunks: trimmed chunks keep start to trim_end, the others keep all."""
    bounds = trim_chunks(chunks).select("chunk_id", "start", "trim_end", "trimmed")
    return sites.join(bounds, "chunk_id").filter(~F.col("trimmed") | F.col("pos").between(F.col("start"), F.col("trim_end"))).drop("start", "trim_end", "trimmed")
