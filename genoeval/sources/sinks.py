"""Result writers."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import MAP_HEADER


#: Bases of a window that stays together; rows of a file, about.
WINDOW, FILE_ROWS = 1_000_000, 1_000_000


def position_parts(sites: DataFrame, rows: int = FILE_ROWS, window: int = WINDOW) -> dict[str, int]:
    """The file that each window of a chromosome (``chrom:window``) goes to: neighbours share one up to about ``rows`` rows.

    One count by window, as many rows as a genome has megabases.
    """
    out: dict[str, int] = {}
    part, held, before = -1, 0, None
    for r in sites.groupBy("chrom", F.expr(f"pos div {window}").alias("window")).count().orderBy("chrom", "window").collect():
        if r["chrom"] != before or held + r["count"] > rows:
            part, held, before = part + 1, 0, r["chrom"]
        out[f"{r['chrom']}:{r['window']}"] = part
        held += r["count"]
    return out


def write_partitioned(df: DataFrame, path: str, chrom: str = "chrom", parts: dict[str, int] | None = None, window: int = WINDOW) -> None:
    """Snappy Parquet by CHROM, in order of position and alleles; a rewrite replaces only the chromosomes it holds.

    With ``parts`` (see ``position_parts``) the files of a chromosome hold position ranges that do not overlap, so a read
    of a region skips the others by their statistics; without, windows are dealt out by their hash.
    """
    rows = df.withColumnRenamed(chrom, "CHROM") if chrom != "CHROM" else df
    keys = [c for c in ("pos", "ref", "alt", "ref_imputed", "alt_imputed", "ref_truth", "alt_truth") if c in rows.columns]
    if parts and "pos" in keys:
        numbers = F.from_json(F.lit(json.dumps(parts)), "map<string,int>")
        rows = rows.repartitionById(max(parts.values()) + 1, F.coalesce(F.try_element_at(numbers, F.concat_ws(":", "CHROM", F.expr(f"pos div {window}").cast("string"))), F.lit(0)))
    else:
        rows = rows.repartition("CHROM", *([F.expr(f"pos div {window}")] if "pos" in keys else []))
    rows.sortWithinPartitions("CHROM", *keys).write.partitionBy("CHROM").mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy").parquet(path)


def write_tsv(df: DataFrame, path: str, null_value: str = "", one_file: bool = True) -> None:
    """Unquoted report with a header. ``one_file`` is for reports of a few thousand rows."""
    out = df.coalesce(1) if one_file else df
    out.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", null_value).option("emptyValue", "").option("quote", "\u0000").csv(path)


def wide_calls(long: DataFrame, samples: list[str], value: str) -> DataFrame:
    """A column a sample, in the given order; explicit values keep the pivot to one pass."""
    meta = ["chrom", "pos", "ref", "alt", "id"]
    return long.groupBy(*meta).pivot("sample", samples).agg(F.first(value))


def write_ab(arrays: DataFrame, samples: list[str], path: str, column: str = "ab") -> None:
    """A/B table of an array column: five site columns, then a column a sample; a row is one joined text, however many samples."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    row = F.concat_ws("\t", text("chrom"), text("pos"), text("ref"), text("alt"), text("id"), F.array_join(column, "\t", ""))
    head = "\t".join(["CHROM", "POS", "REF", "ALT", "ID", *samples])
    # One column whose name is the header line; the separator does not occur.
    arrays.select(row.alias("row")).toDF(head).write.mode("overwrite").option("sep", "\u0001").option("header", True).option("quote", "\u0000").option("emptyValue", "").csv(path)


def write_map_text(maps: DataFrame, path: str) -> None:
    """Genetic maps as text, a folder and one file a chromosome, in order of position."""
    text = maps.select(F.col("chrom").alias("CHROM"), F.concat_ws(" ", F.col("position").cast("string"), F.format_string("%.6f", "rate"), F.format_string("%.6f", "cm")).alias("line"), "position")
    head = " ".join(MAP_HEADER)
    text.repartition("CHROM").sortWithinPartitions("CHROM", "position").select("CHROM", F.col("line").alias(head)).write.mode("overwrite").partitionBy("CHROM").option("sep", "\u0001").option("header", True).option("quote", "\u0000").csv(path)


def write_calls(sites: DataFrame, path: str) -> None:
    """Stitched sites by chromosome; the folder itself is the genome-wide table."""
    write_partitioned(sites, path)


def manifest(spark: SparkSession, values: dict[str, str]) -> DataFrame:
    return spark.createDataFrame(sorted(values.items()), "key string, value string")


def output_manifest(spark: SparkSession, outputs: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(outputs, "file_type string, path string, description string")
