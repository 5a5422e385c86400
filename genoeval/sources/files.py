"""Small text inputs: maps, indexes, manifests, sample lists, wide tables; and stored results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed header of a genetic map file.
MAP_HEADER = ("position", "COMBINED_rate.cM.Mb.", "Genetic_Map.cM.")


def read_genetic_map(spark: SparkSession, path: str, chrom: str | None = None) -> DataFrame:
    df = spark.read.option("sep", " ").option("header", True).csv(path)
    if tuple(df.columns) != MAP_HEADER:
        raise ValueError(f"{path}: not a genetic map")
    return df.select(F.lit(chrom).cast("string").alias("chrom"), F.col("position").cast("long").alias("position"), F.col(f"`{MAP_HEADER[1]}`").cast("double").alias("rate"), F.col(f"`{MAP_HEADER[2]}`").cast("double").alias("cm"))


def write_genetic_map(df: DataFrame, path: str) -> None:
    df.select(F.col("position").alias(MAP_HEADER[0]), F.col("rate").alias(MAP_HEADER[1]), F.format_string("%.6f", "cm").alias(MAP_HEADER[2])).sortWithinPartitions(MAP_HEADER[0]).write.option("sep", " ").option("header", True).mode("overwrite").csv(path)


def read_fai(spark: SparkSession, path: str, chroms: list[str] | None = None) -> DataFrame:
    """(chrom, length) of a sequence index; asked-for chromosomes that it lacks raise."""
    df = spark.read.option("sep", "\t").schema("chrom string, length long, offset long, line_bases int, line_width int").csv(path).select("chrom", "length")
    if chroms:
        have = {r["chrom"] for r in df.filter(F.col("chrom").isin(*chroms)).collect()}
        if absent := [c for c in chroms if c not in have]:
            raise ValueError(f"{path} lacks {', '.join(absent)}")
    return df


def read_chunk_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "|").schema("chunk_id string, chrom string, start long, end long, buffer long").csv(path)


def manifest_value(spark: SparkSession, path: str, key: str) -> str | None:
    row = spark.read.option("sep", "\t").schema("key string, value string").csv(path).filter(F.col("key") == key).first()
    return row["value"] if row else None


def read_samples(spark: SparkSession, path: str, mode: str = "verbatim") -> DataFrame:
    """(sample, sample_idx). Modes: verbatim; unique (first token, blanks dropped, repeats raise); first (repeats dropped)."""
    lines = spark.read.text(path).withColumn("ord", F.monotonically_increasing_id())
    return number_samples(lines, mode)


def number_samples(lines: DataFrame, mode: str = "verbatim") -> DataFrame:
    from pyspark.sql import Window

    if mode == "verbatim":
        rows = lines.select(F.col("value").alias("sample"), "ord")
    else:
        token = F.try_element_at(F.split(F.trim("value"), r"\s+"), F.lit(1)) if mode == "unique" else F.col("value")
        rows = lines.select(token.alias("sample"), "ord").filter(F.trim("sample") != "").groupBy("sample").agg(F.min("ord").alias("ord"), F.count("*").alias("n"))
        if mode == "unique" and (twice := rows.filter("n > 1").limit(5).collect()):
            raise ValueError(f"repeated samples: {', '.join(r['sample'] for r in twice)}")
    # A sample list fits one task by nature; its order is its meaning.
    return rows.select("sample", (F.row_number().over(Window.orderBy("ord")) - 1).alias("sample_idx"))


def read_wide(spark: SparkSession, path: str, value: str) -> DataFrame:
    """Wide table (five site columns, a column a sample) as long rows; fewer than six columns raise."""
    df = spark.read.option("sep", "\t").option("header", True).option("nullValue", ".").csv(path)
    if len(df.columns) < 6:
        raise ValueError(f"{path}: a wide table has at least six columns")
    meta, samples = df.columns[:5], df.columns[5:]
    return df.unpivot(meta, samples, "sample", value).toDF("chrom", "pos", "ref", "alt", "id", "sample", value).withColumn("pos", F.col("pos").cast("int"))


def read_metrics(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored dataset; filters on CHROM prune folders, others row groups."""
    return spark.read.parquet(f"{root}/{name}")
