"""Running sample metrics over a stream of per-chromosome sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.metrics import finalize_stats

STATS_SCHEMA = "sample_idx int, maf_bin int, n long, sx long, sy long, sxx long, syy long, sxy long, chrom string"


def stats_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """New stats files under ``path`` as they arrive."""
    return spark.readStream.schema(STATS_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def running_metrics(stats: DataFrame) -> DataFrame:
    """r and r2 by sample and bin so far; state is one row of sums for each, so use complete or update mode."""
    return finalize_stats(stats)
