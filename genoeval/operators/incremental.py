"""Run signatures, pending work and step audits."""

from __future__ import annotations

import datetime
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA_VERSION = "genoeval-1"


def run_signature(listing: DataFrame, config: dict[str, str]) -> DataFrame:
    """One SHA-256 over the schema version, the configuration and every input's path, size and time; order does not matter."""
    fixed = ";".join([SCHEMA_VERSION, *(f"{k}={config[k]}" for k in sorted(config))])
    files = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "path", F.col("length").cast("string"), F.col("modified").cast("string")))), ";")
    return listing.agg(F.sha2(F.concat_ws(";", F.lit(fixed), files), 256).alias("signature"))


def chrom_signatures(tasks: DataFrame, listing: DataFrame, config: dict[str, str]) -> DataFrame:
    """(chrom, signature) of each task: as ``run_signature``, over the inputs of its chromosome and those of none."""
    fixed = ";".join([SCHEMA_VERSION, *(f"{k}={config[k]}" for k in sorted(config))])
    one = F.concat_ws(":", "path", F.col("length").cast("string"), F.col("modified").cast("string"))
    mine = tasks.join(listing.withColumnRenamed("chrom", "of"), F.col("of").isNull() | (F.col("of") == F.col("chrom")), "left")
    inputs = F.array_join(F.array_sort(F.collect_list(one)), ";")
    return mine.groupBy("chrom").agg(F.sha2(F.concat_ws(";", F.lit(fixed), "chrom", inputs), 256).alias("signature"))


def task_signatures(tasks: DataFrame, config: dict[str, str]) -> DataFrame:
    """Adds the signature of each chromosome's task (chrom, source, size)."""
    fixed = ";".join([SCHEMA_VERSION, *(f"{k}={config[k]}" for k in sorted(config))])
    return tasks.withColumn("signature", F.sha2(F.concat_ws(";", F.lit(fixed), "chrom", "source", F.col("size").cast("string")), 256))


def pending_chroms(tasks: DataFrame, checkpoints: DataFrame, force: bool = False) -> DataFrame:
    """Tasks whose signature no checkpoint has; all of them with ``force``."""
    return tasks if force else tasks.join(checkpoints, ["chrom", "signature"], "left_anti")


def assert_mode(spark: SparkSession, root: str, mode: str) -> None:
    """Tag an output root with its mode; refuse a root of another mode."""
    path = f"{root.rstrip('/')}/_mode"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(hadoop):
        found = spark.read.option("header", True).option("sep", "\t").csv(path).first()["value"]
        if found != mode:
            raise ValueError(f"{root} holds results of mode {found}, not {mode}")
    elif fs.exists(hadoop.getParent()) and len(fs.listStatus(hadoop.getParent())):
        raise ValueError(f"{root} is not empty and has no mode")
    else:
        spark.createDataFrame([("mode", mode)], "key string, value string").coalesce(1).write.option("header", True).option("sep", "\t").csv(path)


def observed(seen: Observation, name: str) -> int:
    """A count that a write observed; 0 where the optimiser found that there was nothing to write."""
    try:
        return seen.get.get(name) or 0
    except Py4JJavaError:  # an observation without a row
        return 0


@dataclass
class AuditLog:
    """Steps with counts before and after; removed is null unless both are known."""

    rows: list[tuple] = field(default_factory=list)

    def step(self, name: str, before: int | None, after: int | None, note: str = "") -> None:
        removed = before - after if before is not None and after is not None else None
        self.rows.append((name, datetime.datetime.now(datetime.UTC).isoformat(timespec="seconds"), before, after, removed, note))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "step string, timestamp string, count_before long, count_after long, count_removed long, note string")
