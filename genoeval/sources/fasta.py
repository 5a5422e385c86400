"""Reference bases from FASTA text and its index, by blocks, a byte range a task.

The index gives each sequence's length, the byte of its first base, and bases and bytes of a line, so the byte of any
base is known without reading what lies before it. Only the blocks that sites lie in are read, where those are given.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.genotypes import canonical_chrom
from .bgzf import open_file

#: Bases of a block.
BLOCK = 1000
_INDEX = "chrom string, length long, offset long, line_bases long, line_width long"


def byte_of(base, offset, line_bases, line_width):
    """The byte of a base counted from 0: whole lines before it, and its place in its line."""
    return offset + base // line_bases * line_width + base % line_bases


def _blocks(block: int, run: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                first, last = r["run"] * run * block, min((r["run"] + 1) * run * block, r["length"])
                at = [byte_of(b, r["offset"], r["line_bases"], r["line_width"]) for b in (first, last - 1)]
                with open_file(r["path"]) as f:
                    f.seek(at[0])
                    text = f.read(at[1] + 1 - at[0]).translate(None, b"\r\n").decode("ascii")
                if len(text) != last - first:
                    raise ValueError(f"{r['path']}: the index does not fit {r['chrom']}")
                parts = [text[i : i + block] for i in range(0, len(text), block)]
                numbers = [r["run"] * run + i for i in range(len(parts))]
                yield pa.RecordBatch.from_arrays([pa.array([r["chrom"]] * len(parts), pa.string()), pa.array(numbers, pa.int64()), pa.array(parts, pa.string())], names=["chrom", "block", "bases"])

    return read


def read_indexed(index: DataFrame, block: int = BLOCK, run: int = 1000) -> DataFrame:
    """(chrom, block, bases) of the sequences of an index (path, chrom, length, offset, line_bases, line_width) over any number of files."""
    named = index.filter(canonical_chrom(F.col("chrom")).isNotNull() & (F.col("length") > 0))
    ranges = named.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(length - 1) div {block * run}")))).repartition("path", "chrom", "run")
    return ranges.mapInArrow(_blocks(block, run), "chrom string, block long, bases string").withColumn("chrom", canonical_chrom(F.col("chrom")))


def read_fasta(spark: SparkSession, path: str, index: str | None = None, block: int = BLOCK, run: int = 1000) -> DataFrame:
    """(chrom, block, bases) of uncompressed FASTA text: ``block`` bases a row from position 1, ``run`` rows a byte range.

    Chromosomes get their canonical names; sequences with other names are left out. The index lies beside the text.
    """
    fai = spark.read.option("sep", "\t").schema(_INDEX).csv(index or f"{path}.fai")
    return read_indexed(fai.withColumn("path", F.lit(path)), block, run)
