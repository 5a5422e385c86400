"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

1. language ID: rows whose text has no language (null, or no letter) go, ``lang`` of the others is the language found;
2. n-gram Jaccard join: of each group of near copies the row with the least doc_id stays;
3. suffix-array dedup: byte strings of ``PASSAGE`` bytes and more that occur again are cut out of the texts, rows of
   which nothing is left go;
4. benchmark decontamination: rows with a benchmark passage go;
5. SentencePiece encoding: ids and decoded text of every row left.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoeval.llm import decontamination, jaccard, language, pieces, suffix_dedup
from genoeval.llm.common import bounded, bounded_batches, checkpoint_folder, table

#: Passages of over 50 words. (op9's own contract cuts from 400 bytes.)
PASSAGE = suffix_dedup.PASSAGE

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a language, which takes the place of ``lang``; the automata learn from the original table's labelled rows that are not held out."""
    found = language.identify(docs, table(spark, sf_dir, "documents").filter(~language.held_out()))
    kept = found.filter(F.col("lang_pred") != language.UNKNOWN)
    return kept.select(*[F.col("lang_pred").alias("lang") if c == "lang" else F.col("row")[c].alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return jaccard.drop_near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated strings; ``n_chars`` follows the text."""
    bounded_batches(spark)
    cut = suffix_dedup.without_repeats(docs, length=PASSAGE)
    return cut.filter(F.length("text") > 0).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded)."""
    bounded_batches(spark)
    return pieces.encode(docs).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language_id), ("n-gram Jaccard join", near_duplicates), ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", decontaminate), ("SentencePiece encoding", encode),
]

#: Cross parsing, MinHash pruning and merges have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns lies under the shared checkpoint folder for the next one."""
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    with bounded(spark):
        docs = table(spark, sf_dir, "documents")
        for i, (_, stage) in enumerate(STAGES):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
            docs = spark.read.parquet(f"{folder}/{i}")
    return docs
