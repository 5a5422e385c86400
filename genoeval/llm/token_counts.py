"""Token counts behind a digest cache.

A text's digest and the tokenizer's version (a digest of its file) are the key of a stored count. A run joins its
distinct digests to the cache, encodes one text of each digest that misses, appends those counts, and joins counts
to rows. Encoding a miss splits it where the byte-level pre-tokenizer must start a new word in any case, and asks
the library once for each distinct part a worker meets.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

LIMIT = 512
#: Parts remembered by a task before it starts over.
CACHE_MOST = 500_000
_CACHE_SCHEMA = "tokenizer string, digest string, n_tokens long"
_BREAK = re.compile(r"(?<=\S)(?= \S)")
_ODD = re.compile(r"\s\s|^\s|\s$")
_LOADED: dict[str, tuple] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _loaded(path: str) -> tuple:
    if path not in _LOADED:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _LOADED[path] = (tokenizer, {}, _splits(tokenizer))
    return _LOADED[path]


def _splits(tokenizer) -> bool:
    """Whether texts may be split before a lone space: byte-level words, no normalizer, no added token with a space."""
    import json

    spec = json.loads(tokenizer.to_str())
    pre = spec.get("pre_tokenizer") or {}
    return spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])) for t in spec["added_tokens"])


def _parts(text: str) -> list[str]:
    if _ODD.search(text):
        return _BREAK.split(text)
    head, *rest = text.split(" ")
    return [head, *[f" {x}" for x in rest]]


def count_tokens(path: str, texts: list[str]) -> list[int]:
    tokenizer, cache, splits = _loaded(path)
    parts = [(_parts(t) if splits else [t]) if t else [] for t in texts]
    seen: set[str] = set().union(*parts)
    fresh = [p for p in seen if p not in cache]
    if len(cache) + len(fresh) > CACHE_MOST:
        cache.clear()
        fresh = list(seen)
    for at in range(0, len(fresh), 1000):
        some = fresh[at : at + 1000]
        cache.update(zip(some, map(len, tokenizer.encode_batch(some, add_special_tokens=False)), strict=True))
    return [sum(map(cache.__getitem__, ps)) for ps in parts]


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts = [n for at in range(0, len(texts), 200) for n in count_tokens(path, texts[at : at + 200])]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])
        _loaded(path)[1].clear()  # a worker outlives its tasks; its memory is for what comes next

    return run


def token_counts(docs: DataFrame, cache_path: str | None = None, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of ``docs``, as the tokenizers library counts them.

    ``cache_path`` is a Parquet folder in a store that all executors share, parted by the tokenizer's digest; it is
    made where missing, and appended to.
    Without one, a new empty cache lies under the shared checkpoint folder. The content is normalised as the
    counted tokenizer takes it: null as empty, nothing else. Repeated rows, ids and texts are rows of
    their own and share one count. Other columns are not read.
    """
    spark, path = docs.sparkSession, tokenizer or default_tokenizer()
    with open(path, "rb") as f:
        version = hashlib.sha256(f.read()).hexdigest()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("digest"))
    scratch = Scratch(spark, "token-counts")
    cache_path = cache_path or f"{scratch.folder}/cache"
    spark.createDataFrame([], _CACHE_SCHEMA).write.mode("append").partitionBy("tokenizer").parquet(cache_path)
    stored = lambda: spark.read.schema(_CACHE_SCHEMA).parquet(cache_path).filter(F.col("tokenizer") == version)
    # Digests first. Where few are missing, Spark broadcasts them, and only their texts are shuffled.
    misses = scratch.keep("misses", rows.select("digest").distinct().join(stored(), "digest", "left_anti"))
    # Copies within a task go before the shuffle, the rest after it: one text of each digest is left.
    texts = docs.select(F.sha2(text, 256).alias("digest"), text.alias("text")).dropDuplicates(["digest"]).join(misses, "digest", "left_semi")
    fresh = texts.mapInArrow(_counted(path), "digest string, n_tokens long")
    scratch.append(fresh.select(F.lit(version).alias("tokenizer"), "digest", "n_tokens"), cache_path, "tokenizer")
    # A table of its own, so that a digest with very many rows can be split over tasks.
    counts = scratch.keep("counts", stored().groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))
    return rows.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
