"""Helpers shared by the corpus operators: Arrow text views, numpy word tables, checkpoints.

All numpy code here works inside Spark tasks on slices of an Arrow batch, so its memory is bounded by
``MAX_SLICE`` bytes of text (or by one document, where a single document is longer).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import owned_folder

#: Bytes of text that numpy works on at once.
MAX_SLICE = 1 << 19

#: Rows and bytes of one Arrow batch.
BATCH_ROWS, BATCH_BYTES = 2_000, 2 << 20

_BYTE = np.arange(256)
#: A-Z to a-z, every other byte unchanged.
LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
#: Bytes of words: digits, letters and everything outside ASCII.
IS_WORD = ((_BYTE >= 48) & (_BYTE <= 57)) | ((_BYTE >= 65) & (_BYTE <= 90)) | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
#: Bytes of words that spaces part.
NO_SPACE = (_BYTE != 32) & ((_BYTE < 9) | (_BYTE > 13))

#: Odd multipliers of the polynomial byte hashes; any two odd numbers do.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def checkpoint_folder(spark: SparkSession) -> str:
    """The application's folder in the cluster's shared one, ``spark.checkpoint.dir`` or the context's own; it ends with the driver."""
    return owned_folder(spark)


#: Shuffle files of a table that is written are not needed any more once it is there.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables between the steps of an operator: Parquet in the shared folder, which outlives executors, dropped by name."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` and read it again: lineage is cut, and its size is known to the joins that follow."""
        self._write(df.write, f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def append(self, df: DataFrame, path: str, parts: str) -> None:
        """Add rows to a lasting table that is parted by a column."""
        self._write(df.write.mode("append").partitionBy(parts), path)

    def _write(self, writer: DataFrameWriter, path: str) -> None:
        before = self.spark.conf.get(_CLEAN, None)
        self.spark.conf.set(_CLEAN, "true")
        try:
            writer.parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(_CLEAN)
            else:
                self.spark.conf.set(_CLEAN, before)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing will read again."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Bits of the filters that say what surely has no partner: 8 MB at any input size.
FILTER_BITS = 1 << 26


def bit_filter(rows: DataFrame, column: str) -> Broadcast:
    """A bit for each value of a long column, ``FILTER_BITS`` at most, whatever the number of rows; see ``may_be_in``."""
    place = F.col(column).bitwiseAND(F.lit(FILTER_BITS - 1)) + 1  # Spark counts places from 1
    part = rows.select(F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("bit")).groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    bits = np.zeros(FILTER_BITS >> 3, np.uint8)
    for r in part.collect():
        at = (r["part"] - 1) * len(r["bits"])
        bits[at : at + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return rows.sparkSession.sparkContext.broadcast(bits)


def may_be_in(bits: Broadcast, values: np.ndarray) -> np.ndarray:
    """Places of the values whose bit is set: all that are in the column, and a few others."""
    bit = signed(values) & (8 * len(bits.value) - 1)
    return np.flatnonzero(bits.value[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)


_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}


def bounded_batches(spark: SparkSession) -> None:
    """Send texts to Python a few megabytes at a time, so that very long ones cannot fill a worker; smaller settings stay.

    A query that returns a lazy result needs the setting until that is read; what is done at once uses ``bounded``.
    """
    for name, most in _BATCHES.items():
        now = spark.conf.get(name, None)
        if now is None or not str(now).isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, most)


@contextmanager
def bounded(spark: SparkSession) -> Iterator[None]:
    """``bounded_batches`` for a block; the session's own settings come back after it."""
    before = {name: spark.conf.get(name, None) for name in _BATCHES}
    bounded_batches(spark)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; its texts will reach Python in bounded batches."""
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2^64, ``n`` at least; kept and grown by doubling."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.ones(size, np.uint64)
            k = 1
            while k < size:
                p[k : 2 * k] = p[:k] * np.uint64(pow(b, k, 1 << 64))
                k *= 2
            both.append(p)
        have = _POWERS[base] = (both[0], both[1])
    return have


class ByteHash:
    """Hashes of any byte range of ``data`` in constant time, from running sums modulo 2^64."""

    def __init__(self, data: np.ndarray, base: int = BASES[0]):
        n = len(data)
        up, self.down = powers(n + 1, base)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:n]) * self.down[:n])


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = MAX_SLICE) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``most`` bytes of text each: (slice, UTF-8 bytes, offsets by row).

    A null text is empty here. Rows stay whole, in order.
    """
    for batch in batches:
        text = batch.column(batch.schema.get_field_index(column))
        if text.null_count:
            text = pc.fill_null(text, "")
        ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            part = text.slice(at, to - at)
            wide = np.int64 if pa.types.is_large_string(part.type) or pa.types.is_large_binary(part.type) else np.int32
            offsets = np.frombuffer(part.buffers()[1], wide)[part.offset : part.offset + to - at + 1].astype(np.int64)
            body = part.buffers()[2]
            data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
            yield batch.slice(at, to - at), data, offsets - offsets[0]
            at = to


class Words:
    """Words of the lower-cased texts: byte ``start`` and ``end`` of each, and ``of`` = first word by text (one more at the end)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = IS_WORD):
        self.data, self.offsets = data, offsets
        word = is_word[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        left = np.ones(len(data), bool)
        left[1:] = ~word[:-1]
        left |= edge[:-1]
        right = np.ones(len(data), bool)
        right[:-1] = ~word[1:]
        right |= edge[1:]
        self.start, self.end = np.flatnonzero(word & left), np.flatnonzero(word & right) + 1
        self.of = np.searchsorted(self.start, offsets)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each lower-cased word."""
        return ByteHash(LOWER[self.data])(self.start, self.end)


def run_hashes(words: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hashes of every ``k`` consecutive word hashes (also across texts; callers leave those out)."""
    n = max(0, len(words) - k + 1)
    total = np.full(n, k + 1000003 * seed, np.uint64)
    up = BASES[0] + 2 * seed
    for i in range(k):
        total += words[i : i + n] * np.uint64(pow(up, i + 1, 1 << 64))
    return mix(total)


def ranges(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lengths (2, 3): owner (0, 0, 1, 1, 1) and position (0, 1, 0, 1, 2)."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def list_array(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """A list column from flat values and the number of values by row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def sha_hex(column) -> F.Column:
    return F.sha2(column, 256)
