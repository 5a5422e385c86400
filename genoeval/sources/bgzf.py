"""Lines of block-gzipped text, a part of a file a task.

A block-gzipped file is a row of gzip members of at most 64 KiB, each with its own length in its header. A task gets a
range of compressed bytes, looks for the first member that starts in it (a header whose length leads to another header, or
to the end), inflates the members that start in the range, and owns the lines that start in them: it leaves out what
comes before its first line end, and reads on, past its range, to the end of its last line.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

NAME = "bgzf_lines"
#: Fixed value: the first bytes of a member, and of its field that has the length.
MAGIC, FIELD = b"\x1f\x8b\x08\x04", b"BC\x02\x00"
_MEMBER, _EMIT = 1 << 16, 4 << 20
#: Stores that tasks can open; ``file`` and plain paths are opened directly.
SCHEMES = ("", "file", "hdfs", "s3", "gs", "abfs", "abfss")


def is_member(head: bytes) -> bool:
    return len(head) >= 18 and head[:4] == MAGIC and head[12:16] == FIELD


def open_file(path: str) -> BinaryIO:
    scheme = path.split(":", 1)[0] if ":" in path else ""
    if scheme in ("", "file"):
        return open("/" + path.split(":", 1)[1].lstrip("/") if scheme else path, "rb")
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def _member_size(head: bytes) -> int:
    return int.from_bytes(head[16:18], "little") + 1


def first_member(f: BinaryIO, start: int, end: int) -> int | None:
    """Where the first member at or after ``start`` begins; none if it begins at or after ``end``."""
    if start == 0:
        return 0
    f.seek(start)
    data = f.read(min(end - start, 2 * _MEMBER) + 18)
    at = data.find(MAGIC)
    while 0 <= at and start + at < end:
        head = data[at : at + 18]
        if is_member(head):
            f.seek(start + at + _member_size(head))
            after = f.read(18)
            if not after or is_member(after):
                return start + at
        at = data.find(MAGIC, at + 1)
    return None


def inflated(f: BinaryIO, at: int) -> Iterator[tuple[int, bytes]]:
    """(start, text) of the members from ``at`` on."""
    f.seek(at)
    while head := f.read(18):
        if not is_member(head):
            raise ValueError(f"no block at byte {at}")
        size = _member_size(head)
        body = f.read(size - 18)
        yield at, zlib.decompress(body[:-8], wbits=-15)
        at += size


def lines(f: BinaryIO, start: int, end: int) -> Iterator[list[str]]:
    """The lines that start in the members of a range of compressed bytes, some at a time."""
    at = first_member(f, start, end)
    if at is None:
        return
    skip, rest = start > 0, b""
    for place, text in inflated(f, at):
        last = False
        if place >= end:  # only to the end of the line that is open, which may be empty so far
            stop = text.find(b"\n")
            last, text = stop >= 0, text[: stop + 1] if stop >= 0 else text
        rest += text
        if skip:
            stop = rest.find(b"\n")
            if stop < 0:
                if last:
                    return
                continue
            rest, skip = rest[stop + 1 :], False
        if last:
            break
        if len(rest) >= _EMIT and place < end:
            stop = rest.rfind(b"\n") + 1
            if stop:
                yield rest[: stop - 1].decode("utf-8", "replace").split("\n")
                rest = rest[stop:]
    if skip or not rest:
        return
    yield (rest[:-1] if rest.endswith(b"\n") else rest).decode("utf-8", "replace").split("\n")


class Part(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class BgzfReader(DataSourceReader):
    def __init__(self, options: dict):
        self.files, self.split = json.loads(options["files"]), int(options["split"])

    def partitions(self) -> list[Part]:
        return [Part(path, at, min(at + self.split, size)) for path, size in self.files for at in range(0, size, self.split)]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        with open_file(part.path) as f:
            for some in lines(f, part.start, part.end):
                value = pa.array([x[:-1] if x.endswith("\r") else x for x in some], pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([part.path] * len(some), pa.string()), value], names=["file", "value"])


class BgzfLines(DataSource):
    """``spark.read.format("bgzf_lines")`` with the options ``files`` (JSON list of path and size) and ``split`` (bytes)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "file string, value string"

    def reader(self, schema) -> BgzfReader:
        return BgzfReader(self.options)
