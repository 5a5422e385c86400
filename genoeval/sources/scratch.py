"""A folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession


_OWNED: dict[str, tuple] = {}


def _remove(path, fs) -> None:
    try:
        fs.delete(path, True)
    except Exception:  # noqa: BLE001, the process ends: a store that is gone is not its error
        pass


def owned_folder(spark: SparkSession) -> str:
    """The application's one folder for tables between steps, deleted when its driver ends.

    It lies under the cluster's checkpoint folder and bears the application's id, so what a killed driver leaves is
    known by its name. A folder of this machine stands in only where Spark runs on one machine (tests).
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        base = context.getCheckpointDir()
    folder = f"{base}/genoeval-{context.applicationId}"
    if folder not in _OWNED:
        _OWNED[folder] = _file(spark, folder)
        atexit.register(_remove, *_OWNED[folder])
    return folder


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the application's folder."""
    return f"{owned_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _file(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none where it is absent."""
    path, fs = _file(spark, folder)
    return [x.getPath().getName() for x in fs.listStatus(path)] if fs.exists(path) else []


def has_content(spark: SparkSession, path: str) -> bool:
    """Whether a file, or a folder's result, is there and not empty."""
    hadoop, fs = _file(spark, path)
    return fs.exists(hadoop) and fs.getContentSummary(hadoop).getLength() > 0


def delete(spark: SparkSession, path: str) -> None:
    hadoop, fs = _file(spark, path)
    fs.delete(hadoop, True)


def input_files(spark: SparkSession, paths: str | list[str]) -> list[tuple[str, int]]:
    """(path, length) of the files that paths, patterns and folders name, by path; contents are not read."""
    out = {}
    for p in [paths] if isinstance(paths, str) else paths:
        path, fs = _file(spark, p)
        for found in fs.globStatus(path) or []:
            for x in fs.listStatus(found.getPath()) if found.isDirectory() else [found]:
                if not x.isDirectory() and x.getPath().getName()[0] not in "_.":
                    out[x.getPath().toString()] = x.getLen()
    return sorted(out.items())


def head_bytes(spark: SparkSession, path: str, count: int) -> bytes:
    hadoop, fs = _file(spark, path)
    stream = fs.open(hadoop)
    try:
        return bytes(stream.readNBytes(count))
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str, prefix: str, before: str) -> str | None:
    """The first line with ``prefix``, among the lines at the head of a text that start with ``before``; nothing after them is read."""
    hadoop, fs = _file(spark, path)
    java = spark.sparkContext._jvm.java
    stream = fs.open(hadoop)
    try:
        text = java.util.zip.GZIPInputStream(stream) if path.endswith(".gz") else stream
        lines = java.io.BufferedReader(java.io.InputStreamReader(text, "UTF-8"))
        while (line := lines.readLine()) is not None and line.startswith(before):
            if line.startswith(prefix):
                return line
        return None
    finally:
        stream.close()
