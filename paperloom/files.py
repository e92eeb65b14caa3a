"""Small files and folders on any file system that Spark reads: paths with a scheme go through Hadoop, others are local.

Whoever reads a document that was replaced sees the old one or the new one.
"""

from __future__ import annotations

import os
import shutil
from pathlib import Path

from pyspark.sql import SparkSession


class _Hadoop:
    def __init__(self, path: str):
        spark = SparkSession.getActiveSession()
        if spark is None:
            raise OSError(f"no session to reach {path}")
        self.jvm = spark.sparkContext._jvm
        self.at = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _local(path: str | Path) -> Path | None:
    text = str(path)
    if text.startswith("file:"):
        text = "/" + text[5:].lstrip("/")
    return None if "://" in text else Path(text)


def exists(path: str | Path) -> bool:
    local = _local(path)
    if local is not None:
        return local.exists()
    h = _Hadoop(str(path))
    return h.fs.exists(h.at)


def is_folder(path: str | Path) -> bool:
    local = _local(path)
    if local is not None:
        return local.is_dir()
    h = _Hadoop(str(path))
    return h.fs.exists(h.at) and h.fs.getFileStatus(h.at).isDirectory()


def read_text(path: str | Path) -> str:
    local = _local(path)
    if local is not None:
        return local.read_text(encoding="utf-8")
    h = _Hadoop(str(path))
    stream = h.fs.open(h.at)
    try:
        return bytes(h.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def write_text(path: str | Path, text: str) -> None:
    write_bytes(path, text.encode("utf-8"))


def write_bytes(path: str | Path, data: bytes) -> None:
    """Written beside the place, then moved there."""
    local = _local(path)
    if local is not None:
        local.parent.mkdir(parents=True, exist_ok=True)
        beside = local.with_name(local.name + ".tmp")
        beside.write_bytes(data)
        os.replace(beside, local)
        return
    h, beside = _Hadoop(str(path)), _Hadoop(f"{path}.tmp")
    stream = h.fs.create(beside.at, True)
    stream.write(bytearray(data))
    stream.close()
    h.fs.delete(h.at, False)
    h.fs.rename(beside.at, h.at)


def names(path: str | Path, pattern: str) -> list[str]:
    """Paths below ``path`` that match a glob, relative to it and in order."""
    local = _local(path)
    if local is not None:
        return sorted(str(p.relative_to(local)) for p in local.glob(pattern))
    h = _Hadoop(str(path))
    root = h.fs.makeQualified(h.at).toString().rstrip("/") + "/"
    found = h.fs.globStatus(h.jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}")) or []
    return sorted(s.getPath().toString().removeprefix(root) for s in found)


def remove(path: str | Path) -> None:
    """A file or a folder with all it holds, if it is there."""
    local = _local(path)
    if local is None:
        h = _Hadoop(str(path))
        h.fs.delete(h.at, True)
    elif local.is_dir():
        shutil.rmtree(local)
    else:
        local.unlink(missing_ok=True)
