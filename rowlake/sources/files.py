"""Small metadata files and directory listings, on any Hadoop file system."""

from __future__ import annotations

import errno
import os
import re
from contextlib import suppress
from functools import lru_cache

from py4j.java_gateway import is_instance_of
from pyspark.sql import SparkSession

# Characters that a path pattern or a path parser would read as something else.
UNSAFE = frozenset("?*[]{}^:\\/%")


def safe_segment(name: str) -> str:
    """A path segment without glob characters, colons or separators."""
    return "".join(f"%{ord(ch):02X}" if ch in UNSAFE else ch for ch in name)


@lru_cache(maxsize=4)
def _java(jvm) -> tuple:
    """The classes used here; finding one by its name takes several calls, which many tables would repeat."""
    hadoop = jvm.org.apache.hadoop.fs
    return hadoop.Path, jvm.org.apache.commons.io.IOUtils, hadoop.FileContext, hadoop.Options.Rename


def _path(spark: SparkSession, path: str):
    return _java(spark._jvm)[0](path)


def _fs(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


@lru_cache(maxsize=4)
def _on_disk(spark: SparkSession) -> tuple[bool, bool]:
    """Are paths that begin with ``file:`` on the driver's own disk, and are those without a scheme?"""
    conf = spark._jsc.hadoopConfiguration()
    fs = _path(spark, "file:///").getFileSystem(conf)
    own = is_instance_of(spark.sparkContext._gateway, fs, "org.apache.hadoop.fs.LocalFileSystem")
    return own, own and conf.get("fs.defaultFS", "file:///").startswith("file:")


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path as the driver's own disk has it, None if it is elsewhere.

    On such a disk Hadoop starts a process for each file and folder that it makes, and each question
    is some calls into the JVM; with many tables that takes longer than their rows.
    """
    named, bare = _on_disk(spark)
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/") if named and re.match("file:/(?!/)|file:///", path) else None
    return path if bare and path.startswith("/") else None


def plain_options(spark: SparkSession, path: str) -> dict[str, str]:
    """How a write of many small files is to make them: on a local disk without a second file for the checksum of each.

    That file takes another process to make; Parquet keeps checksums of its pages.
    """
    if local_path(spark, path) is None:
        return {}
    return {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def exists(spark: SparkSession, path: str) -> bool:
    if (own := local_path(spark, path)) is not None:
        return os.path.exists(own)
    target = _path(spark, path)
    return _fs(spark, target).exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a directory; none if there is no such directory."""
    if (own := local_path(spark, path)) is not None and not os.path.isfile(own):
        return [n for n in os.listdir(own) if not (n.startswith(".") and n.endswith(".crc"))] if os.path.exists(own) else []
    target = _path(spark, path)
    if not _fs(spark, target).exists(target):
        return []
    return [status.getPath().getName() for status in _fs(spark, target).listStatus(target)]


def size(spark: SparkSession, path: str) -> int:
    """The bytes of all files in a directory."""
    target = _path(spark, path)
    return _fs(spark, target).getContentSummary(target).getLength()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder that this run has made."""
    if (own := local_path(spark, path)) is not None and not os.path.lexists(own):
        return
    target = _path(spark, path)
    _fs(spark, target).delete(target, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder another place, which must be free; folders above it are made."""
    here, there = local_path(spark, path), local_path(spark, to)
    if here is not None and there is not None and os.path.isdir(here) and not os.path.lexists(there):
        os.makedirs(os.path.dirname(there), exist_ok=True)
        try:
            return os.rename(here, there)
        except OSError as error:  # another disk, to which Hadoop copies
            if error.errno != errno.EXDEV:
                raise
    source, target = _path(spark, path), _path(spark, to)
    fs = _fs(spark, target)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"could not rename {path} to {to}")


def holding(spark: SparkSession, path: str, name: str) -> list[str]:
    """The names of the directories directly below ``path`` that hold a file of that name, in order."""
    if (own := local_path(spark, path)) is not None:
        return sorted(n for n in names(spark, path) if os.path.exists(os.path.join(own, n, name)))
    target = _path(spark, f"{path}/*/{name}")
    return [status.getPath().getParent().getName() for status in _fs(spark, target).globStatus(target) or []]


def read_text(spark: SparkSession, path: str) -> str | None:
    if (own := local_path(spark, path)) is not None:
        try:
            with open(own, encoding="utf-8", newline="") as file:
                return file.read()
        except FileNotFoundError:
            return None
    target = _path(spark, path)
    fs = _fs(spark, target)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return _java(spark._jvm)[1].toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside the file, then rename over it, so that no reader sees half of it."""
    if (own := local_path(spark, path)) is not None:
        folder, name = os.path.split(own)
        os.makedirs(folder, exist_ok=True)
        with open(f"{own}.new", "w", encoding="utf-8", newline="") as file:
            file.write(text)
        # A checksum that Hadoop has left is of the text that was there.
        with suppress(FileNotFoundError):
            os.remove(os.path.join(folder, f".{name}.crc"))
        os.replace(f"{own}.new", own)
        return
    target, part = _path(spark, path), _path(spark, path + ".new")
    fs = _fs(spark, target)
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    # A plain rename to a free place is enough; the one that replaces asks a local disk many questions, each a process.
    if not fs.exists(target) and fs.rename(part, target):
        return
    _, _, file_context, rename = _java(spark._jvm)
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = file_context.getFileContext(
        target.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(part, target, options)
