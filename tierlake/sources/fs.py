"""Directory listing through the session's Hadoop FileSystem, so the same code
lists a local disk, HDFS or an object store. Listing is driver-side metadata work,
bounded by the number of folders and files, never by rows."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    path: str
    is_dir: bool


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dir(spark: SparkSession, path: str) -> list[Entry]:
    """Children of ``path`` sorted by name; empty if it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = [
        Entry(s.getPath().getName(), s.getPath().toString(), bool(s.isDirectory()))
        for s in fs.listStatus(p)
    ]
    return sorted(out, key=lambda e: e.name)


def first_data_file(spark: SparkSession, path: str) -> str | None:
    """The first visible file (not ``_x`` / ``.x``) of a folder, or None. Streams the
    listing and stops at the first hit, so a leaf with 100k files costs one page."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    it = fs.listStatusIterator(p)
    while it.hasNext():
        status = it.next()
        name = status.getPath().getName()
        if not status.isDirectory() and not name.startswith(("_", ".")):
            return status.getPath().toString()
    return None


def is_complete(spark: SparkSession, path: str) -> bool:
    """A leaf whose writer committed: it carries the ``_SUCCESS`` marker."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def data_files(spark: SparkSession, path: str) -> Iterator[tuple[str, int]]:
    """(name, size) of a folder's visible files, streamed from its listing."""
    fs, p = _fs(spark, path)
    it = fs.listStatusIterator(p)
    while it.hasNext():
        status = it.next()
        name = status.getPath().getName()
        if not status.isDirectory() and not name.startswith(("_", ".")):
            yield name, int(status.getLen())


def listing_digest(spark: SparkSession, path: str) -> str:
    """A digest of the names and sizes of a folder's data files. Writers name every file
    anew, so it changes with the content, and not with the folder's time."""
    count, mixed = 0, 0
    for name, size in data_files(spark, path):
        count += 1
        mixed ^= int.from_bytes(hashlib.sha1(f"{name}:{size}".encode()).digest()[:8], "little")
    return f"files:{count}:{mixed:016x}"


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder; nothing happens if it does not exist."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, s = _fs(spark, src)
    _, d = _fs(spark, dst)
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise OSError(f"rename failed: {src} -> {dst}")


def _beside(path: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.new"


def write_small_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small metadata file from the driver: beside it, then moved into place.
    A crash between removing the old file and the move leaves the new one beside, where
    ``read_small_text`` finds it."""
    fs, p = _fs(spark, path)
    _, new = _fs(spark, _beside(path))
    out = fs.create(new, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(new, p):
        raise OSError(f"rename failed: {new.toString()} -> {path}")


def create_small_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small metadata file under a name that does not exist yet; False if it does."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return False
    try:
        out = fs.create(p, False)
    except Exception as e:
        if fs.exists(p):
            return False
        raise e
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def read_small_text(spark: SparkSession, path: str) -> str:
    if not exists(spark, path) and exists(spark, _beside(path)):
        path = _beside(path)
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_years(spark: SparkSession, path: str) -> dict[int, object] | None:
    """A JSON map by year, or None if it was never written."""
    if not exists(spark, path) and not exists(spark, _beside(path)):
        return None
    return {int(y): v for y, v in json.loads(read_small_text(spark, path)).items()}


def write_years(spark: SparkSession, path: str, by_year: dict[int, object]) -> None:
    write_small_text(spark, path, json.dumps({str(y): v for y, v in sorted(by_year.items())}))


def swap(spark: SparkSession, new: str, path: str) -> None:
    """Put a finished folder in the place of another. A crash leaves either the old
    folder, or none and the new one beside."""
    delete(spark, path)
    rename(spark, new, path)
