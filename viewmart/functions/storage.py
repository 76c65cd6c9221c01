"""Small files and folder listings through Hadoop's file system API.

Only names, sizes and notes of a few hundred bytes pass through here; table data
is always read and written by Spark.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache
from pathlib import Path

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Sorted paths that match a glob, without scheme and host."""
    fs, p = _open(spark, pattern)
    return sorted(s.getPath().toUri().getPath() for s in fs.globStatus(p) or [])


def absolute(spark: SparkSession, path: str) -> str:
    """Path without scheme and host, as seen from the root of its file system."""
    fs, p = _open(spark, path)
    return fs.makeQualified(p).toUri().getPath()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def any_match(spark: SparkSession, pattern: str) -> bool:
    """True if a path matches the glob; the matches stay in the JVM."""
    fs, p = _open(spark, pattern)
    return bool(fs.globStatus(p))


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Data files below a folder, without scheme and host; names with ``_`` or ``.`` in front are none."""
    fs, p = _open(spark, path)
    found, files = [], fs.listFiles(p, True)
    while files.hasNext():
        file = files.next().getPath()
        if file.getName()[0] not in "_.":
            found.append(file.toUri().getPath())
    return sorted(found)


def plain_path(spark: SparkSession, uri: str) -> str:
    """Path of an encoded URI, such as Spark's ``_metadata.file_path``, without scheme and host."""
    return spark._jvm.java.net.URI(uri).getPath()


def list_directories(spark: SparkSession, path: str) -> list[str]:
    """Sorted names of the folders right under ``path``; empty if it is absent."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def read_note(spark: SparkSession, path: str) -> str | None:
    """Content of a small text file, or None if it is absent."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file under a temporary name, then rename it into place."""
    write_bytes(spark, path, text.encode("utf-8"))


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Write a file under a temporary name, then rename it into place; replaces an old one."""
    fs, p = _open(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()
    if fs.exists(p):
        fs.delete(p, True)
    if not fs.rename(draft, p):
        raise OSError(f"could not write {path}")


@cache
def _own_folder(application: str) -> str:
    """A folder of this machine for one session without a shared one; removed at exit."""
    path = tempfile.mkdtemp(prefix="viewmart-")
    atexit.register(shutil.rmtree, path, True)
    return Path(path).as_uri()


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name that every executor can reach.

    It lies under the shared folder named by ``spark.checkpoint.dir``. Only a local
    session without that setting gets a folder of the machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = _own_folder(spark.sparkContext.applicationId)
    return f"{shared.rstrip('/')}/viewmart/{label}-{uuid.uuid4().hex}"
