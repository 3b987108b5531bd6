"""Atomic switches between versions of stored folders.

``<root>/_versions/<number>`` is a small file that lists the folders of one version, relative to the root. The
largest number holds. A switch adds the next number, written beside and renamed, and takes nothing away before: a
reader finds the version before or the new one, never none, and a writer that dies leaves the version before. The
lists of the last two versions stay, and so do the folders they name, which running reads may hold.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

VERSION = "_v"


def file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def read_small_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small metadata file, or None if there is no such file."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that isn't there yet: beside it, then renamed."""
    fs, p = file_system(spark, path)
    tmp = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(tmp, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if fs.exists(p) or not fs.rename(tmp, p):
        fs.delete(tmp, False)
        raise FileExistsError(f"another writer has published {path}")


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Published version numbers, in ascending order."""
    fs, p = file_system(spark, f"{root}/_versions")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n) for n in names if n.isdigit())


def current(spark: SparkSession, root: str) -> tuple[int, list[str]]:
    """The version that holds and its folders; (0, []) if none was published."""
    known = numbers(spark, root)
    return (known[-1], _folders(spark, root, known[-1])) if known else (0, [])


def _folders(spark: SparkSession, root: str, number: int) -> list[str]:
    return (read_small_text(spark, f"{root}/_versions/{number:08d}") or "").split("\n")[:-1]


def publish(spark: SparkSession, root: str, number: int, folders: list[str]) -> None:
    """Switch to version ``number``, the one after the current one, and delete what neither of the two names."""
    _write_new(spark, f"{root}/_versions/{number:08d}", "".join(f"{f}\n" for f in folders))
    known = numbers(spark, root)
    before = _folders(spark, root, known[-2]) if len(known) > 1 else []
    gone = {f for n in known[:-2] for f in _folders(spark, root, n)} - set(folders) - set(before)
    fs, p = file_system(spark, root)
    for f in gone:
        # a folder that holds one of the named folders stays, less its other children
        _delete_but(fs, spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{f}"), f, set(folders) | set(before))
    for n in known[:-2]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_versions/{n:08d}"), False)


def _delete_but(fs, path, name: str, keep: set[str]) -> None:
    if name in keep or not fs.exists(path):
        return
    if not any(k.startswith(f"{name}/") for k in keep):
        fs.delete(path, True)
        return
    for s in fs.listStatus(path):
        if s.isDirectory():
            _delete_but(fs, s.getPath(), f"{name}/{s.getPath().getName()}", keep)


def leaves(spark: SparkSession, root: str, folder: str, depth: int) -> list[str]:
    """The partition folders ``depth`` levels below a folder, relative to the root."""
    fs, p = file_system(spark, f"{root}/{folder}")
    found = [folder] if fs.exists(p) else []
    for _ in range(depth):
        found = [f"{f}/{s.getPath().getName()}" for f in found
                 for s in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{f}"))
                 if s.isDirectory() and "=" in s.getPath().getName()]
    return found


def partition_of(folder: str) -> str:
    """The partition part of a folder, without table and version: ``ano=1996/mes=1``."""
    return folder.partition(f"{VERSION}=")[2].partition("/")[2]


def read_folders(spark: SparkSession, root: str, folders: list[str], schema: T.StructType | None = None) -> DataFrame:
    """Partition folders of one table (``root`` is the table's), of whatever versions, as one frame."""
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(VERSION, T.StringType(), True)]))
    return reader.parquet(*[f"{root}/{f}" for f in folders]).drop(VERSION)
