"""Atomic replacement of stored tables (A8, A9): versioned folders and commit files.

A table is a folder. Each version is written whole into a data folder of its own; then a
commit file, named by the version number, is created and names that folder. Readers take
the highest complete commit, so they see one whole version whatever happens to a writer:
until its commit file is complete, what it wrote is not there. Two writers that start from
the same version want the same commit file, which the file system creates for one of them
only; the other fails and its result is dropped.

Only listing, creating and deleting files through the Hadoop file system is needed, no
rename, so object stores that can create a file conditionally will do.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

COMMITS = "_commits"


class ConcurrentWrite(RuntimeError):
    """Another writer has replaced the table since it was read."""


def _fs(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _child(spark: SparkSession, path: str, *names: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *names]))


def _commit_name(version: int) -> str:
    return f"{version:012d}"


def _committed(spark: SparkSession, path: str, version: int) -> str | None:
    """Data folder of a version; None while its commit file is missing or not complete."""
    fs, _ = _fs(spark, path)
    name = _child(spark, path, COMMITS, _commit_name(version))
    if not fs.exists(name):
        return None
    stream = fs.open(name)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return text[:-1] if text.endswith("\n") else None


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions, ascending."""
    fs, _ = _fs(spark, path)
    folder = _child(spark, path, COMMITS)
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return [v for v in sorted(int(n) for n in names if n.isdigit()) if _committed(spark, path, v)]


def _highest_claimed(spark: SparkSession, path: str) -> int:
    fs, _ = _fs(spark, path)
    folder = _child(spark, path, COMMITS)
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return max((int(n) for n in names if n.isdigit()), default=0)


def current_version(spark: SparkSession, path: str) -> int:
    """Number of the version that readers see; 0: none yet."""
    return max(versions(spark, path), default=0)


def read_version(spark: SparkSession, path: str, version: int | None = None, fmt: str = "parquet") -> DataFrame:
    """The table as of ``version`` (the current one by default)."""
    number = current_version(spark, path) if version is None else version
    folder = _committed(spark, path, number) if number else None
    if folder is None:
        raise FileNotFoundError(f"Input not found: {path}" + (f" version {version}" if version else ""))
    return spark.read.format(fmt).load(f"{path.rstrip('/')}/{folder}")


def write_version(df: DataFrame, path: str, expected: int | None = None, fmt: str = "parquet",
                  partition_by: Iterable[str] = ()) -> int:
    """Write ``df`` as the next version of the table and return its number.

    ``expected``: the version that ``df`` was made from; by default the one that is current now.
    ConcurrentWrite if another writer commits first: the table stays as that writer left it.
    A commit that broke off halfway is passed over by readers and by later writers.
    """
    spark = df.sparkSession
    base = current_version(spark, path) if expected is None else expected
    if current_version(spark, path) != base:
        raise ConcurrentWrite(f"{path}: version {base} is not the current one any more")
    number = max(base, _highest_claimed(spark, path)) + 1  # the number that the writer competes for
    folder = f"data-{_commit_name(number)}-{uuid.uuid4().hex}"
    writer = df.write.format(fmt)
    parts = list(partition_by)
    (writer.partitionBy(*parts) if parts else writer).save(f"{path.rstrip('/')}/{folder}")
    try:
        _commit(spark, path, number, folder, base)
    except BaseException:
        fs, _ = _fs(spark, path)
        fs.delete(_child(spark, path, folder), True)
        raise
    return number


def _commit(spark: SparkSession, path: str, number: int, folder: str, base: int) -> None:
    if current_version(spark, path) != base:
        raise ConcurrentWrite(f"{path}: version {base} is not the current one any more")
    fs, _ = _fs(spark, path)
    name = _child(spark, path, COMMITS, _commit_name(number))
    try:
        stream = fs.create(name, False)  # fails where the file exists
    except Py4JJavaError as exc:
        if "Exists" in exc.java_exception.getClass().getSimpleName() or fs.exists(name):
            raise ConcurrentWrite(f"{path}: version {number} was written by another writer") from exc
        raise
    try:
        stream.write(bytearray(f"{folder}\n".encode()))
    finally:
        stream.close()


def replace(spark: SparkSession, path: str, fn: Callable[[DataFrame], DataFrame], fmt: str = "parquet",
            partition_by: Iterable[str] = ()) -> int:
    """Read the current version, transform it and make the result the next one."""
    base = current_version(spark, path)
    return write_version(fn(read_version(spark, path, base, fmt)), path, base, fmt, partition_by)


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete all but the last ``keep`` versions, commit file first; returns what went. Readers that still hold a dropped
    version lose its files, so keep as many as the longest read needs."""
    fs, _ = _fs(spark, path)
    old = versions(spark, path)[:-keep] if keep > 0 else []
    for number in old:
        folder = _committed(spark, path, number)
        fs.delete(_child(spark, path, COMMITS, _commit_name(number)), False)
        fs.delete(_child(spark, path, folder), True)
    return old
