"""A corpus that can be replaced by what was made from it.

``path`` holds one folder of data for each version and a folder of manifests, one small file for each committed version,
which names its data. A version is written under a name of its own and then committed by renaming its manifest into
place, which fails if another writer has taken the number. Readers take the newest manifest, so an interrupted write
leaves the corpus as it was, and a job may read the corpus that it replaces.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_MANIFESTS = "_versions"


def _files(spark: SparkSession, path: str):
    """(the Hadoop file context of a path, a function that makes paths)."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system, jvm.org.apache.hadoop.fs.Path


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, data folder) of every committed version, in order."""
    system, to_path = _files(spark, path)
    folder = to_path(f"{path}/{_MANIFESTS}")
    if not system.exists(folder):
        return []
    names = [s.getPath().getName() for s in system.listStatus(folder)]
    return sorted((int(number), f"{path}/{data}") for number, _, data in (n.partition("-") for n in names) if number.isdigit())


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed version."""
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no committed version in {path}")
    return spark.read.parquet(found[-1][1])


def write_version(df: DataFrame, path: str, after: int | None = None) -> int:
    """Write ``df`` as the next version and commit it; with ``after``, only if that is the newest one still."""
    spark = df.sparkSession
    data = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{data}")
    found = versions(spark, path)
    newest = found[-1][0] if found else 0
    if after is not None and newest != after:
        raise RuntimeError(f"version {newest} of {path} was committed while version {after} was being replaced")
    _commit(spark, path, newest + 1, data)
    return newest + 1


def _commit(spark: SparkSession, path: str, number: int, data: str) -> None:
    """Take a version number: the manifest of that number must not exist, and appears at once."""
    system, to_path = _files(spark, path)
    folder = to_path(f"{path}/{_MANIFESTS}")
    system.mkdirs(folder)
    # The number itself is taken by a folder: making one that exists fails on every file system.
    taken = to_path(f"{path}/{_MANIFESTS}/.taken-{number:010d}")
    if system.exists(taken) or not system.mkdirs(taken):
        raise RuntimeError(f"version {number} of {path} is taken by another writer")
    draft = to_path(f"{path}/{_MANIFESTS}/.draft-{uuid.uuid4().hex}")
    system.create(draft, True).close()
    if not system.rename(draft, to_path(f"{path}/{_MANIFESTS}/{number:010d}-{data}")):
        raise RuntimeError(f"version {number} of {path} could not be committed")


def replace_corpus(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame]) -> int:
    """Replace a corpus by what ``change`` makes of it."""
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no committed version in {path}")
    number, data = found[-1]
    return write_version(change(spark.read.parquet(data)), path, after=number)


def drop_versions(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Remove the data of all but the newest versions; nobody may read them any more."""
    system, to_path = _files(spark, path)
    for number, data in versions(spark, path)[: -keep or None]:
        system.delete(to_path(f"{path}/{_MANIFESTS}/{number:010d}-{data.rsplit('/', 1)[1]}"), False)
        system.delete(to_path(data), True)
