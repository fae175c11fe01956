"""Tables and logs whose current version is named by one atomic marker.

A version is a folder that a Spark job commit has completed.  It becomes
current when an empty marker file ``_current/<number>~<name>`` appears: creating
an empty file is one atomic operation on every file system and object store,
nothing is renamed or overwritten, and the highest number counts.  Whatever
step a writer dies at, readers find the version before or the one after.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MARKERS = "_current"


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def markers(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """(number, name) of every marker in ``folder``, oldest first."""
    target, fs = hadoop_path(spark, f"{folder.rstrip('/')}/{MARKERS}")
    if not fs.exists(target):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(target)]
    return sorted((int(n.split("~", 1)[0]), n.split("~", 1)[1]) for n in names if "~" in n)


def current(spark: SparkSession, folder: str) -> str | None:
    """Name of the current version; None before the first."""
    found = markers(spark, folder)
    return found[-1][1] if found else None


def point_to(spark: SparkSession, folder: str, name: str) -> None:
    """Make ``name`` the current version of ``folder`` (one writer at a time)."""
    found = markers(spark, folder)
    number = found[-1][0] + 1 if found else 0
    target, fs = hadoop_path(spark, f"{folder.rstrip('/')}/{MARKERS}/{number:012d}~{name}")
    if not fs.createNewFile(target):
        raise OSError(f"{target} exists: another writer is publishing to {folder}")


def forget_old(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Drop all markers but the last ``keep``; the names that no marker has any more, oldest first."""
    found = markers(spark, folder)
    held = {name for _, name in found[-keep:]}
    gone = []
    for number, name in found[:-keep]:
        target, fs = hadoop_path(spark, f"{folder.rstrip('/')}/{MARKERS}/{number:012d}~{name}")
        fs.delete(target, False)
        if name not in held and name not in gone:
            gone.append(name)
    return gone


def write_version(
    df: DataFrame, folder: str, partition_by: list[str] | None = None, check: Callable[[], object] | None = None, keep: int = 2
) -> None:
    """Full refresh of a versioned Parquet table.

    The new version is written to a folder of its own; ``check`` runs when it is
    complete, and if it raises, the version is removed and the old one stays
    current.  Then one marker switches.  The version before stays for readers
    that have begun with it; older ones go.
    """
    spark, folder = df.sparkSession, folder.rstrip("/")
    name = f"data_{uuid.uuid4().hex[:12]}"
    target, fs = hadoop_path(spark, f"{folder}/{name}")
    try:
        df.write.partitionBy(*(partition_by or [])).parquet(target.toString())
        if check:
            check()
    except BaseException:
        fs.delete(target, True)
        raise
    point_to(spark, folder, name)
    for old in forget_old(spark, folder, keep):
        fs.delete(hadoop_path(spark, f"{folder}/{old}")[0], True)


def is_versioned(spark: SparkSession, folder: str) -> bool:
    return current(spark, folder) is not None


def read_version(spark: SparkSession, folder: str) -> DataFrame:
    """The current version of a versioned table."""
    name = current(spark, folder)
    if name is None:
        raise FileNotFoundError(f"{folder} has no published version")
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}")
