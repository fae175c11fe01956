"""Sinks: full-refresh tables, month-partitioned NDJSON landing.

A new version is written beside the old one by a Spark job commit, checked, and
then switched in.  Catalog tables (``save_table``) and versioned folders
(``versions.write_version``) switch by one atomic change of a pointer, so
readers find the old or the new table whatever step a writer dies at.
``write_table`` keeps the plain folder layout, for folders nobody reads while
they are replaced: it moves the old version aside and the new one in.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import read_ndjson
from .versions import hadoop_path


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                check: Callable[[], object] | None = None) -> None:
    """Full refresh of a Parquet table (column names may hold spaces or ``?``).

    ``check`` runs after the new version is complete and before it replaces
    the old one; if it raises, the old table stays.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    tag = uuid.uuid4().hex[:12]
    (target, fs), (staged, _), (old, _) = (hadoop_path(spark, p) for p in (path, f"{path}__new_{tag}", f"{path}__old_{tag}"))
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.parquet(staged.toString())
        if check:
            check()
    except BaseException:
        fs.delete(staged, True)
        raise
    replaces = fs.exists(target)
    if replaces and not fs.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(staged, target):
        if replaces:
            fs.rename(old, target)
        raise OSError(f"cannot publish {path}")
    if replaces:
        fs.delete(old, True)
    spark.catalog.refreshByPath(path)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def save_view(spark: SparkSession, name: str, query: str, comment: str | None = None,
              quality: str | None = None) -> None:
    """A catalog view over stored tables, with comment and layer property, in one change."""
    about = f" COMMENT {_quoted(comment)}" if comment else ""
    layer = f" TBLPROPERTIES ('quality' = {_quoted(quality)})" if quality else ""
    spark.sql(f"CREATE OR REPLACE VIEW {name}{about}{layer} AS {query}")


def save_comment(spark: SparkSession, name: str, comment: str | None, quality: str | None) -> None:
    """Comment and layer property of a catalog table."""
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(comment)}")
    if quality:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('quality' = {_quoted(quality)})")


VERSIONS = "__versions"


def _version_tables(spark: SparkSession, database: str, short: str) -> list[str]:
    """Tables behind a published name, oldest first."""
    pattern = re.compile(re.escape(short) + r"__v\d{8}_[0-9a-f]{12}")
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    return sorted(n for n in names if pattern.fullmatch(n))


def save_table(df: DataFrame, name: str, comment: str | None = None, quality: str | None = None,
               partition_by: list[str] | None = None, check: Callable[[], object] | None = None, keep: int = 2) -> None:
    """Full refresh of a catalog table, with optional comment and layer property.

    Every version is a table of its own (folder, schema and partitions) in the
    database ``<database>__versions``; the published name is a view on the
    current one.  ``CREATE OR REPLACE VIEW`` is a single change in the catalog
    and carries columns, comment and property, so no reader meets a missing or
    half-described table.  The version before stays for readers that have begun
    with it; older ones go.  A plain table of that name (an older layout) is
    replaced once.
    """
    spark = df.sparkSession
    database, _, short = name.rpartition(".")
    database = database or spark.catalog.currentDatabase()
    base = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    versions = f"{database}{VERSIONS}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {versions} LOCATION {_quoted(base + '/' + VERSIONS)}")
    older = _version_tables(spark, versions, short)
    number = int(older[-1][len(short) + 3:].split("_")[0]) + 1 if older else 0
    version = f"{short}__v{number:08d}_{uuid.uuid4().hex[:12]}"
    folder, fs = hadoop_path(spark, f"{base}/{VERSIONS}/{version}")
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.parquet(folder.toString())
        if check:
            check()
    except BaseException:
        fs.delete(folder, True)
        raise
    spark.sql(f"CREATE TABLE {versions}.{version} USING parquet LOCATION {_quoted(folder.toString())}")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {versions}.{version}")
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    save_view(spark, name, f"SELECT * FROM {versions}.{version}", comment, quality)
    for old in [*older, version][:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {versions}.{old}")
        fs.delete(hadoop_path(spark, f"{base}/{VERSIONS}/{old}")[0], True)


def write_csv(df: DataFrame, path: str, files: int | None = None,
              partition_by: list[str] | None = None, max_records: int = 0) -> None:
    """Quoted CSV with header, readable back by ``read_quoted_csv``.

    ``max_records`` a file (0: no bound): a multi-line file is read by one task.
    """
    if files:
        df = df.repartition(files)
    (df.write.mode("overwrite")
     .options(header="true", quote='"', escape='"',
              ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
              maxRecordsPerFile=str(max_records))
     .partitionBy(*(partition_by or []))
     .csv(path))


def land_month_partitions(df: DataFrame, path: str, date_col: str, key: str = "dt") -> None:
    """NDJSON landing, one folder ``dt=yyyy-MM`` per month.

    Dynamic partition overwrite replaces only the months present in ``df``,
    so re-running one month leaves every other month as it was (resumable).
    Rows are clustered by month first (a REBALANCE, which AQE splits where a
    month is hot and coalesces where months are small) so each month lands
    in a few files rather than one file per task.
    """
    month = F.date_format(F.col(date_col), "yyyy-MM")
    out = df.withColumn(key, month).hint("rebalance", key)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(key).json(path))


def read_month_partitions(spark: SparkSession, path: str, schema: str, key: str = "dt") -> DataFrame:
    """Read a ``dt=yyyy-MM`` landing back; the month key stays text."""
    # Declaring the key as text keeps "1996-03" from being read as a date.
    return read_ndjson(spark, path, f"{schema}, {key} string")
