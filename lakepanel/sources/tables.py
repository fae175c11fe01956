"""Named tables: driver parquet tables and in-memory rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

# A task renders and types at most about this many rows.
ROWS_PER_TASK = 100_000

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def spread_rows(df: DataFrame, by: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The rows of a stored table dealt by hash to as many tasks as they need.

    A Parquet file may hold all its rows in one row group, which one task reads.
    Rows are counted from the files' footers; few enough rows stay as they are.
    """
    tasks = -(-df.count() // rows_per_task)
    return df.repartition(tasks, *by) if tasks > 1 else df


def register_tables(spark: SparkSession, sf_dir: str, names: Iterable[str] = DRIVER_TABLES) -> None:
    """Expose driver tables as temp views for ``spark.sql``."""
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)


def rows_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)
