"""File sources: quoted multi-line CSV, plain CSV, NDJSON month folders, text.

Bronze reads keep every column as text (no inference): typing happens in
silver with ANSI-safe parsers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..constants import NUMERIC_ID_PATTERN
from ..functions.parse import is_numeric_id
from ..operators.columns import stamp_ingest

# Quoted fields may hold the delimiter, doubled quotes and line breaks.
QUOTED_MULTILINE_CSV = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "inferSchema": "false",
}


def read_quoted_csv(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None) -> DataFrame:
    """CSV whose quoted fields may span lines; all columns text.

    A multi-line CSV file cannot be split, so it is read by one task per file:
    land large sources as many files, and keep the Parquet copy (bronze) for
    everything downstream.
    """
    reader = spark.read.options(**QUOTED_MULTILINE_CSV)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_plain_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Header-only CSV read (one record per physical line)."""
    return spark.read.option("header", "true").csv(path)


def read_csv_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with inferred column types (one extra pass; for exploration)."""
    return spark.read.options(header="true", inferSchema="true", multiLine="true", quote='"', escape='"').csv(path)


def read_ndjson(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One JSON object per line with a declared schema (no inference pass)."""
    return spark.read.schema(schema).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw physical lines, as written."""
    return spark.read.text(path)


def line_preview(spark: SparkSession, path: str, n: int = 3) -> DataFrame:
    """The first ``n`` physical lines of a file (a look before a parse)."""
    return read_lines(spark, path).limit(n)


def bronze_csv(
    spark: SparkSession,
    path: str | list[str],
    id_col: str | None = None,
    id_pattern: str = NUMERIC_ID_PATTERN,
    source: Column | str | None = None,
) -> DataFrame:
    """Bronze landing of a quoted CSV: text columns, optional id check, stamps.

    ``id_col`` drops rows whose id is not numeric (summary footers, fragments).
    ``source`` defaults to the file path of each row.
    """
    df = read_quoted_csv(spark, path)
    if id_col is not None:
        df = df.where(is_numeric_id(F.col(f"`{id_col}`"), id_pattern))
    return stamp_ingest(df, source)


def month_from_path(pattern: str = r"(\d{4}-\d{2})") -> Column:
    """``yyyy-MM`` month taken from the file path of each row (null when absent)."""
    return F.nullif(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1), F.lit(""))


def read_month_files(
    spark: SparkSession, glob: str, month_col: str = "file_month", pattern: str = r"(\d{4}-\d{2})"
) -> DataFrame:
    """History folder of one quoted CSV per month; the month comes from the path."""
    return read_quoted_csv(spark, glob).withColumn(month_col, month_from_path(pattern))
