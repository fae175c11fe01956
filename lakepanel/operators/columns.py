"""Projection operators: rename map, required columns, stamps, keep-lists."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import INGESTED_AT, SOURCE_FILE


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Raise before any job runs when an expected column is absent."""
    present = set(df.columns)
    missing = [c for c in required if c not in present]
    if missing:
        raise MissingColumnsError(f"missing expected columns: {missing}")
    return df


def rename_columns(df: DataFrame, mapping: Mapping[str, str], require: bool = True) -> DataFrame:
    """Rename with one projection; names may hold spaces or ``?``."""
    if require:
        require_columns(df, mapping.keys())
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def keep_columns(df: DataFrame, keep: Iterable[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in keep])


def source_file_column() -> Column:
    """Full path of the file a row came from (batch and streaming file sources)."""
    return F.col("_metadata.file_path")


def stamp_ingest(df: DataFrame, source: Column | str | None = None) -> DataFrame:
    """Add ``_ingested_at`` and ``_source_file`` (a file path column or a literal)."""
    if source is None:
        source_col = source_file_column()
    elif isinstance(source, str):
        source_col = F.lit(source)
    else:
        source_col = source
    return df.withColumns({INGESTED_AT: F.current_timestamp(), SOURCE_FILE: source_col})
