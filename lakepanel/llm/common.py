"""Helpers shared by the operators: code shipping, stored steps, Arrow batches."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import work_dir


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 2048


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per SparkContext.

    Also bounds the rows of an Arrow batch where the session allows more: with
    long texts, the default of 10,000 rows makes batches of tens of megabytes.

    The zip is built in the driver's temporary folder and distributed by
    Spark itself, so executors need no shared folder and no PYTHONPATH.
    """
    if int(spark.conf.get(ARROW_ROWS)) > BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))
    sc = spark.sparkContext
    if getattr(sc, "_lakepanel_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="lakepanel-code-"), "lakepanel.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(target)
    sc._lakepanel_shipped = True


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts lineage the way ``checkpoint()`` does, but columnar and compressed;
    the files survive the loss of any executor.
    """
    spark = df.sparkSession
    path = work_dir(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def own_names(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that ``df`` does not have: the given ones, lengthened where they clash."""
    held = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in held:
            name += "_"
        held.add(name.lower())
        out.append(name)
    return out


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a string (UTF-8) or binary column, its n + 1 offsets from 0, and its null mask.

    A null counts as an empty text.  No per-row Python: the Arrow buffers are
    viewed as numpy arrays.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    plain = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    column = column.cast(pa.large_binary() if plain else pa.large_string())
    nulls = np.asarray(column.is_null())
    if nulls.any():
        column = column.fill_null(b"" if plain else "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0], nulls


def pieces(batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``max_bytes`` of text each (one row at least).

    Bounds the working arrays of a task whatever the batch's row count; a
    single text longer than the bound is a slice of its own.
    """
    col = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string())
    if len(col) == 0:
        return
    ends = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    start = 0
    while start < len(col):
        stop = int(np.searchsorted(ends, ends[start] + max_bytes, side="right")) - 1
        stop = min(max(stop, start + 1), len(col))
        yield batch.slice(start, stop - start)
        start = stop
