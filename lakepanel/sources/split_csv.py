"""Quoted multi-line CSV read in parallel: many tasks per file.

Spark's multi-line CSV reader takes a whole file per task, because a line feed
ends a record only outside quotes, and whether a place lies inside quotes
depends on everything before it.  That dependence is one bit per byte range:

1. **Census.**  One scan of the physical lines, cut wherever Spark's file splits
   cut them.  Per split: its quotes (those at a field's edge; doubled ones
   cancel out), the first and last line that flips between inside and outside,
   and the first line of the file.  One small row per split is stored.
2. **Prefix parity.**  The sum of the quotes before a split tells whether it
   begins inside a quoted field.
3. **Records.**  Each split's lines are grouped to records in their own task.
   The two lines' worth of text at its edges that belong to a record of the
   split before or after (*fragments*: at most a head and a tail per split) are
   the only rows shuffled; they are put together per file.
4. **Fields.**  ``from_csv`` parses each record with the options of the
   multi-line reader.

The result equals ``read_quoted_csv`` row for row, for records ended by ``\\n``
or ``\\r\\n``.  A quote inside an unquoted field is text, as it is there, unless
it touches a delimiter or the line's end: such a file has to be read by
``read_quoted_csv``.  A file whose quotes do not close is refused.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..constants import NUMERIC_ID_PATTERN, SOURCE_FILE
from ..functions.parse import is_numeric_id
from ..operators.columns import stamp_ingest
from ..session import work_dir
from .files import QUOTED_MULTILINE_CSV, read_quoted_csv

MIN_PARTITIONS = "spark.sql.files.minPartitionNum"
FIELD_OPTIONS = {k: v for k, v in QUOTED_MULTILINE_CSV.items() if k not in ("header", "inferSchema")}


def edge_quotes(line: Column, sep: str = ",") -> Column:
    """Quotes of a line that open or close a field; doubled quotes cancel out."""
    d = re.escape(sep)
    single = F.regexp_replace(line, '""', "")
    edges = F.regexp_count(single, F.lit(f'(?<=^|{d})"|"(?={d}|\\r?$)'))
    return F.when(line.contains('"'), edges).otherwise(F.lit(0))


def _lines(spark: SparkSession, paths: list[str], sep: str) -> DataFrame:
    """``file, block, id, line, quotes`` of every physical line; ``id`` ascends within a split."""
    if spark.conf.get(MIN_PARTITIONS, None) is None:
        # All scans have to cut and pack the files alike, also if executors come or go meanwhile.
        spark.conf.set(MIN_PARTITIONS, str(spark.sparkContext.defaultParallelism))
    text = spark.read.option("lineSep", "\n").text(paths)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        F.col("value").alias("line"),
        edge_quotes(F.col("value"), sep).alias("quotes"),
    )


def _blank(line: str) -> Column:
    return F.col(line).isin("", "\r")


@dataclass
class SplitCsv:
    """Quoted CSV files with the stored state of each of their splits.

    ``splits``: ``file, block, lines, first_id, last_id, first_flip, last_flip,
    inside, ends_inside, crlf, header_id, header_line, header_whole``.
    """

    spark: SparkSession
    paths: list[str]
    sep: str
    splits: DataFrame

    @classmethod
    def open(cls, spark: SparkSession, paths: str | list[str], sep: str = ",") -> SplitCsv:
        """Scan the files' lines once and store one row per split."""
        paths = [paths] if isinstance(paths, str) else list(paths)
        flips = F.col("quotes") % 2 == 1
        shown = F.struct("id", F.col("line").alias("text"), F.col("quotes"))
        census = (
            _lines(spark, paths, sep)
            .groupBy("file", "block")
            .agg(
                F.count(F.lit(1)).alias("lines"),
                F.min("id").alias("first_id"),
                F.max("id").alias("last_id"),
                F.min(F.when(flips, F.col("id"))).alias("first_flip"),
                F.max(F.when(flips, F.col("id"))).alias("last_flip"),
                F.sum("quotes").alias("quotes"),
                F.min(F.when((F.col("block") == 0) & ~_blank("line"), shown)).alias("head"),
            )
        )
        # Splits of one file: some thousands for a terabyte.
        before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        whole = Window.partitionBy("file")
        so_far = F.coalesce(F.sum("quotes").over(before), F.lit(0))
        closed = F.when(
            F.sum("quotes").over(whole) % 2 == 1,
            F.raise_error(F.concat(F.lit("a quoted field does not end: "), F.col("file"))),
        ).otherwise(F.lit(True))
        first = F.max("head").over(whole)
        states = census.select(
            "file", "block", "lines", "first_id", "last_id", "first_flip", "last_flip",
            (so_far % 2 == 1).alias("inside"),
            ((so_far + F.col("quotes")) % 2 == 1).alias("ends_inside"),
            F.coalesce(first["text"].endswith("\r"), F.lit(False)).alias("crlf"),
            first["id"].alias("header_id"),
            first["text"].alias("header_line"),
            (first["quotes"] % 2 == 0).alias("header_whole"),
            closed.alias("closed"),
        )
        path = work_dir(spark, "split_csv")
        states.write.parquet(path)
        return cls(spark, paths, sep, spark.read.schema(states.schema).parquet(path))

    # ------------------------------------------------------------- headers
    def headers(self) -> DataFrame:
        """``file, header``: the header record of every file that has one (one row per file)."""
        top = self.splits.where((F.col("block") == 0) & F.col("header_line").isNotNull())
        line = top.where("header_whole").select("file", _without_cr(F.col("header_line"), F.col("crlf")).alias("header"))
        if top.where("NOT header_whole").isEmpty():
            return line
        return self.records(header=True).select("file", F.col("record").alias("header"))

    # ------------------------------------------------------------- records
    def _joined(self) -> DataFrame:
        """Lines with their split's state; a line outside what the census saw is an error."""
        state = self.splits.select(
            "file", "block", "first_id", "last_id", "first_flip", "last_flip", "inside", "ends_inside", "crlf", "header_id"
        )
        lines = _lines(self.spark, self.paths, self.sep).join(state, ["file", "block"], "left")
        moved = ~F.coalesce(F.col("id").between(F.col("first_id"), F.col("last_id")), F.lit(False))
        line = F.when(moved, F.raise_error(F.lit("the files or their splits changed while they were read"))).otherwise(F.col("line"))
        return lines.withColumns({
            "line": line,
            "header": F.col("id").eqNullSafe(F.col("header_id")),
            # Lines of the record that the split before began; lines of the one that the next split ends.
            "in_head": F.col("inside") & F.coalesce(F.col("id") <= F.col("first_flip"), F.lit(True)),
            "in_tail": F.col("ends_inside") & F.coalesce(F.col("id") >= F.col("last_flip"), F.lit(False)),
        })

    def records(self, header: bool = False) -> DataFrame:
        """``file, record`` of every non-empty record, headers apart (only they with ``header``)."""
        joined = self._joined()
        inner = (
            joined.where(~F.col("in_head") & ~F.col("in_tail"))
            .sortWithinPartitions("file", "block", "id")  # in order whatever way the states were joined
            .select("file", "crlf", "header", "line", "quotes")
            .mapInArrow(_grouped, "file string, crlf boolean, header boolean, record string")
        )
        order = Window.partitionBy("file").orderBy("block", "in_tail", "id")
        opens = F.col("in_tail") & (F.col("id") == F.col("last_flip"))
        edges = joined.where(F.col("in_head") | F.col("in_tail")).select(
            "file", "block", "in_tail", "id", "line", "crlf", "header", F.sum(opens.cast("int")).over(order).alias("number")
        )
        pieced = F.array_sort(F.collect_list(F.struct("block", "in_tail", "id", "line")))
        stitched = edges.groupBy("file", "number").agg(
            F.max("crlf").alias("crlf"),
            F.max("header").alias("header"),
            F.concat_ws("\n", F.transform(pieced, lambda x: x["line"])).alias("record"),
        )
        both = inner.unionByName(stitched.select("file", "crlf", "header", "record"))
        kept = both.where(~_blank("record") & (F.col("header") if header else ~F.col("header")))
        return kept.select("file", _without_cr(F.col("record"), F.col("crlf")).alias("record"))

    def rows(self, schema: StructType | str, file_col: str | None = None) -> DataFrame:
        """Parsed records of all files under one schema, optionally with their file's path."""
        ddl = schema if isinstance(schema, str) else ", ".join(
            f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema
        )
        parsed = self.records().select(F.from_csv("record", ddl, {**FIELD_OPTIONS, "sep": self.sep}).alias("row"), "file")
        return parsed.select("row.*", *([F.col("file").alias(file_col)] if file_col else []))


def _without_cr(record: Column, crlf: Column) -> Column:
    """Records of a file with ``\\r\\n`` line ends as the CSV reader sees them."""
    plain = F.regexp_replace(F.regexp_replace(record, "\\r$", ""), "\\r\\n", "\n")
    return F.when(crlf, plain).otherwise(record)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of whole records, in order, to records; no more than an open record is held."""

    def out(held: list[pa.RecordBatch], starts: np.ndarray) -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks()
        lines = whole.column("line").combine_chunks()
        ends = pa.array(np.append(starts, len(lines)), pa.int32())
        first = pa.array(starts, pa.int64())
        columns = [whole.column(c).take(first).combine_chunks() for c in ("file", "crlf", "header")]
        return pa.record_batch([*columns, pc.binary_join(pa.ListArray.from_arrays(ends, lines), "\n")], ["file", "crlf", "header", "record"])

    held: list[pa.RecordBatch] = []
    n_held = inside = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        quotes = np.asarray(batch.column(batch.schema.get_field_index("quotes")), np.int64)
        after = inside + np.cumsum(quotes)
        starts = np.flatnonzero((after - quotes) % 2 == 0)
        inside = int(after[-1] % 2)
        if len(starts):
            last = int(starts[-1])
            before = np.append(np.zeros(int(n_held > 0), np.int64), n_held + starts[:-1]).astype(np.int64)
            if n_held + last:
                yield out([*held, batch.slice(0, last)], before)
            held, n_held = [], 0
            batch = batch.slice(last)
        held.append(batch)
        n_held += batch.num_rows
    if held:
        yield out(held, np.zeros(1, np.int64))


def read_split_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    file_col: str | None = None,
) -> DataFrame:
    """Like ``read_quoted_csv`` (all columns text, one header per file), with many tasks per file.

    The census runs at once; the rows are read lazily.  ``file_col`` adds each
    row's file path under that name (``_metadata`` is not available after it).
    """
    if schema is None:
        schema = read_quoted_csv(spark, path).schema
    return SplitCsv.open(spark, path).rows(schema, file_col)


def bronze_split_csv(
    spark: SparkSession,
    path: str | list[str],
    id_col: str | None = None,
    id_pattern: str = NUMERIC_ID_PATTERN,
    source: Column | str | None = None,
) -> DataFrame:
    """``bronze_csv`` (text columns, optional id check, stamps), with many tasks per file."""
    df = read_split_csv(spark, path, file_col=SOURCE_FILE)
    if id_col is not None:
        df = df.where(is_numeric_id(F.col(f"`{id_col}`"), id_pattern))
    return stamp_ingest(df, F.col(SOURCE_FILE) if source is None else source)
