"""Incremental CSV ingest whose schema may grow (new columns are added).

A CSV file stream with a fixed schema binds columns by *position*: a file
whose header gains a column in the middle would silently shift every value
after it.  So the stream carries only file *paths*:

    binaryFile stream, select("path")   (file content is never read here)
      -> foreachBatch: one census job over the batch's files (split_csv), on executors
      -> (file, header) rows to the driver; files grouped by header
      -> one parallel read of all records; columns bound by name per header
      -> numeric-id filter, ingest stamps
      -> overwrite folder batch_id=<n>     (a replayed batch rewrites itself)
      -> manifest of the batch: rows, files, schema

The driver opens no data file.  A large file is read by many tasks.  A file
without the id column is set aside: its path and header go to ``rejected_path``
and the batch's other files land; ``retry_rejected`` takes it again once it is
mended.

**Manifest.**  A batch counts from the moment its manifest is written, and
readers take exactly the manifests' batches and the union of their columns: no
footer sweep, no listing of data files, and the stored rows are a sum over
manifests.  With a row floor, batches stay invisible until the stored rows are
above it (``run``), so a refused load never shows.

The file source records processed files in the checkpoint, so a rerun ingests
only new files; ``maxFilesPerTrigger`` bounds how many paths one batch brings to
the driver.
"""

from __future__ import annotations

import csv
import io
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from ..constants import INGESTED_AT, NUMERIC_ID_PATTERN, SOURCE_FILE
from ..functions.parse import is_numeric_id
from ..operators.columns import stamp_ingest
from ..operators.quality import check_row_floor
from ..sources.split_csv import FIELD_OPTIONS, SplitCsv
from ..sources.versions import current, forget_old, hadoop_path, point_to

# Fixed schema of the binaryFile source (only ``path`` is selected, so the
# file content is never read by the stream).
BINARY_FILE_SCHEMA = StructType([
    StructField("path", StringType(), False),
    StructField("modificationTime", TimestampType(), False),
    StructField("length", LongType(), False),
    StructField("content", BinaryType(), True),
])

MANIFEST = "batch bigint, row_count bigint, file_count bigint, rejected_count bigint, columns array<string>"


def _names(header: str) -> tuple[str, ...]:
    """Column names of a header record."""
    return tuple(next(csv.reader(io.StringIO(header.removeprefix("\ufeff"))), ()))


@dataclass
class EvolvingCsvIngest:
    landing_glob: str          # e.g. ".../landing/*/*.csv"
    bronze_path: str
    checkpoint_path: str
    id_col: str | None = None  # keep rows whose id is numeric
    id_pattern: str = NUMERIC_ID_PATTERN
    max_files_per_trigger: int = 1000

    @property
    def rejected_path(self) -> str:
        return f"{self.bronze_path.rstrip('/')}_rejected_files"

    @property
    def manifest_path(self) -> str:
        return f"{self.bronze_path.rstrip('/')}/_manifest"

    # ------------------------------------------------------------- landing
    def _write_batch(self, batch: DataFrame, batch_id: int) -> None:
        paths = sorted(r.path for r in batch.select("path").collect())
        if paths:
            self._land(batch.sparkSession, paths, batch_id)

    def _land(self, spark: SparkSession, paths: list[str], batch_id: int) -> None:
        """Read ``paths`` and store them as one batch, its manifest last."""
        opened = SplitCsv.open(spark, paths)
        headers = [(r["file"], _names(r["header"])) for r in opened.headers().collect()]
        groups: dict[tuple[str, ...], list[str]] = {}
        rejected = []
        for file, header in sorted(headers):
            if header and self.id_col is not None and self.id_col not in header:
                rejected.append((file, list(header), f"no column {self.id_col}"))
            elif header:
                groups.setdefault(header, []).append(file)
        self._set_aside(spark, rejected, batch_id)
        rows, columns = 0, []
        if groups:
            out, obs = self._bound(spark, opened, groups), Observation(f"bronze_batch_{batch_id}")
            out.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(self._folder(batch_id))
            rows, columns = obs.get["rows"], out.columns
        row = [(batch_id, rows, sum(map(len, groups.values())), len(rejected), columns)]
        spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("overwrite").json(f"{self.manifest_path}/batch_id={batch_id}")

    def _folder(self, batch_id: int) -> str:
        return f"{self.bronze_path.rstrip('/')}/batch_id={batch_id}"

    def _set_aside(self, spark: SparkSession, rejected: list[tuple], batch_id: int) -> None:
        if rejected:
            schema = "path string, header array<string>, reason string"
            listed = spark.createDataFrame(rejected, schema).coalesce(1)
            listed.write.mode("overwrite").parquet(f"{self.rejected_path}/batch_id={batch_id}")

    def _bound(self, spark: SparkSession, opened: SplitCsv, groups: dict[tuple[str, ...], list[str]]) -> DataFrame:
        """All records of the batch, parsed once by position, bound to columns by their file's header."""
        headers = list(groups)
        names = list(dict.fromkeys(c for header in headers for c in header))
        width = max(map(len, headers))
        files = [(file, k) for k, header in enumerate(headers) for file in groups[header]]
        numbered = spark.createDataFrame(files, "file string, header_no int")  # a batch's files at most
        ddl = ", ".join(f"c{k} string" for k in range(width))
        parsed = F.from_csv("record", ddl, FIELD_OPTIONS)
        cells = opened.records().join(F.broadcast(numbered), "file").select("file", "header_no", parsed.alias("cell"))

        def column(name: str):
            value = F.lit(None).cast("string")
            for k, header in enumerate(headers):
                if name in header:
                    value = F.when(F.col("header_no") == k, F.col(f"cell.c{header.index(name)}")).otherwise(value)
            return value.alias(name)

        df = cells.select(*[column(c) for c in names], F.col("file").alias(SOURCE_FILE))
        if self.id_col is not None:
            df = df.where(is_numeric_id(F.col(f"`{self.id_col}`"), self.id_pattern))
        return stamp_ingest(df, F.col(SOURCE_FILE))

    # ------------------------------------------------------------- running
    def run(self, spark: SparkSession, row_floor: int | None = None) -> int:
        """Land every file not seen before, then show the new batches; the stored rows.

        With ``row_floor``, a total that is not above it raises and leaves the
        new batches invisible; they count with what lands later.
        """
        if current(spark, self.manifest_path) is None:
            point_to(spark, self.manifest_path, "through=none")
        paths = (
            spark.readStream.format("binaryFile")
            .schema(BINARY_FILE_SCHEMA)
            .option("maxFilesPerTrigger", self.max_files_per_trigger)
            .load(self.landing_glob)
            .select("path")
        )
        query = (
            paths.writeStream.foreachBatch(self._write_batch)
            .option("checkpointLocation", self.checkpoint_path)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return self._show(spark, row_floor)

    def retry_rejected(self, spark: SparkSession, row_floor: int | None = None) -> list[str]:
        """Land the files set aside whose headers are mended by now; their paths.

        They become a batch with a number below zero; those still without the
        id column stay listed.
        """
        target, fs = hadoop_path(spark, self.rejected_path)
        if not fs.exists(target):
            return []
        listed: dict[int, list] = {}
        for r in spark.read.parquet(self.rejected_path).collect():  # a batch's files at most, per batch
            listed.setdefault(r["batch_id"], []).append((r["path"], r["header"], r["reason"]))
        paths = sorted({row[0] for rows in listed.values() for row in rows})
        headers = SplitCsv.open(spark, paths).headers().collect() if paths else []
        mended = sorted(r["file"] for r in headers if self.id_col in _names(r["header"]))
        if not mended:
            return []
        number = min([0, *(m["batch"] for m in self.manifests(spark, pending=True))]) - 1
        self._land(spark, mended, number)
        self._show(spark, row_floor)
        for batch_id, rows in listed.items():
            left = [row for row in rows if row[0] not in mended]
            if len(left) < len(rows):
                fs.delete(hadoop_path(spark, f"{self.rejected_path}/batch_id={batch_id}")[0], True)
                self._set_aside(spark, left, batch_id)
        return mended

    # ------------------------------------------------------------- reading
    def manifests(self, spark: SparkSession, pending: bool = False) -> list[dict]:
        """Manifests of the visible batches (of all with ``pending``), by batch number: one row per batch."""
        target, fs = hadoop_path(spark, self.manifest_path)
        if not fs.exists(target) or not any(f.getPath().getName().startswith("batch_id=") for f in fs.listStatus(target)):
            return []
        found = spark.read.schema(MANIFEST).json(f"{self.manifest_path}/batch_id=*").collect()
        through = current(spark, self.manifest_path)
        rows = sorted((r.asDict() for r in found), key=lambda r: r["batch"])
        if pending or through is None:  # a batch written on its own, without a run
            return rows
        shown = through.removeprefix("through=")
        return [r for r in rows if shown != "none" and r["batch"] <= int(shown)]

    def _show(self, spark: SparkSession, row_floor: int | None) -> int:
        """Make all stored batches visible, if their rows are above the floor."""
        stored = self.manifests(spark, pending=True)
        total = sum(m["row_count"] for m in stored)
        if row_floor is not None:
            check_row_floor(total, row_floor, self.bronze_path)
        if stored and current(spark, self.manifest_path) != f"through={stored[-1]['batch']}":
            point_to(spark, self.manifest_path, f"through={stored[-1]['batch']}")
            forget_old(spark, self.manifest_path)
        return total

    def bronze_schema(self, spark: SparkSession) -> StructType:
        """Columns of all visible batches, in order of appearance, and the batch number."""
        names = list(dict.fromkeys(c for m in self.manifests(spark) for c in m["columns"]))
        plain = [c for c in names if c not in (INGESTED_AT, SOURCE_FILE)]
        return StructType([
            *(StructField(c, StringType()) for c in plain),
            StructField(INGESTED_AT, TimestampType()),
            StructField(SOURCE_FILE, StringType()),
            StructField("batch_id", LongType()),
        ])

    def read_bronze(self, spark: SparkSession) -> DataFrame:
        """The visible batches; a column that a batch lacks is null in its rows."""
        folders = [self._folder(m["batch"]) for m in self.manifests(spark) if m["columns"]]
        schema = self.bronze_schema(spark)
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", self.bronze_path).parquet(*folders)
