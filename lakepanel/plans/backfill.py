"""Month backfill that knows what it has landed: a ledger plans the gaps and a rerun resumes them.

Months are landed in chunks, one Spark job per chunk, each month its own
partition (``sinks.land_month_partitions``: landing a month replaces only it).
After a chunk, one aggregate over its landed files writes a ledger row per
month: rows, bytes and a state, ``landed`` if both are above their floors and
``short`` if not (a truncated or empty month).  A month counts as done only by
its ledger row, so a run that dies between a chunk's files and its ledger rows
lands that chunk again, and months done before are not touched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.derive import month_key
from ..sources.sinks import land_month_partitions
from ..sources.versions import hadoop_path

LEDGER = "row_count bigint, byte_count bigint, state string, dt string"
# A file of a month that holds no more than this is not a whole month.
MIN_BYTES = 10_000


@dataclass
class MonthBackfill:
    """``path``: NDJSON months; ``schema``: their columns.  A month is done above both floors."""

    spark: SparkSession
    path: str
    schema: str
    min_rows: int = 1
    min_bytes: int = MIN_BYTES
    chunk_months: int = 12

    @property
    def ledger_path(self) -> str:
        return f"{self.path.rstrip('/')}_ledger"

    def ledger(self) -> DataFrame:
        """``month, row_count, byte_count, state`` of every month landed so far."""
        target, fs = hadoop_path(self.spark, self.ledger_path)
        if not fs.exists(target):
            rows = self.spark.createDataFrame([], LEDGER)
        else:
            rows = self.spark.read.schema(LEDGER).parquet(self.ledger_path)
        return rows.select(F.col("dt").alias("month"), "row_count", "byte_count", "state")

    def gaps(self, spine: DataFrame) -> list[str]:
        """Months of the spine without a ``landed`` row, oldest first (a few hundred at most)."""
        done = self.ledger().where("state = 'landed'").select("month")
        return sorted(r["month"] for r in spine.select("month").join(done, "month", "left_anti").collect())

    def run(self, source: DataFrame, date_col: str, spine: DataFrame, max_months: int | None = None) -> list[str]:
        """Land the gaps (at most ``max_months`` of them) from ``source``; the months landed by this run."""
        wanted = self.gaps(spine)[:max_months]
        for k in range(0, len(wanted), self.chunk_months):
            months = wanted[k : k + self.chunk_months]
            month = month_key(F.to_date(F.col(date_col)))
            land_month_partitions(source.where(month.isin(months)), self.path, date_col)
            self._record(months)
        return wanted

    def _record(self, months: list[str]) -> None:
        """Ledger rows of the months, from the files that are there."""
        held = self.spark.createDataFrame([(m,) for m in months], "dt string")  # a chunk
        landed = self.spark.read.schema(f"{self.schema}, dt string").json(self.path)
        # The filter on the partition keeps the scan to the chunk's files.
        landed = landed.where(F.col("dt").isin(months))
        files = landed.groupBy("dt", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
        per_file = files.agg(F.count(F.lit(1)).alias("n"))
        counted = per_file.groupBy("dt").agg(F.sum("n").alias("row_count"), F.sum("size").alias("byte_count"))
        rows = held.join(counted, "dt", "left").select(
            "dt",
            F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
            F.coalesce("byte_count", F.lit(0)).cast("bigint").alias("byte_count"),
        )
        rows = rows.withColumn("state", F.when(self.is_whole(), "landed").otherwise("short"))
        out = rows.select("row_count", "byte_count", "state", "dt").coalesce(1)
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(self.ledger_path)

    def is_whole(self) -> Column:
        return (F.col("row_count") >= self.min_rows) & (F.col("byte_count") > self.min_bytes)
