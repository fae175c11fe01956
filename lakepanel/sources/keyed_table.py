"""A table with one row per key, kept current batch by batch.

Rows lie in ``buckets`` folders by a hash of their key.  A batch reads and
rewrites only the buckets its keys fall into; the others stay where earlier
versions put them.  A version is a manifest, bucket -> folder, and becomes
current by one atomic marker (``versions``), so a merge that dies anywhere leaves
the version before.

The survivor of a key is the first under a total order of all columns, so
merging batch after batch gives the rows of one rebuild over all batches, in
whatever order they come, and a batch merged twice changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.dedup import latest_per_key_of_stored, lost_places, without_places
from ..operators.union import union_by_name
from ..session import conf
from .versions import current, forget_old, hadoop_path, markers, point_to

BUCKET = "__bucket"
MANIFEST = "bucket int, version string"
# A task keeps a file of each bucket open instead of sorting its rows by bucket, up to this many.
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
MOST_OPEN_WRITERS = 16


def _same_columns(a: StructType, b: StructType) -> bool:
    return {(f.name, f.dataType.simpleString()) for f in a} == {(f.name, f.dataType.simpleString()) for f in b}


@dataclass
class KeyedTable:
    """``keys`` and ``order_by`` as in ``latest_per_key``; ``buckets`` is fixed for the table's life.

    Size buckets to a few hundred megabytes: a merge costs the touched buckets.
    """

    spark: SparkSession
    folder: str
    keys: Sequence[str]
    order_by: Sequence[str] = ()
    buckets: int = 64

    # ------------------------------------------------------------- versions
    def _path(self, *parts: str) -> str:
        return "/".join([self.folder.rstrip("/"), *parts])

    def mapping(self, version: str | None = None) -> dict[int, str]:
        """Bucket -> version that wrote it, of the current or a given version; one entry per bucket at most."""
        version = version or current(self.spark, self.folder)
        if version is None:
            return {}
        rows = self.spark.read.schema(MANIFEST).json(self._path("manifest", version)).collect()
        return {r["bucket"]: r["version"] for r in rows}

    def schema(self) -> StructType | None:
        """Columns of the current version."""
        version = current(self.spark, self.folder)
        if version is None:
            return None
        text = self.spark.read.text(self._path("schema", version), wholetext=True).first()[0]
        return StructType.fromJson(json.loads(text))

    def paths(self, kind: str = "data", buckets: Sequence[int] | None = None) -> list[str]:
        """Folders of the current version's buckets."""
        held = self.mapping()
        return [self._path(kind, v, f"{BUCKET}={b}") for b, v in sorted(held.items()) if buckets is None or b in buckets]

    def _read(self, paths: list[str], schema: StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self) -> DataFrame:
        """The current rows, one per key."""
        schema = self.schema()
        if schema is None:
            raise FileNotFoundError(f"{self.folder} has no published version")
        return self._read(self.paths(), schema)

    # ------------------------------------------------------------- merging
    def with_bucket(self, df: DataFrame) -> DataFrame:
        cells = [F.col(f"`{k}`") for k in self.keys]
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*cells), F.lit(self.buckets)).cast("int"))

    def _buckets(self, rows: DataFrame) -> list[int]:
        return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())

    def merge(self, batch: DataFrame, also: Callable[[DataFrame, str], object] | None = None, unique: bool = False) -> list[int]:
        """Merge a stored batch (it is read up to five times); the buckets that are rewritten.

        Rows with a null key take no part.  ``also(rows, version)`` runs before
        the switch, with the rewritten buckets' new rows and their bucket.
        ``unique`` says that the batch has one row per key: no whole row is then
        shuffled.  Keys and places tell which rows of both sides go, and a bucket
        none of whose rows comes from the batch stays as it is.  Any other batch
        takes ``latest_per_key_of_stored`` with the buckets its keys fall into.
        """
        fresh = self.with_bucket(batch.dropna(subset=list(self.keys)))
        touched = self._buckets(fresh)
        version = f"v_{uuid.uuid4().hex[:12]}"
        held, known = self.mapping(), self.schema()
        rows = fresh
        if known is not None:
            old = self._read(self.paths(buckets=touched), known)
            marks = lost_places(old, batch, self.keys, self.order_by) if unique and _same_columns(known, batch.schema) else None
            if marks is not None:
                fresh = without_places(fresh, marks)
                touched = self._buckets(fresh)
                if not touched:
                    return []
                paths = self.paths(buckets=touched)
                old = without_places(self._read(paths, known), marks) if paths else self._read([], known)
            rows = union_by_name(self.with_bucket(old), fresh)
        if not unique or (known is not None and marks is None):
            rows = latest_per_key_of_stored(rows, self.keys, self.order_by)
        written = self._path("data", version)
        with conf(self.spark, {OPEN_WRITERS: str(min(self.buckets, MOST_OPEN_WRITERS))}):
            rows.write.partitionBy(BUCKET).parquet(written)
        schema = StructType([f for f in rows.schema if f.name != BUCKET])
        if also:
            also(self.spark.read.schema(StructType([*schema, rows.schema[BUCKET]])).parquet(written), version)
        held.update({b: version for b in touched})
        self.spark.createDataFrame(sorted(held.items()), MANIFEST).coalesce(1).write.json(self._path("manifest", version))
        text = self.spark.createDataFrame([(json.dumps(json.loads(schema.json())),)], "value string")
        text.coalesce(1).write.text(self._path("schema", version))
        point_to(self.spark, self.folder, version)
        self._forget()
        return touched

    def _forget(self) -> None:
        """Remove the bucket folders that neither of the last two versions uses."""
        names = [name for _, name in markers(self.spark, self.folder)]
        kept = {(b, v) for name in names[-2:] for b, v in self.mapping(name).items()}
        gone = {(b, v) for name in names[:-2] for b, v in self.mapping(name).items()} - kept
        _, fs = hadoop_path(self.spark, self.folder)
        target = hadoop_path(self.spark, self.folder)[0]
        kinds = [f.getPath().getName() for f in fs.listStatus(target) if f.isDirectory()]
        for kind in kinds:
            if kind in ("manifest", "schema") or kind.startswith("_"):
                continue
            for b, v in gone:
                fs.delete(hadoop_path(self.spark, self._path(kind, v, f"{BUCKET}={b}"))[0], True)
        for name in forget_old(self.spark, self.folder):
            for kind in ("manifest", "schema"):
                fs.delete(hadoop_path(self.spark, self._path(kind, name))[0], True)
