"""Spark session settings and the shared work folder.

Everything the library writes (silver tables, landing folders of the file
round trips, stream checkpoints) goes below the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is missing (local tests)
do we pick a folder ourselves.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library relies on.  ANSI stays on (Spark 4 default): every text
# parse uses try_* forms and every division has a guarded denominator.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Partitioned writes keep up to two files open per task instead of sorting
    # each task's rows by the partition value first (a verdict has two values,
    # a rebalanced month landing mostly one); beyond that Spark sorts.
    "spark.sql.maxConcurrentOutputFileWriters": "2",
    # The JIT does not compile methods over 8,000 bytes, which the parses of ~50
    # columns in one generated method exceed; beyond it Spark uses smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# A stored text row of a few bytes becomes a typed row of several hundred, and a
# task sorts what it reads: small pieces keep its rows in memory.  A row group is
# read by one task, however large, so stored tables get small ones too.
BUILD_PIECES = {
    "spark.sql.files.maxPartitionBytes": "8m",
    # A task takes many small files, so a bucket's files do not multiply by merges.
    "spark.sql.files.openCostInBytes": "512k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "parquet.block.size": str(16 << 20),
}
# Builds write each wide row once and mostly read it whole: building a dictionary of
# every column's values takes as much CPU as rendering them.  Generated methods over
# this many columns run slower than the operators one by one; narrow steps keep them.
BUILD_FORMAT = {"parquet.enable.dictionary": "false", "spark.sql.codegen.maxFields": "30"}
# Partial sums read few columns and keep groups only: larger pieces give fewer partial rows.
PARTIAL_PIECES = {"spark.sql.files.maxPartitionBytes": "64m", "spark.sql.files.openCostInBytes": "512k"}
# Shuffles of a build begin with this many pieces at least, which Spark joins up
# to the size above: few pieces of a large table would be sorted on disk.
BUILD_SHUFFLE_PIECES = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
FEWEST_SHUFFLE_PIECES = 1000


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "lakepanel",
    extra: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Pin the SQL settings on a session the caller created."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)


@contextmanager
def small_pieces(spark: SparkSession) -> Iterator[None]:
    """Tasks read and fetch at most ``BUILD_PIECES`` while tables are built; smaller settings stay."""
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    before = {key: spark.conf.get(key, None) for key in [*BUILD_PIECES, *BUILD_FORMAT, BUILD_SHUFFLE_PIECES]}
    for key, most in BUILD_PIECES.items():
        if before[key] is None or as_bytes(before[key]) > as_bytes(most):
            spark.conf.set(key, most)
    for key, value in BUILD_FORMAT.items():
        spark.conf.set(key, value)
    pieces = int(before[BUILD_SHUFFLE_PIECES] or spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(BUILD_SHUFFLE_PIECES, str(max(pieces, FEWEST_SHUFFLE_PIECES)))
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """``settings`` hold inside the block."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when none is set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # Local runs and tests only: one machine, so any folder is shared.
        configured = tempfile.mkdtemp(prefix="lakepanel-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder below the shared checkpoint folder for one run's outputs."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    app = spark.sparkContext.applicationId
    return "/".join([base, "lakepanel", app, *parts, uuid.uuid4().hex[:12]])
