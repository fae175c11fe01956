"""Append-only log of rule outcomes: per batch and rule, rows checked and rows failed.

Every batch has its own folder, written under the batch's name, so a replayed
batch overwrites its rows and is counted once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

RULE_LOG = "rule string, kind string, failed bigint, total bigint"


def write_rule_log(
    spark: SparkSession, folder: str, batch: str, counts: Mapping[str, int], hard: Mapping[str, str], soft: Mapping[str, str]
) -> None:
    """Log one batch from observed counts (``observe_rules``): ``rows`` and ``failed_<rule>``."""
    rules = [(n, "hard") for n in hard] + [(n, "soft") for n in soft]
    rows = [(n, kind, counts[f"failed_{n}"], counts["rows"]) for n, kind in rules]
    spark.createDataFrame(rows, RULE_LOG).coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch={batch}")


def read_rule_log(spark: SparkSession, folder: str) -> DataFrame:
    """``batch, rule, kind, failed, total`` of every logged batch."""
    logged = spark.read.schema(f"{RULE_LOG}, batch string").option("basePath", folder).parquet(folder)
    return logged.select("batch", "rule", "kind", "failed", "total")
