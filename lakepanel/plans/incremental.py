"""Silver and marts kept current batch by batch, with a durable account of every batch.

One ``IncrementalLayer`` per source holds, below one folder:

* ``table``: the candidates, one row per key (``KeyedTable``): a batch rewrites
  only the buckets its keys fall into;
* ``table/<mart>``: every mart's partial sums and counts per bucket and grain.
  A touched bucket's partials are computed anew from its new rows and switch
  together with them, so a row that replaces another is taken out of the sums
  it was in.  Readers add up the partials of all buckets and finish them;
* ``rule_log``: per batch and rule, rows checked and rows failed;
* ``row_account``: per batch, where each bronze row went.

A batch's log and account are written under its name before its rows are
merged; a replayed batch overwrites them and merges the same rows, so it is
counted once and changes nothing.  A batch's stamps have to be those of stored
bronze: they decide which copy of a key survives.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..constants import INGESTED_AT, LOAN_HARD_RULES, LOAN_SILVER_COLUMNS, LOAN_SOFT_RULES, SOURCE_FILE
from ..functions.mergeable import Mart, partials_of_one_pass
from ..operators.columns import keep_columns
from ..operators.dedup import latest_per_key_of_stored
from ..operators.quality import apply_hard_rules, observe_rules, passes_all, rejected_rows
from ..operators.rule_log import read_rule_log, write_rule_log
from ..session import PARTIAL_PIECES, conf, work_dir
from ..sources.keyed_table import BUCKET, KeyedTable
from ..sources.versions import hadoop_path
from . import marts
from .complaints import SURVIVOR, typed_complaints
from .loans import typed_loans

ACCOUNT = "bronze_rows bigint, null_keys bigint, duplicates bigint, rejected bigint, silver_rows bigint"


@dataclass
class IncrementalLayer:
    """``typed`` turns a bronze batch into rows with the key; silver is what passes ``hard_rules``."""

    spark: SparkSession
    root: str
    key: str
    typed: Callable[[DataFrame], DataFrame]
    marts: Mapping[str, Mart]
    order_by: Sequence[str] = (f"-{INGESTED_AT}", f"-{SOURCE_FILE}")
    hard_rules: Mapping[str, str] = field(default_factory=dict)
    soft_rules: Mapping[str, str] = field(default_factory=dict)
    buckets: int = 64
    # Marts whose partials one pass over the rows yields, with its grain; each other mart takes one of its own.
    passes: Sequence[tuple[Sequence[str], Sequence[Column] | None]] = ()

    @property
    def table(self) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/table", [self.key], self.order_by, self.buckets)

    # ------------------------------------------------------------- loading
    def load(self, bronze: DataFrame, batch: str) -> dict:
        """Merge one stored bronze batch; its account (a replay gives the same)."""
        kept = Observation(f"kept_{batch}")
        typed = self.typed(bronze)
        missing = F.count_if(F.col(f"`{self.key}`").isNull())
        # Counted from the key column: the rows themselves are read for two branches.
        rows, null_keys = typed.agg(F.count(F.lit(1)), missing).first()
        candidates = latest_per_key_of_stored(typed, [self.key], self.order_by, bronze, self.typed)
        candidates, rules = observe_rules(candidates, {**self.hard_rules, **self.soft_rules}, f"rules_{batch}")
        candidates = candidates.observe(kept, F.count_if(passes_all(self.hard_rules)).alias("passed"))
        staged = f"{self.root}/batches/batch={batch}"
        candidates.write.mode("overwrite").parquet(staged)  # one write: rows and log
        if rows == null_keys:  # Spark plans nothing to observe
            counts = dict.fromkeys(["rows", *(f"failed_{n}" for n in {**self.hard_rules, **self.soft_rules})], 0)
            passed = 0
        else:
            counts, passed = rules.get, kept.get["passed"]
        account = {
            "bronze_rows": rows,
            "null_keys": null_keys,
            "duplicates": rows - null_keys - counts["rows"],
            "rejected": counts["rows"] - passed,
            "silver_rows": passed,
        }
        write_rule_log(self.spark, f"{self.root}/rule_log", batch, counts, self.hard_rules, self.soft_rules)
        row = self.spark.createDataFrame([tuple(account.values())], ACCOUNT).coalesce(1)
        row.write.mode("overwrite").parquet(f"{self.root}/row_account/batch={batch}")
        self.table.merge(self.spark.read.schema(candidates.schema).parquet(staged), also=self._partials, unique=True)
        return account

    def _partials(self, rows: DataFrame, version: str) -> None:
        """Every mart's partial rows of the touched buckets, beside the version's data."""
        silver = apply_hard_rules(rows, self.hard_rules)
        shared = {name for names, _ in self.passes for name in names}
        with conf(self.spark, PARTIAL_PIECES):
            partials = {name: mart.partial(silver, BUCKET) for name, mart in self.marts.items() if name not in shared}
            for names, grain in self.passes:
                marts_of_pass = {name: self.marts[name] for name in names}
                partials.update(partials_of_one_pass(marts_of_pass, silver, [BUCKET], grain, self._stored))
            for name, partial in partials.items():
                partial.write.partitionBy(BUCKET).parquet(f"{self.root}/table/{name}/{version}")

    def _stored(self, rows: DataFrame) -> DataFrame:
        path = work_dir(self.spark, "common_partials")
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    # ------------------------------------------------------------- reading
    def candidates(self) -> DataFrame:
        return self.table.read()

    def silver(self) -> DataFrame:
        return apply_hard_rules(self.table.read(), self.hard_rules)

    def quarantine(self) -> DataFrame:
        return rejected_rows(self.table.read(), self.hard_rules)

    def mart(self, name: str, ordered: bool = False) -> DataFrame:
        """A mart of the current rows, from the stored partials of all buckets."""
        table = self.table
        schema = self.marts[name].partial(apply_hard_rules(table.read(), self.hard_rules)).schema
        # A bucket none of whose rows counts has no folder of partials.
        there = set().union(*(self._folders(f"{self.root}/table/{name}/{v}") for v in set(table.mapping().values())))
        paths = [p for p in table.paths(name) if p.removeprefix(f"{self.root}/table/{name}/") in there]
        stored = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return self.marts[name].merge(stored, ordered)

    def _folders(self, path: str) -> set[str]:
        """``<version>/<bucket folder>`` below one version's partials: one listing per version."""
        target, fs = hadoop_path(self.spark, path)
        version = path.rsplit("/", 1)[1]
        return {f"{version}/{f.getPath().getName()}" for f in fs.listStatus(target)} if fs.exists(target) else set()

    def rule_log(self) -> DataFrame:
        """``batch, rule, kind, failed, total`` of every batch loaded so far."""
        return read_rule_log(self.spark, f"{self.root}/rule_log")

    def row_account(self) -> DataFrame:
        """Per batch: bronze rows, what became of them, and whether that adds up.

        ``silver_rows`` and ``rejected`` are counted behind the rules, the
        others before; ``balanced`` compares the batch's stored rows with them.
        """
        stored = self.spark.read.option("basePath", f"{self.root}/batches").parquet(f"{self.root}/batches")
        held = stored.groupBy(F.col("batch").cast("string").alias("batch")).agg(
            F.count_if(passes_all(self.hard_rules)).alias("passing"), F.count_if(~passes_all(self.hard_rules)).alias("failing")
        )
        folder = f"{self.root}/row_account"
        account = self.spark.read.schema(f"{ACCOUNT}, batch string").option("basePath", folder).parquet(folder)
        account = account.join(held, "batch", "left")
        total = F.col("null_keys") + F.col("duplicates") + F.col("failing") + F.col("passing")
        balanced = (F.col("bronze_rows") == total) & (F.col("failing") == F.col("rejected")) & (F.col("passing") == F.col("silver_rows"))
        names = [c.split(" ")[0] for c in ACCOUNT.split(", ")]
        return account.select("batch", *names, F.coalesce(balanced, F.col("bronze_rows") == F.col("null_keys")).alias("balanced"))


def incremental_loans(spark: SparkSession, root: str, buckets: int = 64) -> IncrementalLayer:
    return IncrementalLayer(
        spark, root, "loan_id", lambda bronze: keep_columns(typed_loans(bronze), LOAN_SILVER_COLUMNS), marts.loan_marts(),
        hard_rules=dict(LOAN_HARD_RULES), soft_rules=dict(LOAN_SOFT_RULES), buckets=buckets, passes=marts.loan_passes(),
    )


def incremental_complaints(spark: SparkSession, root: str, buckets: int = 64) -> IncrementalLayer:
    return IncrementalLayer(
        spark, root, "complaint_id", lambda bronze: typed_complaints(bronze)[0], marts.complaint_marts(),
        order_by=SURVIVOR, buckets=buckets,
    )
