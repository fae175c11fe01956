"""Layered build over landed source files (bronze -> silver -> gold).

This is the path for real inputs: folders of quoted multi-line CSV for
loans and complaints, plus an optional folder of monthly complaint history
files.  Each layer is written once (Parquet below ``root``, or catalog
tables when ``database`` is given) and the next layer reads the stored
copy, so every product is a pruned scan of its input layer.

* bronze: all-text columns, numeric-id filter (loans), ingest stamps; a row
  floor guards against a broken multi-line parse.  Quoted files are read by many
  tasks each (``sources.split_csv``; ``split_files=False`` takes Spark's own
  reader, one task per file); bronze is rebalanced on write.
* silver: typed and de-duplicated candidates are stored once, partitioned by
  their hard-rule verdict, with hard and soft rule failures counted by an
  ``Observation`` on that write (no extra pass).  Silver is the ``pass``
  partition and the quarantine the ``fail`` one (with each rule's result):
  views in a catalog, pruned reads of the Parquet folder otherwise.
* gold: eight loan marts, the two state x month segments, the panel, its
  state roll-up and the correlations.
"""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..constants import LOAN_HARD_RULES, LOAN_SOFT_RULES, PANEL_MIN_RESOLVED
from ..operators.quality import check_row_floor, observe_rules, passes_all, rejected_rows
from ..operators.rule_log import read_rule_log, write_rule_log
from ..operators.union import union_by_name
from ..operators.columns import stamp_ingest
from ..sources import files
from ..sources.sinks import save_comment, save_table, save_view
from ..sources.split_csv import bronze_split_csv
from ..sources.versions import is_versioned, read_version, write_version
from ..streaming.ingest import EvolvingCsvIngest
from . import marts, panel
from .complaints import silver_complaints
from .loans import deduped_loans


# Catalog comment of every table the builder writes (the layer goes into the
# ``quality`` table property).
TABLE_COMMENTS = {
    "bronze_loans": "Raw loan applications as landed text, footer rows removed, with ingest stamps",
    "bronze_complaints": "Raw consumer complaints as landed text (bulk and monthly history), with ingest stamps",
    "silver_loan_candidates": "Typed, de-duplicated loans before the hard rules",
    "silver_loans": "Typed, cleaned, de-duplicated loans",
    "silver_loans_rejected": "De-duplicated loans dropped by a hard rule, with each rule's result",
    "silver_complaints": "Typed, classified, de-duplicated complaints",
    "gold_portfolio_kpis": "Portfolio headline numbers (one row)",
    "gold_risk_by_grade": "Volume, pricing, default and loss by loan grade",
    "gold_vintage": "Volume, pricing and default rate by issue year",
    "gold_origination_trend": "Monthly origination volume and pricing",
    "gold_geo_risk": "Volume, pricing and default rate by state",
    "gold_purpose_risk": "Volume, pricing and default rate by loan purpose",
    "gold_fico_band_risk": "Default rate and pricing by credit-score band",
    "gold_dti_band_risk": "Default rate by debt-to-income band",
    "gold_loan_segments": "Loans, defaults and resolved loans per state and issue month",
    "gold_complaint_segments": "Lending-related complaints per state and month",
    "gold_state_month_panel": "Loan default rate vs complaint pressure per state and month",
    "gold_state_rollup": "Default rate and complaint pressure per state (ratio of summed counts)",
    "gold_panel_correlation": "Pearson r of complaint pressure vs default rate, by cell and by state",
}


# The loan candidates are stored once, partitioned by their hard-rule verdict;
# silver and its quarantine are that table's two partitions (catalog views in
# database mode), so silver is never written a second time.
RULES_PARTITION = "hard_rules"
VERDICT_OF = {"silver_loans": "pass", "silver_loans_rejected": "fail"}


@dataclass
class Lakehouse:
    spark: SparkSession
    root: str                       # folder for Parquet layers
    database: str | None = None     # write catalog tables instead, e.g. "risk"
    report: dict = field(default_factory=dict)
    hard_rules: Mapping[str, str] = field(default_factory=lambda: dict(LOAN_HARD_RULES))
    split_files: bool = True        # read a quoted CSV file by many tasks

    # ------------------------------------------------------------- storage
    def _write(self, df: DataFrame, name: str, layer: str, comment: str | None = None,
               partition_by: list[str] | None = None, check=None) -> None:
        if self.database:
            comment = comment or TABLE_COMMENTS.get(name)
            save_table(df, f"{self.database}.{name}", comment=comment, quality=layer, partition_by=partition_by,
                       check=check)
        else:
            write_version(df, self._folder(name, layer), partition_by=partition_by, check=check)

    def _folder(self, name: str, layer: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def read(self, name: str, layer: str) -> DataFrame:
        if name in VERDICT_OF and not self.database:
            return self._verdict(VERDICT_OF[name])
        if self.database:
            return self.spark.table(f"{self.database}.{name}")
        folder = self._folder(name, layer)
        if layer == "bronze" and not is_versioned(self.spark, folder):
            return self._ingest(name).read_bronze(self.spark)  # landed incrementally, by manifests
        return read_version(self.spark, folder)

    def _verdict(self, verdict: str) -> DataFrame:
        """One verdict partition of the stored candidates (read by partition pruning)."""
        part = self.read("silver_loan_candidates", "silver").where(F.col(RULES_PARTITION) == verdict)
        part = part.drop(RULES_PARTITION)
        return part if verdict == "pass" else rejected_rows(part, self.hard_rules)

    def _verdict_views(self) -> None:
        """Catalog views for silver and the quarantine over the partitioned candidates."""
        cands = f"{self.database}.silver_loan_candidates"
        cols = ", ".join(f"`{c}`" for c in self.spark.table(cands).columns if c != RULES_PARTITION)
        flags = ", ".join(f"coalesce(({rule}), false) AS `pass_{n}`" for n, rule in self.hard_rules.items())
        queries = {
            "silver_loans": f"SELECT {cols} FROM {cands} WHERE {RULES_PARTITION} = 'pass'",
            "silver_loans_rejected": f"SELECT {cols}, {flags} FROM {cands} WHERE {RULES_PARTITION} = 'fail'",
        }
        for name, query in queries.items():
            save_view(self.spark, f"{self.database}.{name}", query, TABLE_COMMENTS.get(name), "silver")

    def _bronze(self, df: DataFrame, name: str, row_floor: int | None) -> None:
        obs = Observation(f"{name}_rows")
        # Too small a load is refused before it replaces the stored one.
        self._write(df.observe(obs, F.count(F.lit(1)).alias("rows")).hint("rebalance"), name, "bronze",
                    check=lambda: self._check_rows(name, obs.get["rows"], row_floor))

    def _check_rows(self, name: str, rows: int, row_floor: int | None) -> None:
        self.report[f"{name}_rows"] = rows
        if row_floor is not None:
            check_row_floor(rows, row_floor, name)

    def _ingest(self, name: str, csv_glob: str = "", id_col: str | None = None) -> EvolvingCsvIngest:
        base = f"{self.root.rstrip('/')}/bronze"
        return EvolvingCsvIngest(csv_glob, f"{base}/{name}", f"{base}/_checkpoints/{name}", id_col=id_col)

    def _bronze_stream(self, csv_glob: str, name: str, row_floor: int | None, id_col: str | None) -> None:
        """Land only files not seen before (schema may grow); a rerun adds nothing.

        Stored rows come from the batches' manifests; a load below the floor is
        refused before it shows.  With a database, bronze is an external table
        whose partitions are the visible batches.
        """
        ingest = self._ingest(name, csv_glob, id_col)
        self.report[f"{name}_rows"] = ingest.run(self.spark, row_floor)
        if self.database:
            self._batches_to_catalog(ingest, f"{self.database}.{name}")

    def _batches_to_catalog(self, ingest: EvolvingCsvIngest, table: str) -> None:
        """Add the visible batches' new columns and partitions to the external bronze table."""
        schema = ingest.bronze_schema(self.spark)
        ddl = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != "batch_id"]
        if not self.spark.catalog.tableExists(table):
            self.spark.sql(f"CREATE TABLE {table} ({', '.join(ddl)}, batch_id BIGINT) USING parquet "
                           f"PARTITIONED BY (batch_id) LOCATION '{ingest.bronze_path}'")
            save_comment(self.spark, table, TABLE_COMMENTS.get(table.rpartition(".")[2]), "bronze")
        known = set(self.spark.table(table).columns)
        added = [d for d, f in zip(ddl, schema) if f.name not in known]
        if added:
            self.spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(added)})")
        shown = {r[0] for r in self.spark.sql(f"SHOW PARTITIONS {table}").collect()}
        new = [m["batch"] for m in ingest.manifests(self.spark) if m["columns"] and f"batch_id={m['batch']}" not in shown]
        if new:
            parts = " ".join(f"PARTITION (batch_id={b})" for b in new)
            self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")

    def _read_csv(self, csv_glob: str, id_col: str | None = None) -> DataFrame:
        read = bronze_split_csv if self.split_files else files.bronze_csv
        return read(self.spark, csv_glob, id_col=id_col)

    # ------------------------------------------------------------- loans
    def build_loans(
        self,
        csv_glob: str,
        row_floor: int | None = None,
        hard_rules: Mapping[str, str] = LOAN_HARD_RULES,
        soft_rules: Mapping[str, str] = LOAN_SOFT_RULES,
        incremental: bool = False,
        batch: str | None = None,
    ) -> None:
        """Loans bronze -> candidates -> silver (+ quarantine) -> eight marts.

        ``incremental`` lands bronze through the file stream: each run takes
        only files it has not seen, and a header that gains a column adds it
        (null for earlier rows).  Silver and gold are then recomputed in full
        from the stored bronze, as materialised views are.  Rule outcomes are
        logged under ``batch`` (by default a new name) before silver switches;
        a load repeated under its name is counted once.
        """
        if incremental:
            self._bronze_stream(csv_glob, "bronze_loans", row_floor, id_col="id")
        else:
            self._bronze(self._read_csv(csv_glob, id_col="id"), "bronze_loans", row_floor)
        candidates = deduped_loans(self.read("bronze_loans", "bronze"))
        observed, obs = observe_rules(candidates, {**hard_rules, **soft_rules}, "loan_rules")
        # One write: every candidate lands in exactly one verdict partition.
        verdict = F.when(passes_all(hard_rules), F.lit("pass")).otherwise(F.lit("fail"))
        name = batch or f"load_{time.time_ns()}"
        log = lambda: write_rule_log(self.spark, self._folder("rule_log", "quality"), name, obs.get, hard_rules, soft_rules)
        self._write(observed.withColumn(RULES_PARTITION, verdict), "silver_loan_candidates", "silver",
                    partition_by=[RULES_PARTITION], check=log)
        self.report["loan_rules"] = obs.get
        self.hard_rules = dict(hard_rules)
        if self.database:
            self._verdict_views()
        silver = self.read("silver_loans", "silver")
        for name, build in marts.MARTS.items():
            # Stored unordered; readers sort (row order is not a table property).
            self._write(build(silver, ordered=False), name, "gold")

    def rule_log(self) -> DataFrame:
        """``batch, rule, kind, failed, total`` of every load so far."""
        return read_rule_log(self.spark, self._folder("rule_log", "quality"))

    # ------------------------------------------------------------- complaints
    def build_complaints(
        self, csv_glob: str, history_glob: str | None = None, row_floor: int | None = None
    ) -> None:
        bulk = self._read_csv(csv_glob)
        if history_glob:
            history = stamp_ingest(files.read_month_files(self.spark, history_glob))
            bulk = union_by_name(bulk, history)
        self._bronze(bulk, "bronze_complaints", row_floor)
        self._write(silver_complaints(self.read("bronze_complaints", "bronze")), "silver_complaints", "silver")

    # ------------------------------------------------------------- panel
    def build_panel(self, min_resolved: int = PANEL_MIN_RESOLVED) -> None:
        self._write(panel.loan_segments(self.read("silver_loans", "silver")), "gold_loan_segments", "gold")
        self._write(panel.complaint_segments(self.read("silver_complaints", "silver")),
                    "gold_complaint_segments", "gold")
        cells = panel.state_month_panel(
            self.read("gold_loan_segments", "gold"), self.read("gold_complaint_segments", "gold"), min_resolved
        )
        self._write(cells, "gold_state_month_panel", "gold")
        stored = self.read("gold_state_month_panel", "gold")
        # Stored unordered: row order is not a property of a table, readers sort.
        self._write(panel.state_totals(stored), "gold_state_rollup", "gold")
        self._write(panel.panel_correlation(stored, self.read("gold_state_rollup", "gold")),
                    "gold_panel_correlation", "gold")
