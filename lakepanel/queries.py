"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per product.

Every query reads the driver tables (or silver that Spark derived from them
and stored) in full; none uses a row cap or an id subset.  Column names and
types match the SQL in ``oracle.py`` one for one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .constants import (
    COMPLAINT_RENAMES,
    INGESTED_AT,
    LENDING_FAMILIES,
    LOAN_HARD_RULES,
    LOAN_SILVER_COLUMNS,
    LOAN_SOFT_RULES,
    SOURCE_FILE,
)
from .functions import derive, parse
from .operators import aggregate, calendar, columns, dedup, profile, quality, quantiles, union
from .settings import (
    BACKFILL_FIRST,
    FIRST_ARRIVAL_LANG,
    HISTORY_RENAMES,
    HISTORY_SPLIT,
    MOMENT_COLUMNS,
    MONTH_MIN_ROWS,
    ORDERS_SPLIT,
    QUERY_MIN_RESOLVED,
    RELAND_MONTH,
    ROW_FLOOR,
    SUMMARY_COLUMNS,
    SUPPORT_THRESHOLDS,
    TAXONOMY_CUTOFF,
)
from .streaming.ingest import EvolvingCsvIngest
from .plans import driver_views, marts, medallion, panel
from .plans.backfill import MonthBackfill
from .plans.complaints import DERIVED
from .plans.incremental import IncrementalLayer, incremental_complaints, incremental_loans
from .plans.loans import silver_loans as rebuild_loans
from .session import conf
from .sources import files, keyed_table, sinks, split_csv, tables

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- panel G9-G13
def segment_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.loan_segments(medallion.loans_silver(spark, sf_dir))


def segment_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.complaint_segments(medallion.complaints_silver(spark, sf_dir))


def panel_state_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: loan default rate vs complaint pressure per state x month."""
    return panel.state_month_panel(
        segment_loans(spark, sf_dir), segment_complaints(spark, sf_dir), QUERY_MIN_RESOLVED
    )


def panel_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.state_rollup(panel_state_month(spark, sf_dir))


def panel_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = panel_state_month(spark, sf_dir)
    # The correlation is order-free: the unordered totals avoid a range shuffle.
    return panel.panel_correlation(cells, panel.state_totals(cells))


# ---------------------------------------------------------------- silver
def silver_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = [c for c in LOAN_SILVER_COLUMNS if c != INGESTED_AT]
    return medallion.loans_silver(spark, sf_dir).select(*cols)


def silver_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = [*COMPLAINT_RENAMES.values(), *DERIVED]
    return medallion.complaints_silver(spark, sf_dir).select(*cols)


# ---------------------------------------------------------------- scalar families X1-X21, Q1
# Each is a pruned projection (or a small aggregate) of stored silver, so one
# family of parsers or derived fields can be checked on its own.
_NUMBER_COLUMNS = [
    "loan_id", "loan_amnt", "funded_amnt", "int_rate", "revol_util", "term_months",
    "emp_length_years", "fico_low", "fico_high", "fico_avg", "open_acc", "mort_acc",
]


def clean_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubles, percents, digit runs, employment years, decimal-text counters."""
    return medallion.loans_silver(spark, sf_dir).select(*_NUMBER_COLUMNS)


def clean_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-name dates with their year, month start and ``yyyy-MM`` key."""
    sl = medallion.loans_silver(spark, sf_dir)
    return sl.select(
        "loan_id", "issue_date", "earliest_cr_date",
        F.year("issue_date").alias("issue_year"),
        derive.month_start("issue_date").alias("issue_month_start"),
        derive.month_key("issue_date").alias("issue_month"),
    )


def credit_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.loans_silver(spark, sf_dir).select(
        "loan_id", "issue_date", "earliest_cr_date", "credit_age_years"
    )


def income_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.loans_silver(spark, sf_dir).select(
        "loan_id", "installment", "annual_inc", "installment_to_income"
    )


def status_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct status text with the flags it maps to."""
    sl = medallion.loans_silver(spark, sf_dir)
    return aggregate.frequency(sl, ["loan_status", "is_resolved", "is_default"], "loans")


def loss_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.loans_silver(spark, sf_dir).select(
        "loan_id", "loan_status", "funded_amnt", "total_pymnt", "total_rec_prncp", "recoveries",
        "net_cash", "charge_off_loss",
    )


def text_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.complaints_silver(spark, sf_dir).select("complaint_id", "timely_response", "has_narrative")


def classify_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct raw product with the family the ordered classifier gives it."""
    sc = medallion.complaints_silver(spark, sf_dir)
    return aggregate.frequency(sc, ["product", "product_family"], "complaints")


def rules_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """De-duplicated loans the hard rules drop, with the rule results (null = fail)."""
    # Only the quarantine partition is read; rejected_rows re-derives each rule.
    quarantine = medallion.loan_quarantine(spark, sf_dir)
    flags = [f"pass_{n}" for n in LOAN_HARD_RULES]
    return quality.rejected_rows(quarantine, LOAN_HARD_RULES).select(
        "loan_id", "loan_amnt", "grade", "loan_status", *flags
    )


# ---------------------------------------------------------------- marts G1-G8
def _mart(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(medallion.loans_silver(spark, sf_dir))

    run.__name__ = fn.__name__
    return run


QUERIES: dict[str, Query] = {
    "panel_state_month": panel_state_month,
    "segment_loans": segment_loans,
    "segment_complaints": segment_complaints,
    "panel_rollup": panel_rollup,
    "panel_corr": panel_corr,
    "silver_loans": silver_loans,
    "silver_complaints": silver_complaints,
    "mart_kpis": _mart(marts.portfolio_kpis),
    "mart_grade": _mart(marts.risk_by_grade),
    "mart_vintage": _mart(marts.vintage),
    "mart_trend": _mart(marts.origination_trend),
    "mart_geo": _mart(marts.geo_risk),
    "mart_purpose": _mart(marts.purpose_risk),
    "mart_score_band": _mart(marts.fico_band_risk),
    "mart_ratio_band": _mart(marts.dti_band_risk),
    "clean_numbers": clean_numbers,
    "clean_dates": clean_dates,
    "credit_age": credit_age,
    "income_ratio": income_ratio,
    "status_flags": status_flags,
    "loss_fields": loss_fields,
    "text_flags": text_flags,
    "classify_family": classify_family,
    "rules_drop": rules_drop,
}


def queries() -> dict[str, Query]:
    """Every registered query (the registry is filled in below, by section)."""
    return dict(QUERIES)


# ---------------------------------------------------------------- quality Q1-Q5
def rules_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard and soft rule failures over de-duplicated loans (null = fail)."""
    deduped = medallion.loan_candidates(spark, sf_dir)
    return quality.rule_report(deduped, LOAN_HARD_RULES, LOAN_SOFT_RULES)


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze vs silver complaints: rows, unreadable ids, missing months, date range."""
    bronze = medallion.complaints_bronze(spark, sf_dir)
    typed = bronze.select(
        parse.to_long("`Complaint ID`").alias("complaint_id"),
        parse.text_date("`Date received`").alias("date_received"),
    )
    silver = medallion.complaints_silver(spark, sf_dir)

    def stats(df: DataFrame, layer: str) -> DataFrame:
        return df.agg(
            F.lit(layer).alias("layer"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(F.col("complaint_id").isNull()).alias("null_ids"),
            F.count_if(F.col("date_received").isNull()).alias("null_dates"),
            F.min("date_received").alias("min_date_received"),
            F.max("date_received").alias("max_date_received"),
        )

    return stats(typed, "bronze").unionByName(stats(silver, "silver"))


def reconcile_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans, complaints and their segments: rows, narratives, null months, cells total and kept, month range."""
    loans, complaints = medallion.loans_silver(spark, sf_dir), medallion.complaints_silver(spark, sf_dir)

    def stats(df: DataFrame, what: str, month: str, special) -> DataFrame:
        return df.agg(
            F.lit(what).alias("what"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(special).alias("selected"),
            F.count_if(F.col(month).isNull()).alias("null_months"),
            F.min(month).alias("first_month"),
            F.max(month).alias("last_month"),
        )

    parts = [
        stats(complaints, "complaints_with_narrative", "year_month", F.col("has_narrative")),
        stats(loans.withColumn("m", derive.month_key("issue_date")), "resolved_loans", "m", F.col("is_resolved") == 1),
        stats(panel.loan_segments(loans), "loan_cells_kept", "issue_month", F.col("resolved_loans") >= QUERY_MIN_RESOLVED),
        stats(panel.complaint_segments(complaints), "complaint_cells", "issue_month", F.col("complaints") > 0),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def year_counts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complaints per year: bronze, all families, lending families."""
    bronze = medallion.complaints_bronze(spark, sf_dir)
    typed = bronze.select(derive.month_key(parse.text_date("`Date received`")).alias("year_month"))
    silver = medallion.complaints_silver(spark, sf_dir)
    lending = silver.where(F.col("product_family").isin(LENDING_FAMILIES))
    out = None
    for layer, df in (("bronze", typed), ("silver", silver), ("lending", lending)):
        part = df.groupBy(F.lit(layer).alias("layer"), derive.year_of_key("year_month").alias("yr")).agg(
            F.count(F.lit(1)).alias("complaints")
        )
        out = part if out is None else out.unionByName(part)
    return out


def table_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns, types and row counts of documents and labels, as a schema listing."""
    out = None
    for name in ("documents", "labels"):
        listed = profile.schema_listing(tables.read_table(spark, sf_dir, name)).withColumn("table_name", F.lit(name))
        out = listed if out is None else out.unionByName(listed)
    return out


def row_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complaint bronze row count against a floor (a broken parse shows here)."""
    return quality.row_floor_report(medallion.complaints_bronze(spark, sf_dir), ROW_FLOOR)


def taxonomy_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw product x family counts before a cut-off month, every pair."""
    sc = medallion.complaints_silver(spark, sf_dir).where(F.col("year_month") < TAXONOMY_CUTOFF)
    return aggregate.frequency_desc(sc, ["product", "product_family"], "complaints")


# ---------------------------------------------------------------- profiles A9-A10
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null profile of documents left-joined to labels.

    Document columns are reduced to presence flags before the join, so the
    join shuffles ids and flags, never the document text.
    """
    docs = tables.read_table(spark, sf_dir, "documents")
    labels = tables.read_table(spark, sf_dir, "labels")
    flagged = [c for c in docs.columns if c != "doc_id"]
    joined = profile.presence_flags(docs, keep=["doc_id"]).join(labels, "doc_id", "left")
    return profile.null_profile(joined, flags=flagged, types=dict(docs.dtypes))


def column_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = tables.read_table(spark, sf_dir, "lineitem").select(*SUMMARY_COLUMNS)
    # Spark's summary leaves out dates and times; they are summarised as text.
    li = li.withColumn("l_shipdate", F.to_date("l_shipdate").cast("string"))
    return profile.column_summary(li, ("count", "min", "max"))


def column_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and sample standard deviation of the numeric columns, to 6 decimals."""
    li = tables.read_table(spark, sf_dir, "lineitem").select(*MOMENT_COLUMNS)
    return profile.column_moments(li, 6)


def column_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quartiles of every numeric column of lineitem, with their ranks."""
    return quantiles.exact_quantiles(tables.read_table(spark, sf_dir, "lineitem"))


# ---------------------------------------------------------------- aggregates A11-A14, T1-T3
def freq_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.frequency_desc(medallion.complaints_silver(spark, sf_dir), ["product_family"], "complaints")


def counts_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    sc = medallion.complaints_silver(spark, sf_dir).where(F.col("product_family").isin(LENDING_FAMILIES))
    out = aggregate.frequency(sc, [derive.year_of_key("year_month").alias("yr")], "complaints")
    return out.orderBy(F.col("yr").asc_nulls_first())


def min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.min_max(medallion.complaints_silver(spark, sf_dir), ["date_received", "year_month"])


def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    seg = segment_loans(spark, sf_dir)
    return aggregate.top_k(seg, 5, [F.col("resolved_loans").desc(), F.col("state"), F.col("issue_month")])


def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sl = medallion.loans_silver(spark, sf_dir).select("loan_id", "issue_date", "grade", "loan_status")
    return aggregate.head_rows(sl, 10, ["loan_id"])


# ---------------------------------------------------------------- dedup, union D1-D3, U1
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line item per (order, line number): latest ship date wins."""
    li = tables.read_table(spark, sf_dir, "lineitem")
    return dedup.latest_per_key(li, ["l_orderkey", "l_linenumber"], ["-l_shipdate"])


def history_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk extract + history backfill with overlapping windows and drifted columns.

    The history extract names its columns differently and lacks ``props``;
    it is renamed (required names checked), unioned by name, and each event
    keeps its bulk row where both windows hold it.
    """
    ev = tables.read_table(spark, sf_dir, "events")
    bulk = ev.where(F.col("ts") < F.lit(HISTORY_SPLIT[1]).cast("timestamp_ntz")).withColumn(
        SOURCE_FILE, F.lit("bulk")
    )
    # Rows without a time are in the history extract: no split may lose them.
    hist_raw = ev.where(
        F.coalesce(F.col("ts") >= F.lit(HISTORY_SPLIT[0]).cast("timestamp_ntz"), F.lit(True))
    ).select(
        *[F.col(new).alias(old) for old, new in HISTORY_RENAMES.items()]
    )
    hist = columns.rename_columns(hist_raw, HISTORY_RENAMES).withColumn(SOURCE_FILE, F.lit("history"))
    merged = union.union_by_name(bulk, hist)
    return dedup.latest_per_key(merged, ["event_id"], [SOURCE_FILE])


# ---------------------------------------------------------------- calendar D4, D5, J2
def month_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.month_spine(tables.read_table(spark, sf_dir, "orders"), "o_orderdate")


def window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    spine = calendar.month_spine(tables.read_table(spark, sf_dir, "lineitem"), "l_shipdate")
    return calendar.window_counts(spine, tables.read_table(spark, sf_dir, "orders"), "o_orderdate", "orders")


def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    spine = calendar.month_spine(tables.read_table(spark, sf_dir, "lineitem"), "l_shipdate")
    landed = tables.read_table(spark, sf_dir, "orders").select(
        derive.month_key(F.to_date("o_orderdate")).alias("month")
    )
    return calendar.coverage_gaps(spine, landed)


QUERIES.update({
    "rules_report": rules_report,
    "reconcile": reconcile,
    "row_floor": row_floor,
    "taxonomy_coverage": taxonomy_coverage,
    "null_profile": null_profile,
    "column_summary": column_summary,
    "column_moments": column_moments,
    "column_quartiles": column_quartiles,
    "reconcile_segments": reconcile_segments,
    "year_counts_all": year_counts_all,
    "table_schemas": table_schemas,
    "freq_desc": freq_desc,
    "counts_by_year": counts_by_year,
    "min_max": min_max,
    "top_k": top_k,
    "head_rows": head_rows,
    "dedup_latest": dedup_latest,
    "history_union": history_union,
    "month_spine": month_spine,
    "window_counts": window_counts,
    "coverage_gaps": coverage_gaps,
})


# ---------------------------------------------------------------- sources S1-S10, sinks K1-K5
_DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars"]
_ORDER_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate date, o_orderpriority string"
)


def landed_documents_csv(spark: SparkSession, sf_dir: str) -> str:
    """Documents written once as quoted CSV (text holds commas, quotes, newlines)."""
    def write(path: str) -> None:
        sinks.write_csv(tables.read_table(spark, sf_dir, "documents").select(*_DOC_COLS), path, max_records=5_000)

    return medallion.stored(spark, sf_dir, "landing/documents_csv", write) + "/*.csv"


def csv_multiline_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze read of multi-line quoted CSV: numeric-id filter, stamps, lineage."""
    b = files.bronze_csv(spark, landed_documents_csv(spark, sf_dir), id_col="doc_id")
    return b.select(
        parse.to_long("doc_id").alias("doc_id"), "text", "lang", "source",
        parse.to_long("n_chars").alias("n_chars"),
        F.col(SOURCE_FILE).endswith(".csv").alias("lineage_ok"),
    )


def csv_split_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bronze read with many tasks per file (quote-parity scan)."""
    b = split_csv.bronze_split_csv(spark, landed_documents_csv(spark, sf_dir), id_col="doc_id")
    return b.select(
        parse.to_long("doc_id").alias("doc_id"), "text", "lang", "source",
        parse.to_long("n_chars").alias("n_chars"),
        F.col(SOURCE_FILE).endswith(".csv").alias("lineage_ok"),
    )


def csv_plain_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files read one record per physical line: the broken parse."""
    return files.read_plain_csv(spark, landed_documents_csv(spark, sf_dir))


def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_csv_inferred(spark, landed_documents_csv(spark, sf_dir))


def line_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.line_preview(spark, landed_documents_csv(spark, sf_dir), 3)


def _orders_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = tables.read_table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority",
    )


def ndjson_month_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed as NDJSON per month, one month landed again, read back."""
    def write(path: str) -> None:
        orders = _orders_typed(spark, sf_dir)
        sinks.land_month_partitions(orders, path, "o_orderdate")
        again = orders.where(derive.month_key("o_orderdate") == RELAND_MONTH)
        sinks.land_month_partitions(again, path, "o_orderdate")

    path = medallion.stored(spark, sf_dir, "landing/orders_ndjson", write)
    return sinks.read_month_partitions(spark, path, _ORDER_SCHEMA)


def month_file_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly CSV history files + bulk extract: union by name, dedup, monthly counts."""
    def write(path: str) -> None:
        hist = _orders_typed(spark, sf_dir).where(F.col("o_orderdate") < F.lit(ORDERS_SPLIT[1]).cast("date"))
        hist = hist.drop("o_orderpriority").withColumn("ym", derive.month_key("o_orderdate"))
        sinks.write_csv(hist.hint("rebalance", "ym"), path, partition_by=["ym"])

    path = medallion.stored(spark, sf_dir, "landing/orders_month_files", write)
    raw = files.read_month_files(spark, f"{path}/*/*.csv", pattern=r"ym=(\d{4}-\d{2})")
    history = raw.select(
        parse.to_long("o_orderkey").alias("o_orderkey"),
        parse.to_long("o_custkey").alias("o_custkey"),
        "o_orderstatus",
        parse.to_double("o_totalprice").alias("o_totalprice"),
        parse.text_date("o_orderdate").alias("o_orderdate"),
        "file_month",
        F.lit("history").alias(SOURCE_FILE),
    )
    # Rows without a date are in the bulk extract: no split may lose them.
    recent = F.coalesce(F.col("o_orderdate") >= F.lit(ORDERS_SPLIT[0]).cast("date"), F.lit(True))
    bulk = _orders_typed(spark, sf_dir).where(recent)
    bulk = bulk.withColumn(SOURCE_FILE, F.lit("bulk"))
    merged = dedup.latest_per_key(union.union_by_name(bulk, history), ["o_orderkey"], [SOURCE_FILE])
    month = derive.month_key("o_orderdate")
    return merged.groupBy(month.alias("month")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.count("o_orderpriority").alias("with_priority"),
        F.count_if(F.col("file_month") == month).alias("from_files"),
    )


# ---------------------------------------------------------------- streaming S4, K3
def _ingest(spark: SparkSession, sf_dir: str, name: str, batches) -> DataFrame:
    def ingest(base: str) -> EvolvingCsvIngest:
        return EvolvingCsvIngest(f"{base}/landing/*/*.csv", f"{base}/bronze", f"{base}/_checkpoint", id_col="doc_id")

    def write(base: str) -> None:
        ing = ingest(base)
        for i, frame in enumerate(batches(), start=1):
            sinks.write_csv(frame, f"{base}/landing/batch_{i}")
            ing.run(spark)
        ing.run(spark)  # nothing new: must add no rows

    base = medallion.stored(spark, sf_dir, f"stream/{name}", write)
    return ingest(base).read_bronze(spark).select(
        parse.to_long("doc_id").alias("doc_id"), "text", "lang", "source",
        parse.to_long("n_chars").alias("n_chars"),
    )


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents landed as CSV files, ingested by the file stream, read back."""
    docs = lambda: [tables.read_table(spark, sf_dir, "documents").select(*_DOC_COLS)]
    return _ingest(spark, sf_dir, "documents", docs)


def stream_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second arrival adds columns in the middle of the header; old rows get nulls."""
    def batches():
        docs = tables.read_table(spark, sf_dir, "documents")
        first = docs.where(F.col("lang") == FIRST_ARRIVAL_LANG).select("doc_id", "text", "lang")
        later = docs.where(~F.col("lang").eqNullSafe(FIRST_ARRIVAL_LANG)).select("doc_id", "source", "text", "lang", "n_chars")
        return [first, later]

    return _ingest(spark, sf_dir, "documents_evolving", batches)


QUERIES.update({
    "csv_multiline_roundtrip": csv_multiline_roundtrip,
    "csv_split_roundtrip": csv_split_roundtrip,
    "csv_plain_fragments": csv_plain_fragments,
    "csv_inferred": csv_inferred,
    "line_preview": line_preview,
    "ndjson_month_partitions": ndjson_month_partitions,
    "month_file_history": month_file_history,
    "stream_ingest": stream_ingest,
    "stream_evolution": stream_evolution,
})


# ---------------------------------------------------------------- batches D1, D2, Q2, Q4, G1-G10
def _loan_loads(spark: SparkSession, sf_dir: str) -> list[str]:
    """Three stored loads of the loan view, in which ids come again with other values.

    1: ids whose remainder by 3 is not 2.  2: the others, and every fifth id
    again, charged off.  3: every seventh id again, even ones with amount 0;
    the ids of every thirty-fifth are unreadable.
    """
    def write(base: str) -> None:
        raw = driver_views.loans_bronze(spark, sf_dir).drop(INGESTED_AT, SOURCE_FILE)
        n, load = F.col("id").try_cast("bigint"), F.col("__load")
        taken = [(1, n % 3 != 2), (2, (n % 3 == 2) | (n % 5 == 0)), (3, n % 7 == 0)]
        loads = F.array_compact(F.array(*[F.when(cond, F.lit(k)) for k, cond in taken]))
        stamps = [F.lit(f"2024-01-0{k}").cast("timestamp") for k, _ in taken]
        changed = {
            "loan_status": F.when((load == 2) & (n % 5 == 0), "Charged Off").otherwise(F.col("loan_status")),
            "loan_amnt": F.when((load == 3) & (n % 2 == 0), "0").otherwise(F.col("loan_amnt")),
            "id": F.when((load == 3) & (n % 35 == 0), "x").otherwise(F.col("id")),
            # Stored bronze keeps its stamps: a replay must not look newer.
            INGESTED_AT: F.element_at(F.array(*stamps), load),
            SOURCE_FILE: F.concat(F.lit("load_"), load.cast("string")),
        }
        # The view is rendered once for the three loads.
        with conf(spark, {keyed_table.OPEN_WRITERS: str(len(taken))}):
            raw.select("*", F.explode(loads).alias("__load")).withColumns(changed).write.partitionBy("__load").parquet(base)

    base = medallion.stored(spark, sf_dir, "incremental/loan_loads", write)
    return [f"{base}/__load={k}" for k in (1, 2, 3)]


def loans_layer(spark: SparkSession, sf_dir: str) -> IncrementalLayer:
    """The three loads merged batch by batch; the second is replayed."""
    def write(base: str) -> None:
        loads = _loan_loads(spark, sf_dir)
        layer = incremental_loans(spark, base, buckets=8)
        for k in (1, 2, 3, 2):
            layer.load(spark.read.parquet(loads[k - 1]), f"load_{k}")

    return incremental_loans(spark, medallion.stored(spark, sf_dir, "incremental/loans", write), buckets=8)


def complaints_layer(spark: SparkSession, sf_dir: str) -> IncrementalLayer:
    """Stored complaint bronze merged as one batch."""
    def write(base: str) -> None:
        incremental_complaints(spark, base, buckets=8).load(medallion.complaints_bronze(spark, sf_dir), "all")

    return incremental_complaints(spark, medallion.stored(spark, sf_dir, "incremental/complaints", write), buckets=8)


_RELOADED = [c for c in LOAN_SILVER_COLUMNS if c != INGESTED_AT]


def loans_reloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan silver rebuilt over three loads with repeated ids."""
    loads = spark.read.parquet(*_loan_loads(spark, sf_dir))
    return rebuild_loans(loads, dedupe=dedup.latest_per_key_of_stored).select(*_RELOADED)


def loans_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan silver merged load by load: only touched buckets are rewritten."""
    return loans_layer(spark, sf_dir).silver().select(*_RELOADED)


def rule_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule outcomes of every load, a replayed one counted once."""
    return loans_layer(spark, sf_dir).rule_log()


def row_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every bronze row of both sources went, per batch."""
    loans = loans_layer(spark, sf_dir).row_account().withColumn("source", F.lit("loans"))
    return loans.unionByName(complaints_layer(spark, sf_dir).row_account().withColumn("source", F.lit("complaints")))


def _merged(layer, name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return layer(spark, sf_dir).mart(name)

    run.__name__ = f"merged_{name}"
    return run


MERGED_MARTS = {
    "mart_kpis": "gold_portfolio_kpis", "mart_grade": "gold_risk_by_grade", "mart_vintage": "gold_vintage",
    "mart_trend": "gold_origination_trend", "mart_geo": "gold_geo_risk", "mart_purpose": "gold_purpose_risk",
    "mart_score_band": "gold_fico_band_risk", "mart_ratio_band": "gold_dti_band_risk", "segment_loans": "gold_loan_segments",
}


def support_by_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State x month cells and loans kept at each support threshold, the library's 100 included."""
    cells = segment_loans(spark, sf_dir)
    levels = F.explode(F.array(*[F.lit(n) for n in SUPPORT_THRESHOLDS])).alias("min_resolved")
    kept = F.col("resolved_loans") >= F.col("min_resolved")
    return cells.select("loans", "resolved_loans", levels).groupBy("min_resolved").agg(
        F.count(F.lit(1)).alias("cells"),
        F.count_if(kept).alias("cells_kept"),
        F.coalesce(F.sum(F.when(kept, F.col("loans"))), F.lit(0)).alias("loans_kept"),
    )


def coverage_below_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of the line items' range with fewer orders than a whole month has."""
    spine = calendar.month_spine(tables.read_table(spark, sf_dir, "lineitem"), "l_shipdate")
    landed = tables.read_table(spark, sf_dir, "orders").select(derive.month_key(F.to_date("o_orderdate")).alias("month"))
    return calendar.coverage_gaps(spine, landed, min_rows=MONTH_MIN_ROWS)


def backfill_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of a month backfill of orders that took two runs."""
    def backfill(base: str) -> MonthBackfill:
        return MonthBackfill(spark, f"{base}/months", _ORDER_SCHEMA, min_rows=MONTH_MIN_ROWS, min_bytes=0, chunk_months=24)

    def write(base: str) -> None:
        orders = _orders_typed(spark, sf_dir)
        spine = calendar.month_spine(orders, "o_orderdate")
        work = backfill(base)
        work.run(orders, "o_orderdate", spine, max_months=BACKFILL_FIRST)
        work.run(orders, "o_orderdate", spine)

    base = medallion.stored(spark, sf_dir, "landing/orders_backfill", write)
    return backfill(base).ledger().select("month", "row_count", "state")


QUERIES.update({
    "loans_reloaded": loans_reloaded,
    "loans_incremental": loans_incremental,
    "rule_log": rule_log,
    "row_account": row_account,
    **{f"merged_{short}": _merged(loans_layer, name) for short, name in MERGED_MARTS.items()},
    "merged_segment_complaints": _merged(complaints_layer, "gold_complaint_segments"),
    "support_by_threshold": support_by_threshold,
    "coverage_below_floor": coverage_below_floor,
    "backfill_ledger": backfill_ledger,
})
