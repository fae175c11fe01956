"""Bronze-like raw text views derived from the driver's star-schema tables.

The library's inputs are two messy text sources (loans, complaints).  To run
the whole bronze -> silver -> gold chain on the driver tables, each order
becomes a loan application and each line item a complaint, rendered as text
the way the source files spell them (``"Dec-2015"``, ``"13.5%"``,
``" 36 months"``, ``"10+ years"``, ``"13.0"`` counters, blanks, and one
funding-total footer row per region file).

The derivation is one SQL template rendered for two dialects, Spark SQL and
DuckDB, so both engines see byte-identical raw text; everything after the
raw text (parsing, dedup, rules, marts, panel) is independent code on each
side.  The view keeps every row of its base table.

Loan view: orders x customer x nation x region; ``addr_state`` is the
customer's region (so state x month cells hold enough loans at small scale).
Complaint view: lineitem x supplier x nation x region; ``State`` is the
supplier's region.  Complaint ids repeat where the line item key repeats.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions.parse import is_numeric_id
from ..operators.columns import stamp_ingest
from ..sources.tables import read_table, register_tables, spread_rows


@dataclass(frozen=True)
class Dialect:
    name: str

    def q(self, ident: str) -> str:
        return f"`{ident}`" if self.name == "spark" else f'"{ident}"'

    def month_name(self, expr: str) -> str:
        if self.name == "spark":
            return f"date_format({expr}, 'MMM-yyyy')"
        return f"strftime({expr}, '%b-%Y')"

    def iso_month(self, expr: str) -> str:
        if self.name == "spark":
            return f"date_format({expr}, 'yyyy-MM')"
        return f"strftime({expr}, '%Y-%m')"

    def iso_date(self, expr: str) -> str:
        if self.name == "spark":
            return f"date_format({expr}, 'yyyy-MM-dd')"
        return f"strftime({expr}, '%Y-%m-%d')"

    def add_months(self, expr: str, months: str) -> str:
        if self.name == "spark":
            return f"add_months(CAST({expr} AS DATE), CAST({months} AS INT))"
        return f"(CAST({expr} AS DATE) + to_months(CAST({months} AS INTEGER)))"

    def timestamp_type(self) -> str:
        """Type of the driver tables' timestamps (stored without a time zone)."""
        return "TIMESTAMP_NTZ" if self.name == "spark" else "TIMESTAMP"

    def add_days(self, expr: str, days: int) -> str:
        if self.name == "spark":
            return f"date_add(CAST({expr} AS DATE), {days})"
        return f"(CAST({expr} AS DATE) + {days})"


SPARK = Dialect("spark")
DUCKDB = Dialect("duckdb")


def loans_raw_sql(d: Dialect) -> str:
    """Raw loan text, one row per order."""
    price = "CAST(o.o_totalprice AS DECIMAL(12,2))"
    funded = f"ROUND({price} * 0.98, 2)"
    bal = "CAST(c.c_acctbal AS DECIMAL(12,2))"
    return f"""
WITH base AS (
  SELECT o.o_orderkey AS k, o.o_orderstatus AS st, o.o_orderdate AS od, o.o_orderpriority AS pr,
         c.c_custkey AS ck, c.c_name AS cname, c.c_mktsegment AS seg, r.r_name AS region,
         {price} AS price, {funded} AS funded, {bal} AS bal
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
), footers AS (
  -- Every order is a loan; each region's file also ends with one
  -- funding-total footer row, which the numeric-id rule removes.  Built from
  -- the region table alone: no second pass over the orders.
  SELECT CAST(NULL AS BIGINT) AS k, CAST(NULL AS STRING) AS st,
         CAST(NULL AS {d.timestamp_type()}) AS od, CAST(NULL AS STRING) AS pr,
         CAST(NULL AS BIGINT) AS ck, CAST(NULL AS STRING) AS cname, CAST(NULL AS STRING) AS seg,
         r_name AS region, CAST(0 AS DECIMAL(12,2)) AS price,
         CAST(NULL AS DECIMAL(12,2)) AS funded, CAST(NULL AS DECIMAL(12,2)) AS bal, TRUE AS footer
  FROM region
), with_footers AS (
  SELECT *, FALSE AS footer FROM base
  UNION ALL
  SELECT * FROM footers
), graded AS (
  SELECT *,
    CASE WHEN k % 211 = 10 THEN NULL
         WHEN ck % 101 = 0 THEN 'H'
         ELSE CASE substr(pr, 1, 1) WHEN '1' THEN 'A' WHEN '2' THEN 'B' WHEN '3' THEN 'C'
                                    WHEN '4' THEN 'D' ELSE 'E' END END AS grade_txt,
    CASE st WHEN 'O' THEN ROUND(funded * 1.1, 2) WHEN 'F' THEN ROUND(funded * 0.4, 2)
            ELSE ROUND(funded * 0.3, 2) END AS paid,
    CASE st WHEN 'O' THEN funded WHEN 'F' THEN ROUND(funded * 0.3, 2)
            ELSE ROUND(funded * 0.2, 2) END AS prncp
  FROM with_footers
)
SELECT
  CASE WHEN footer THEN 'Total amount funded in policy code 1: ' || CAST(price AS STRING)
       ELSE CAST(k AS STRING) END AS id,
  CASE WHEN k % 97 = 5 THEN {d.iso_month('od')}
       WHEN k % 7 = 3 THEN lower({d.month_name('od')})
       ELSE {d.month_name('od')} END AS issue_d,
  {d.month_name(d.add_months('od', '-(12 + ck % 240)'))} AS earliest_cr_line,
  CASE k % 211 WHEN 7 THEN '0' WHEN 8 THEN '-5' WHEN 9 THEN NULL
       ELSE CAST(price AS STRING) END AS loan_amnt,
  CAST(funded AS STRING) AS funded_amnt,
  CASE WHEN k % 2 = 0 THEN ' 36 months' ELSE ' 60 months' END AS term,
  CASE WHEN k % 53 = 0 THEN 'abc' WHEN k % 89 = 1 THEN '250%'
       ELSE CAST(5 + k % 20 AS STRING) || '.5%' END AS int_rate,
  CAST(ROUND(funded * 0.03, 2) AS STRING) AS installment,
  grade_txt AS grade,
  grade_txt || CAST(1 + k % 5 AS STRING) AS sub_grade,
  CASE k % 13 WHEN 0 THEN '< 1 year' WHEN 1 THEN '1 year' WHEN 10 THEN '10+ years'
              WHEN 11 THEN 'n/a' WHEN 12 THEN NULL
              ELSE CAST(k % 13 AS STRING) || ' years' END AS emp_length,
  cname AS emp_title,
  CASE ck % 3 WHEN 0 THEN 'RENT' WHEN 1 THEN 'OWN' ELSE 'MORTGAGE' END AS home_ownership,
  CAST(bal * 10 + 5000 AS STRING) AS annual_inc,
  CASE k % 3 WHEN 0 THEN 'Verified' WHEN 1 THEN 'Not Verified' ELSE 'Source Verified' END
    AS verification_status,
  lower(seg) AS purpose,
  'Loan for ' || lower(seg) AS title,
  region AS addr_state,
  lpad(CAST(ck % 1000 AS STRING), 3, '0') || 'xx' AS zip_code,
  CASE WHEN ck % 97 = 0 THEN '130' ELSE CAST(ROUND(bal * 0.004, 2) AS STRING) END AS dti,
  CAST(600 + ck % 200 AS STRING) || '.0' AS fico_range_low,
  CAST(604 + ck % 200 AS STRING) || '.0' AS fico_range_high,
  CAST(ck % 120 AS STRING) || '.0%' AS revol_util,
  CAST(bal AS STRING) AS revol_bal,
  CAST(k % 30 AS STRING) || '.0' AS open_acc,
  CAST(5 + k % 50 AS STRING) AS total_acc,
  CAST(k % 3 AS STRING) AS delinq_2yrs,
  CAST(k % 6 AS STRING) AS inq_last_6mths,
  CAST(ck % 2 AS STRING) AS pub_rec,
  CASE WHEN ck % 5 = 0 THEN '' ELSE '0' END AS pub_rec_bankruptcies,
  CAST(ck % 4 AS STRING) || '.0' AS mort_acc,
  CAST(bal * 20 AS STRING) AS tot_cur_bal,
  CASE WHEN k % 10 = 0 THEN 'Joint App' ELSE 'Individual' END AS application_type,
  CASE WHEN k % 211 = 11 THEN NULL
       WHEN st = 'F' AND k % 101 = 3 THEN 'Does not meet the credit policy. Status:Charged Off'
       WHEN st = 'F' THEN 'Charged Off'
       WHEN st = 'O' THEN 'Fully Paid'
       ELSE 'Current' END AS loan_status,
  CAST(CASE WHEN st = 'P' THEN ROUND(funded * 0.5, 2) ELSE 0.00 END AS STRING) AS out_prncp,
  CAST(paid AS STRING) AS total_pymnt,
  CAST(prncp AS STRING) AS total_rec_prncp,
  CAST(paid - prncp AS STRING) AS total_rec_int,
  CASE WHEN k % 17 = 0 THEN NULL
       ELSE CAST(CASE WHEN st = 'F' THEN ROUND(funded * 0.05, 2) ELSE 0.00 END AS STRING) END
    AS recoveries,
  CAST(ROUND(funded * 0.03, 2) AS STRING) AS last_pymnt_amnt,
  'Order ' || CAST(k AS STRING) || ', placed "' || pr || '"' AS {d.q('desc')}
FROM graded
"""


def complaints_raw_sql(d: Dialect) -> str:
    """Raw complaint text, one row per line item, header names as in the file."""
    q = d.q
    return f"""
SELECT
  CASE WHEN l.l_orderkey % 97 = 1 THEN 'not a date' ELSE {d.iso_date('l.l_shipdate')} END
    AS {q('Date received')},
  CASE l.l_returnflag
    WHEN 'R' THEN CASE l.l_linenumber % 3 WHEN 0 THEN 'Payday loan, title loan, or personal loan'
                                         WHEN 1 THEN 'Credit card or prepaid card'
                                         ELSE 'DEBT COLLECTION' END
    WHEN 'A' THEN CASE l.l_linenumber % 2 WHEN 0 THEN 'Mortgage'
                  ELSE 'Credit reporting, credit repair services, or other personal consumer reports' END
    ELSE CASE l.l_linenumber % 3 WHEN 0 THEN 'Student loan' WHEN 1 THEN 'Vehicle loan or lease'
         ELSE NULL END
  END AS {q('Product')},
  CASE WHEN l.l_linestatus = 'F' THEN 'General-purpose credit card or charge card' END
    AS {q('Sub-product')},
  CASE l.l_linenumber % 2 WHEN 0 THEN 'Incorrect information on your report'
       ELSE 'Problem with a purchase shown on your statement' END AS {q('Issue')},
  CASE WHEN l.l_partkey % 3 = 0 THEN 'Card was charged for something you did not purchase' END
    AS {q('Sub-issue')},
  CASE l.l_linenumber WHEN 1 THEN NULL WHEN 2 THEN ''
       ELSE 'Part ' || CAST(l.l_partkey AS STRING) || ' shipped, qty "'
            || CAST(CAST(l.l_quantity AS DECIMAL(8,2)) AS STRING) || '"' END
    AS {q('Consumer complaint narrative')},
  CAST(NULL AS STRING) AS {q('Company public response')},
  s.s_name AS {q('Company')},
  CASE WHEN s.s_suppkey % 10 = 0 THEN NULL ELSE r.r_name END AS {q('State')},
  lpad(CAST(s.s_suppkey % 1000 AS STRING), 3, '0') || 'XX' AS {q('ZIP code')},
  CASE WHEN l.l_partkey % 5 = 0 THEN 'Older American' END AS {q('Tags')},
  CASE WHEN l.l_partkey % 2 = 0 THEN 'Web' ELSE 'Phone' END AS {q('Submitted via')},
  {d.iso_date(d.add_days('l.l_shipdate', 2))} AS {q('Date sent to company')},
  'Closed with explanation' AS {q('Company response to consumer')},
  CASE l.l_linestatus WHEN 'F' THEN 'Yes' ELSE 'No' END AS {q('Timely response?')},
  CASE WHEN l.l_orderkey % 331 = 7 THEN 'n/a'
       ELSE CAST(l.l_orderkey * 8 + l.l_linenumber AS STRING) END AS {q('Complaint ID')}
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def loans_bronze(spark: SparkSession, sf_dir: str, source: str = "orders.parquet") -> DataFrame:
    """Loan bronze from driver tables: raw text, footer rows removed, stamped."""
    register_tables(spark, sf_dir, ["customer", "nation", "region"])
    orders = spread_rows(read_table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey"])
    orders.createOrReplaceTempView("orders")
    raw = spark.sql(loans_raw_sql(SPARK))
    return stamp_ingest(raw.where(is_numeric_id("id")), source)


def complaints_bronze(spark: SparkSession, sf_dir: str, source: str = "lineitem.parquet") -> DataFrame:
    """Complaint bronze from driver tables: raw text with ingest stamps."""
    register_tables(spark, sf_dir, ["supplier", "nation", "region"])
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    spread_rows(read_table(spark, sf_dir, "lineitem"), keys).createOrReplaceTempView("lineitem")
    return stamp_ingest(spark.sql(complaints_raw_sql(SPARK)), source)
