"""Independent DuckDB SQL for every registered query (the correctness oracle).

Only the raw text views are shared with the Spark side (one template, two
dialects, see ``plans.driver_views``).  Parsing, de-duplication, rules and
aggregation are re-stated here in plain SQL.

Money is summed exactly and every quotient is rounded half-up once.  DuckDB
turns decimal division into DOUBLE, so ``half_up`` works on whole numbers.
"""

from __future__ import annotations

from .plans.driver_views import DUCKDB, complaints_raw_sql, loans_raw_sql
from .settings import (
    FIRST_ARRIVAL_LANG,
    HISTORY_RENAMES,
    HISTORY_SPLIT,
    ORDERS_SPLIT,
    QUERY_MIN_RESOLVED,
    MOMENT_COLUMNS,
    MONTH_MIN_ROWS,
    ROW_FLOOR,
    SUMMARY_COLUMNS,
    SUPPORT_THRESHOLDS,
    TAXONOMY_CUTOFF,
)


# Fixed values, stated here on their own: a slip in ``constants`` must not pass
# by being shared.
COMPLAINT_RENAMES = {'Date received': 'date_received',
 'Product': 'product',
 'Sub-product': 'sub_product',
 'Issue': 'issue',
 'Sub-issue': 'sub_issue',
 'Consumer complaint narrative': 'narrative',
 'Company public response': 'company_public_response',
 'Company': 'company',
 'State': 'state',
 'ZIP code': 'zip_code',
 'Tags': 'tags',
 'Submitted via': 'submitted_via',
 'Date sent to company': 'date_sent_to_company',
 'Company response to consumer': 'company_response',
 'Timely response?': 'timely_response',
 'Complaint ID': 'complaint_id'}
DTI_BANDS = [(10, '1: <10'), (20, '2: 10-20'), (30, '3: 20-30'), (40, '4: 30-40')]
DTI_TOP_BAND = '5: 40+'
FICO_BANDS = [(660, '1: <660 (subprime)'), (700, '2: 660-699'), (740, '3: 700-739'), (780, '4: 740-779')]
FICO_TOP_BAND = '5: 780+'
LENDING_FAMILIES = ['personal_loan', 'credit_card', 'debt_collection']
LOAN_COUNTER_COLUMNS = ['open_acc', 'total_acc', 'delinq_2yrs', 'inq_last_6mths', 'pub_rec', 'pub_rec_bankruptcies', 'mort_acc']
LOAN_DOUBLE_COLUMNS = ['loan_amnt', 'funded_amnt', 'installment', 'annual_inc', 'dti', 'revol_bal', 'tot_cur_bal', 'out_prncp',
 'total_pymnt', 'total_rec_prncp', 'total_rec_int', 'recoveries', 'last_pymnt_amnt']
LOAN_PERCENT_COLUMNS = ['int_rate', 'revol_util']
LOAN_SILVER_COLUMNS = ['loan_id', 'issue_date', 'earliest_cr_date', 'credit_age_years', 'loan_amnt', 'funded_amnt', 'term_months',
 'int_rate', 'installment', 'grade', 'sub_grade', 'emp_length_years', 'emp_title', 'home_ownership',
 'annual_inc', 'verification_status', 'purpose', 'title', 'addr_state', 'zip_code', 'dti', 'fico_low',
 'fico_high', 'fico_avg', 'revol_util', 'revol_bal', 'open_acc', 'total_acc', 'delinq_2yrs', 'inq_last_6mths',
 'pub_rec', 'pub_rec_bankruptcies', 'mort_acc', 'tot_cur_bal', 'application_type', 'installment_to_income',
 'loan_status', 'is_resolved', 'is_default', 'out_prncp', 'total_pymnt', 'total_rec_prncp', 'total_rec_int',
 'recoveries', 'last_pymnt_amnt', 'net_cash', 'charge_off_loss', '_ingested_at', '_source_file']
PRODUCT_FAMILY_DEFAULT = 'other'
PRODUCT_FAMILY_RULES = [('personal_loan', '(?i)personal loan|payday|consumer loan|installment'), ('credit_card', '(?i)credit card'),
 ('mortgage', '(?i)mortgage'), ('debt_collection', '(?i)debt collection'),
 ('credit_reporting', '(?i)credit report')]


def half_up(num: str, den: str, digits: int) -> str:
    """``num / den`` (whole-number SQL) rounded half-up once; null where ``den`` is not positive."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    units = f"(2 * abs({n}) * {10**digits} + {d}) // (2 * {d})"
    return f"(CASE WHEN {d} > 0 THEN CAST(CASE WHEN {n} < 0 THEN -({units}) ELSE {units} END AS DOUBLE) / {10**digits} END)"


def sround(expr: str, digits: int) -> str:
    """Round a DOUBLE from its decimal digits (as Spark rounds doubles)."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def cents(col: str) -> str:
    """A money column in whole cents."""
    return f"CAST(CAST({col} AS DECIMAL(20,2)) * 100 AS HUGEINT)"


def parts(col: str) -> str:
    """A rate column in whole ten-thousandths."""
    return f"CAST(CAST({col} AS DECIMAL(20,4)) * 10000 AS HUGEINT)"


def tiny(col: str) -> str:
    """A column in whole hundred-millionths."""
    return f"CAST(CAST({col} AS DECIMAL(28,8)) * 100000000 AS HUGEINT)"


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _first_int(col: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract({col}, '(\\d+)', 1), '') AS INTEGER)"


def _to_int(col: str) -> str:
    # Spark truncates a fractional double when casting to int.
    return f"TRY_CAST(trunc(TRY_CAST({col} AS DOUBLE)) AS INTEGER)"


# Three loads of the loan view with repeated ids, later loads first.
LOAN_LOADS = """
  SELECT *, 1 AS load FROM lraw WHERE regexp_matches(id, '^[0-9]+$') AND TRY_CAST(id AS BIGINT) % 3 <> 2
  UNION ALL
  SELECT * REPLACE (CASE WHEN TRY_CAST(id AS BIGINT) % 5 = 0 THEN 'Charged Off' ELSE loan_status END AS loan_status), 2 AS load
  FROM lraw WHERE regexp_matches(id, '^[0-9]+$') AND (TRY_CAST(id AS BIGINT) % 3 = 2 OR TRY_CAST(id AS BIGINT) % 5 = 0)
  UNION ALL
  SELECT * REPLACE (CASE WHEN TRY_CAST(id AS BIGINT) % 2 = 0 THEN '0' ELSE loan_amnt END AS loan_amnt,
                    CASE WHEN TRY_CAST(id AS BIGINT) % 35 = 0 THEN 'x' ELSE id END AS id), 3 AS load
  FROM lraw WHERE regexp_matches(id, '^[0-9]+$') AND TRY_CAST(id AS BIGINT) % 7 = 0"""


def loans_silver_ctes(loads: bool = False, each: bool = False) -> str:
    """CTEs ending in ``sl``: the loan silver table, of the view or of its three loads (with ``each``, of each load)."""
    parsed = [
        "TRY_CAST(id AS BIGINT) AS loan_id",
        "CAST(try_strptime(issue_d, '%b-%Y') AS DATE) AS issue_date",
        "CAST(try_strptime(earliest_cr_line, '%b-%Y') AS DATE) AS earliest_cr_date",
        f"{_first_int('term')} AS term_months",
        "CASE WHEN regexp_matches(emp_length, '10\\+') THEN 10 "
        "WHEN regexp_matches(emp_length, '< 1') THEN 0 "
        f"ELSE {_first_int('emp_length')} END AS emp_length_years",
        f"{_to_int('fico_range_low')} AS fico_low",
        f"{_to_int('fico_range_high')} AS fico_high",
        "(TRY_CAST(fico_range_low AS DOUBLE) + TRY_CAST(fico_range_high AS DOUBLE)) / 2 AS fico_avg",
    ]
    parsed += [f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in LOAN_DOUBLE_COLUMNS]
    parsed += [f"TRY_CAST(replace({c}, '%', '') AS DOUBLE) AS {c}" for c in LOAN_PERCENT_COLUMNS]
    parsed += [f"{_to_int(c)} AS {c}" for c in LOAN_COUNTER_COLUMNS]
    passthrough = [
        "grade", "sub_grade", "emp_title", "home_ownership", "verification_status",
        "purpose", "title", "addr_state", "zip_code", "application_type", "loan_status",
    ]
    keep = [c for c in LOAN_SILVER_COLUMNS if c != "_ingested_at"]
    order = ", ".join(f"{c} ASC NULLS LAST" for c in sorted(c for c in keep if c not in ("loan_id", "_source_file")))
    return f"""
lraw AS ({loans_raw_sql(DUCKDB)}),
lbronze AS ({LOAN_LOADS if loads else "SELECT *, 0 AS load FROM lraw WHERE regexp_matches(id, '^[0-9]+$')"}),
lp AS (
  SELECT {', '.join(parsed)}, {', '.join(passthrough)}, load,
    CASE load WHEN 0 THEN 'orders.parquet' ELSE 'load_' || load END AS _source_file
  FROM lbronze
),
ld AS (
  SELECT *,
    {sround("datediff('month', earliest_cr_date, issue_date) / 12", 1)} AS credit_age_years,
    {half_up(f"{tiny('installment')} * 12", tiny('annual_inc'), 4)} AS installment_to_income,
    CASE WHEN regexp_matches(lower(loan_status), 'fully paid|charged off|default') THEN 1 ELSE 0 END AS is_resolved,
    CASE WHEN regexp_matches(lower(loan_status), 'charged off|default') THEN 1 ELSE 0 END AS is_default,
    total_pymnt - funded_amnt AS net_cash
  FROM lp
),
ll AS (
  SELECT *,
    CASE WHEN is_default = 1 THEN greatest(funded_amnt - total_rec_prncp - recoveries, 0.0)
         ELSE 0.0 END AS charge_off_loss
  FROM ld
),
lk AS (
  SELECT {', '.join(keep)}, load FROM ll WHERE loan_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {'load, ' if each else ''}loan_id ORDER BY load DESC, _source_file DESC NULLS LAST, {order}) = 1
),
sl AS (
  SELECT * FROM lk
  WHERE coalesce(loan_amnt IS NOT NULL AND grade IS NOT NULL AND loan_status IS NOT NULL, false)
    AND coalesce(loan_amnt > 0, false)
)"""


def _family_case(col: str) -> str:
    whens = " ".join(
        f"WHEN regexp_matches({col}, {_sql_str(p)}) THEN {_sql_str(label)}" for label, p in PRODUCT_FAMILY_RULES
    )
    return f"CASE {whens} ELSE {_sql_str(PRODUCT_FAMILY_DEFAULT)} END"


def complaints_silver_ctes() -> str:
    """CTEs ending in ``sc``: the complaint silver table."""
    renamed = ", ".join(f'"{raw}" AS {new}' for raw, new in COMPLAINT_RENAMES.items())
    cols = [*COMPLAINT_RENAMES.values(), "has_narrative", "year_month", "product_family"]
    order = ", ".join(f"{c} ASC NULLS LAST" for c in sorted(c for c in cols if c != "complaint_id"))
    return f"""
craw AS ({complaints_raw_sql(DUCKDB)}),
cr AS (SELECT {renamed} FROM craw),
ct AS (
  SELECT
    CAST(TRY_CAST(date_received AS TIMESTAMP) AS DATE) AS date_received,
    product, sub_product, issue, sub_issue, narrative, company_public_response, company,
    state, zip_code, tags, submitted_via,
    CAST(TRY_CAST(date_sent_to_company AS TIMESTAMP) AS DATE) AS date_sent_to_company,
    company_response,
    timely_response = 'Yes' AS timely_response,
    TRY_CAST(complaint_id AS BIGINT) AS complaint_id,
    narrative IS NOT NULL AND length(narrative) > 0 AS has_narrative,
    {_family_case('product')} AS product_family
  FROM cr
),
cy AS (SELECT *, strftime(date_received, '%Y-%m') AS year_month FROM ct),
sc AS (
  SELECT {', '.join(cols)} FROM cy WHERE complaint_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY complaint_id ORDER BY {order}) = 1
)"""


def with_silver(body: str, loans: bool = True, complaints: bool = False) -> str:
    ctes = []
    if loans:
        ctes.append(loans_silver_ctes())
    if complaints:
        ctes.append(complaints_silver_ctes())
    return "WITH " + ",".join(ctes) + "\n" + body


# ------------------------------------------------------------------ panel SQL
_LSEG = """
lseg AS (
  SELECT addr_state AS state, strftime(issue_date, '%Y-%m') AS issue_month,
         count(*) AS loans, CAST(sum(is_default) AS BIGINT) AS bad_loans,
         CAST(sum(is_resolved) AS BIGINT) AS resolved_loans
  FROM sl WHERE issue_date IS NOT NULL GROUP BY 1, 2
),
lseg2 AS (SELECT *, CASE WHEN resolved_loans > 0 THEN bad_loans / resolved_loans END AS default_rate FROM lseg)"""

_FAMS = ", ".join(_sql_str(f) for f in LENDING_FAMILIES)
_CSEG = f"""
cseg AS (
  SELECT state, year_month AS issue_month, count(*) AS complaints
  FROM sc WHERE product_family IN ({_FAMS}) GROUP BY 1, 2
)"""

_PANEL = f"""
panel AS (
  SELECT l.state, l.issue_month, loans, bad_loans, resolved_loans, default_rate, complaints,
         complaints / loans * 1000 AS complaints_per_1k_loans
  FROM lseg2 l JOIN cseg c ON l.state = c.state AND l.issue_month = c.issue_month
  WHERE resolved_loans >= {QUERY_MIN_RESOLVED}
)"""

_ROLLUP = """
rollup AS (
  SELECT state,
         CASE WHEN sum(resolved_loans) > 0 THEN sum(bad_loans) / sum(resolved_loans) END AS default_rate,
         CASE WHEN sum(loans) > 0 THEN sum(complaints) / sum(loans) * 1000 END AS complaints_per_1k_loans
  FROM panel GROUP BY state
)"""


def _panel_sql(select: str, extra: str = "") -> str:
    return (
        "WITH " + loans_silver_ctes() + "," + complaints_silver_ctes() + "," + _LSEG + "," + _CSEG
        + "," + _PANEL + extra + "\n" + select
    )


def _corr(df: str) -> str:
    return (
        f"SELECT '{df}' AS level, count(*) AS units, "
        f"round(corr(complaints_per_1k_loans, default_rate), 6) AS r FROM {df}"
    )


# ------------------------------------------------------------------ marts SQL
def _avg(col: str, digits: int, money: bool = False) -> str:
    units, unit = (cents(col), 100) if money else (parts(col), 10000)
    return half_up(f"sum({units})", f"count({col}) * {unit}", digits)


def _scaled(col: str, divisor: str, digits: int) -> str:
    return half_up(f"sum({cents(col)})", f"CAST({divisor} AS HUGEINT) * 100", digits)


def _ratio_pct(num: str, den: str, digits: int = 2) -> str:
    return half_up(f"100 * sum({cents(num)})", f"sum({cents(den)})", digits)


_DEFAULT_RATE = half_up("100 * sum(is_default)", "sum(is_resolved)", 2) + " AS default_rate_pct"
_LOANS = "count(*) AS loans"
_FUNDED1 = _scaled("funded_amnt", "1000000", 1) + " AS funded_mn"
_RATE = _avg("int_rate", 2) + " AS avg_int_rate_pct"


def _band_case(col: str, edges, top: str) -> str:
    whens = " ".join(f"WHEN {col} < {e} THEN {_sql_str(label)}" for e, label in edges)
    return f"CASE {whens} ELSE {_sql_str(top)} END"


MART_SQL = {
    "mart_kpis": with_silver(f"""
SELECT count(*) AS total_loans,
       {_scaled('funded_amnt', '1000000000', 2)} AS total_funded_bn,
       {_avg('loan_amnt', 0, money=True)} AS avg_loan_amnt,
       {half_up(f"sum({cents('funded_amnt')} * {parts('int_rate')})", f"sum({cents('funded_amnt')}) * 10000", 2)} AS wavg_int_rate_pct,
       {_avg('fico_avg', 0)} AS avg_fico,
       {_avg('dti', 1)} AS avg_dti,
       {_DEFAULT_RATE},
       {_scaled('charge_off_loss', '1000000', 1)} AS charge_off_loss_mn,
       {_ratio_pct('net_cash', 'funded_amnt')} AS realized_return_pct
FROM sl"""),
    "mart_grade": with_silver(f"""
SELECT grade, {_LOANS}, {_FUNDED1}, {_RATE}, {_avg('fico_avg', 0)} AS avg_fico, {_DEFAULT_RATE},
       {_ratio_pct('charge_off_loss', 'funded_amnt')} AS loss_rate_pct,
       {_ratio_pct('net_cash', 'funded_amnt')} AS realized_return_pct
FROM sl WHERE regexp_matches(grade, '^[A-G]$') GROUP BY grade ORDER BY grade"""),
    "mart_vintage": with_silver(f"""
SELECT CAST(year(issue_date) AS INTEGER) AS vintage_year, {_LOANS}, {_FUNDED1}, {_RATE}, {_DEFAULT_RATE}
FROM sl WHERE issue_date IS NOT NULL GROUP BY 1 ORDER BY 1"""),
    "mart_trend": with_silver(f"""
SELECT CAST(date_trunc('month', issue_date) AS DATE) AS issue_month, {_LOANS},
       {_scaled('funded_amnt', '1000000', 2)} AS funded_mn, {_RATE}
FROM sl WHERE issue_date IS NOT NULL GROUP BY 1 ORDER BY 1"""),
    "mart_geo": with_silver(f"""
SELECT addr_state AS state, {_LOANS}, {_FUNDED1}, {_RATE}, {_DEFAULT_RATE}
FROM sl WHERE addr_state IS NOT NULL GROUP BY 1 ORDER BY loans DESC, state"""),
    "mart_purpose": with_silver(f"""
SELECT purpose, {_LOANS}, {_FUNDED1}, {_RATE}, {_DEFAULT_RATE}
FROM sl WHERE purpose IS NOT NULL GROUP BY 1 ORDER BY loans DESC, purpose"""),
    "mart_score_band": with_silver(f"""
SELECT {_band_case('fico_avg', FICO_BANDS, FICO_TOP_BAND)} AS fico_band, {_LOANS}, {_RATE}, {_DEFAULT_RATE}
FROM sl WHERE fico_avg IS NOT NULL GROUP BY 1 ORDER BY 1"""),
    "mart_ratio_band": with_silver(f"""
SELECT {_band_case('dti', DTI_BANDS, DTI_TOP_BAND)} AS dti_band, {_LOANS}, {_DEFAULT_RATE}
FROM sl WHERE dti IS NOT NULL AND dti >= 0 GROUP BY 1 ORDER BY 1"""),
}

_SILVER_LOAN_COLS = ", ".join(c for c in LOAN_SILVER_COLUMNS if c != "_ingested_at")
_SILVER_COMPLAINT_COLS = ", ".join([*COMPLAINT_RENAMES.values(), "has_narrative", "year_month", "product_family"])

PANEL_SQL = {
    "panel_state_month": _panel_sql("SELECT * FROM panel"),
    "segment_loans": "WITH " + loans_silver_ctes() + "," + _LSEG + "\nSELECT * FROM lseg2",
    "segment_complaints": "WITH " + complaints_silver_ctes() + "," + _CSEG + "\nSELECT * FROM cseg",
    "panel_rollup": _panel_sql("SELECT * FROM rollup ORDER BY default_rate DESC NULLS LAST, state", "," + _ROLLUP),
    "panel_corr": _panel_sql(_corr("panel") .replace("'panel'", "'cell'") + " UNION ALL " + _corr("rollup").replace("'rollup'", "'state'"), "," + _ROLLUP),
    "silver_loans": with_silver(f"SELECT {_SILVER_LOAN_COLS} FROM sl"),
    "silver_complaints": with_silver(f"SELECT {_SILVER_COMPLAINT_COLS} FROM sc", loans=False, complaints=True),
}


# ------------------------------------------------------------ operators SQL
_HARD = [
    "coalesce(loan_amnt IS NOT NULL AND grade IS NOT NULL AND loan_status IS NOT NULL, false)",
    "coalesce(loan_amnt > 0, false)",
]
_SOFT = ["coalesce(int_rate BETWEEN 0 AND 100, false)", "coalesce(dti BETWEEN 0 AND 120, false)"]

_LINEITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
_EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props", "_source_file"]
_DOC_LABEL_COLS = [
    ("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
    ("n_chars", "bigint"), ("quality", "int"), ("toxic", "int"),
]


def _order_rest(cols, skip) -> str:
    return ", ".join(f"{c} ASC NULLS LAST" for c in sorted(c for c in cols if c not in skip))


def _spine(table: str, col: str) -> str:
    return f"""
b AS (SELECT min(CAST({col} AS DATE)) AS s, max(CAST({col} AS DATE)) AS e FROM {table}),
ms AS (SELECT s, e, CAST(unnest(generate_series(CAST(date_trunc('month', s) AS DATE), e, INTERVAL 1 MONTH)) AS DATE) AS m0 FROM b),
spine AS (
  SELECT strftime(m0, '%Y-%m') AS month, m0 AS window_start, least(last_day(m0), e) AS window_end
  FROM ms
)"""


_DOUBLE_SUMMARY = {"l_quantity", "l_extendedprice", "l_discount", "l_tax"}


def _summary_sql() -> str:
    parts = []
    for c in SUMMARY_COLUMNS:
        parts.append(f"SELECT '{c}' AS column_name, 'count' AS statistic, CAST(count({c}) AS VARCHAR) AS value FROM lineitem")
        v = f"({c} + 0.0)" if c in _DOUBLE_SUMMARY else f"CAST({c} AS DATE)" if c == "l_shipdate" else c
        parts.append(f"SELECT '{c}', 'min', CAST(min({v}) AS VARCHAR) FROM lineitem")
        parts.append(f"SELECT '{c}', 'max', CAST(max({v}) AS VARCHAR) FROM lineitem")
    return "\nUNION ALL ".join(parts)


def _null_profile_sql() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, '{t}' AS type, {i} AS position, count(*) AS total_rows, "
        f"count({c}) AS non_null, count(*) - count({c}) AS nulls FROM j"
        for i, (c, t) in enumerate(_DOC_LABEL_COLS)
    ]
    return (
        "WITH j AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic "
        "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)\n" + "\nUNION ALL ".join(parts)
    )


_HIST_COLS = ", ".join(HISTORY_RENAMES.values())

OPERATOR_SQL = {
    "rules_report": "WITH " + loans_silver_ctes() + f"""
SELECT count(*) AS input_rows,
       CAST(count_if({_HARD[0]} AND {_HARD[1]}) AS BIGINT) AS kept_rows,
       CAST(count_if(NOT {_HARD[0]}) AS BIGINT) AS hard_core_not_null,
       CAST(count_if(NOT {_HARD[1]}) AS BIGINT) AS hard_positive_amount,
       CAST(count_if(NOT {_SOFT[0]}) AS BIGINT) AS soft_plausible_rate,
       CAST(count_if(NOT {_SOFT[1]}) AS BIGINT) AS soft_plausible_dti,
       count(*) - CAST(count_if({_HARD[0]} AND {_HARD[1]}) AS BIGINT) AS dropped_rows
FROM lk""",
    "reconcile": "WITH " + complaints_silver_ctes() + """,
bz AS (SELECT TRY_CAST("Complaint ID" AS BIGINT) AS complaint_id,
              CAST(TRY_CAST("Date received" AS TIMESTAMP) AS DATE) AS date_received FROM craw)
SELECT 'bronze' AS layer, count(*) AS row_count, CAST(count_if(complaint_id IS NULL) AS BIGINT) AS null_ids,
       CAST(count_if(date_received IS NULL) AS BIGINT) AS null_dates,
       min(date_received) AS min_date_received, max(date_received) AS max_date_received FROM bz
UNION ALL
SELECT 'silver', count(*), CAST(count_if(complaint_id IS NULL) AS BIGINT), CAST(count_if(date_received IS NULL) AS BIGINT),
       min(date_received), max(date_received) FROM sc""",
    "row_floor": f"""
SELECT count(*) AS row_count, CAST({ROW_FLOOR} AS BIGINT) AS row_floor, count(*) > {ROW_FLOOR} AS above_floor
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "taxonomy_coverage": "WITH " + complaints_silver_ctes() + f"""
SELECT product, product_family, count(*) AS complaints FROM sc
WHERE year_month < '{TAXONOMY_CUTOFF}' GROUP BY 1, 2
ORDER BY complaints DESC, product ASC NULLS FIRST, product_family ASC NULLS FIRST""",
    "null_profile": _null_profile_sql(),
    "column_summary": _summary_sql(),
    "column_moments": "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg(CAST({c} AS DOUBLE)), 6) AS mean, "
        f"round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS stddev FROM lineitem"
        for c in MOMENT_COLUMNS
    ),
    "column_quartiles": "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, {p}::DOUBLE AS probability, q AS value, count({c}) AS rows, "
        f"CAST(count_if({c} < q) AS BIGINT) AS below, CAST(count_if({c} <= q) AS BIGINT) AS at_most "
        f"FROM lineitem, (SELECT CAST(quantile_disc({c}, {p}) AS DOUBLE) AS q FROM lineitem) GROUP BY q"
        for c in MOMENT_COLUMNS
        for p in (0.25, 0.5, 0.75)
    ),
    "reconcile_segments": "WITH " + loans_silver_ctes() + "," + complaints_silver_ctes() + "," + _LSEG + "," + _CSEG + f"""
SELECT 'complaints_with_narrative' AS what, count(*) AS row_count, CAST(count_if(has_narrative) AS BIGINT) AS selected,
       CAST(count_if(year_month IS NULL) AS BIGINT) AS null_months, min(year_month) AS first_month, max(year_month) AS last_month FROM sc
UNION ALL
SELECT 'resolved_loans', count(*), CAST(count_if(is_resolved = 1) AS BIGINT), CAST(count_if(issue_date IS NULL) AS BIGINT),
       strftime(min(issue_date), '%Y-%m'), strftime(max(issue_date), '%Y-%m') FROM sl
UNION ALL
SELECT 'loan_cells_kept', count(*), CAST(count_if(resolved_loans >= {QUERY_MIN_RESOLVED}) AS BIGINT),
       CAST(count_if(issue_month IS NULL) AS BIGINT), min(issue_month), max(issue_month) FROM lseg2
UNION ALL
SELECT 'complaint_cells', count(*), CAST(count_if(complaints > 0) AS BIGINT), CAST(count_if(issue_month IS NULL) AS BIGINT),
       min(issue_month), max(issue_month) FROM cseg""",
    "year_counts_all": "WITH " + complaints_silver_ctes() + f""",
bz AS (SELECT strftime(CAST(TRY_CAST("Date received" AS TIMESTAMP) AS DATE), '%Y') AS yr FROM craw)
SELECT 'bronze' AS layer, yr, count(*) AS complaints FROM bz GROUP BY 2
UNION ALL SELECT 'silver', substring(year_month, 1, 4), count(*) FROM sc GROUP BY 2
UNION ALL SELECT 'lending', substring(year_month, 1, 4), count(*) FROM sc WHERE product_family IN ({_FAMS}) GROUP BY 2""",
    "table_schemas": "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS type, CAST({i} AS INTEGER) AS position, "
        f"(SELECT count(*) FROM {table}) AS row_count, '{table}' AS table_name"
        for table, columns in (("documents", _DOC_LABEL_COLS[:5]), ("labels", [_DOC_LABEL_COLS[0], *_DOC_LABEL_COLS[5:]]))
        for i, (c, t) in enumerate(columns)
    ),
    "freq_desc": "WITH " + complaints_silver_ctes() + """
SELECT product_family, count(*) AS complaints FROM sc GROUP BY 1 ORDER BY 2 DESC, 1 ASC NULLS FIRST""",
    "counts_by_year": "WITH " + complaints_silver_ctes() + f"""
SELECT substring(year_month, 1, 4) AS yr, count(*) AS complaints FROM sc
WHERE product_family IN ({_FAMS}) GROUP BY 1 ORDER BY 1 NULLS FIRST""",
    "min_max": "WITH " + complaints_silver_ctes() + """
SELECT min(date_received) AS min_date_received, max(date_received) AS max_date_received,
       min(year_month) AS min_year_month, max(year_month) AS max_year_month FROM sc""",
    "top_k": "WITH " + loans_silver_ctes() + "," + _LSEG + """
SELECT * FROM lseg2 ORDER BY resolved_loans DESC, state ASC NULLS FIRST, issue_month ASC NULLS FIRST LIMIT 5""",
    "head_rows": with_silver("SELECT loan_id, issue_date, grade, loan_status FROM sl ORDER BY loan_id LIMIT 10"),
    "dedup_latest": f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, {_order_rest(_LINEITEM_COLS, ('l_orderkey', 'l_linenumber', 'l_shipdate'))}) = 1""",
    "history_union": f"""
WITH bulk AS (
  SELECT event_id, ts, user_id, event_type, value, props, 'bulk' AS _source_file
  FROM events WHERE ts < TIMESTAMP '{HISTORY_SPLIT[1]}'
), hist AS (
  SELECT {_HIST_COLS}, CAST(NULL AS VARCHAR) AS props, 'history' AS _source_file
  FROM events WHERE ts >= TIMESTAMP '{HISTORY_SPLIT[0]}' OR ts IS NULL
), u AS (SELECT * FROM bulk UNION ALL BY NAME SELECT * FROM hist)
SELECT * FROM u
QUALIFY row_number() OVER (PARTITION BY event_id
  ORDER BY _source_file ASC NULLS LAST, {_order_rest(_EVENT_COLS, ('event_id', '_source_file'))}) = 1""",
    "month_spine": "WITH " + _spine("orders", "o_orderdate") + "\nSELECT * FROM spine",
    "window_counts": "WITH " + _spine("lineitem", "l_shipdate") + """
SELECT s.month, s.window_start, s.window_end, count(o.o_orderkey) AS orders
FROM spine s LEFT JOIN orders o ON CAST(o.o_orderdate AS DATE) BETWEEN s.window_start AND s.window_end
GROUP BY ALL""",
    "coverage_gaps": "WITH " + _spine("lineitem", "l_shipdate") + """
SELECT * FROM spine s
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE strftime(CAST(o.o_orderdate AS DATE), '%Y-%m') = s.month)""",
}


_NUMBER_COLS = ("loan_id, loan_amnt, funded_amnt, int_rate, revol_util, term_months, "
                "emp_length_years, fico_low, fico_high, fico_avg, open_acc, mort_acc")
_COMPLAINTS_ONLY = {"loans": False, "complaints": True}

FAMILY_SQL = {
    "clean_numbers": with_silver(f"SELECT {_NUMBER_COLS} FROM sl"),
    "clean_dates": with_silver("""
SELECT loan_id, issue_date, earliest_cr_date, CAST(year(issue_date) AS INTEGER) AS issue_year,
       CAST(date_trunc('month', issue_date) AS DATE) AS issue_month_start,
       strftime(issue_date, '%Y-%m') AS issue_month
FROM sl"""),
    "credit_age": with_silver("SELECT loan_id, issue_date, earliest_cr_date, credit_age_years FROM sl"),
    "income_ratio": with_silver("SELECT loan_id, installment, annual_inc, installment_to_income FROM sl"),
    "status_flags": with_silver(
        "SELECT loan_status, is_resolved, is_default, count(*) AS loans FROM sl GROUP BY 1, 2, 3"),
    "loss_fields": with_silver("""
SELECT loan_id, loan_status, funded_amnt, total_pymnt, total_rec_prncp, recoveries, net_cash, charge_off_loss
FROM sl"""),
    "text_flags": with_silver("SELECT complaint_id, timely_response, has_narrative FROM sc", **_COMPLAINTS_ONLY),
    "classify_family": with_silver(
        "SELECT product, product_family, count(*) AS complaints FROM sc GROUP BY 1, 2", **_COMPLAINTS_ONLY),
    "rules_drop": "WITH " + loans_silver_ctes() + f"""
SELECT loan_id, loan_amnt, grade, loan_status,
       {_HARD[0]} AS pass_core_not_null, {_HARD[1]} AS pass_positive_amount
FROM lk WHERE NOT ({_HARD[0]} AND {_HARD[1]})""",
}


_DOCS = "SELECT doc_id, text, lang, source, n_chars"
SOURCE_SQL = {
    "csv_multiline_roundtrip": _DOCS + ", true AS lineage_ok FROM documents",
    "csv_split_roundtrip": _DOCS + ", true AS lineage_ok FROM documents",
    "csv_inferred": "SELECT CAST(doc_id AS INTEGER) AS doc_id, text, lang, source, "
                    "CAST(n_chars AS INTEGER) AS n_chars FROM documents",
    "ndjson_month_partitions": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority, strftime(o_orderdate, '%Y-%m') AS dt FROM orders""",
    "month_file_history": f"""
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders,
       count(CASE WHEN o_orderdate >= DATE '{ORDERS_SPLIT[0]}' OR o_orderdate IS NULL THEN 1 END) AS with_priority,
       count(CASE WHEN o_orderdate < DATE '{ORDERS_SPLIT[0]}' THEN 1 END) AS from_files
FROM orders GROUP BY 1""",
    "stream_ingest": _DOCS + " FROM documents",
    "stream_evolution": f"""
SELECT doc_id, text, lang,
       CASE WHEN lang IS DISTINCT FROM '{FIRST_ARRIVAL_LANG}' THEN source END AS source,
       CASE WHEN lang IS DISTINCT FROM '{FIRST_ARRIVAL_LANG}' THEN n_chars END AS n_chars
FROM documents""",
}


def _reloaded(sql: str) -> str:
    """A statement over loan silver, over the three loads instead."""
    return sql.replace(loans_silver_ctes(), loans_silver_ctes(loads=True))


_ALL_HARD = " AND ".join(_HARD)
BATCH_SQL = {
    "loans_reloaded": _reloaded(PANEL_SQL["silver_loans"]),
    "loans_incremental": _reloaded(PANEL_SQL["silver_loans"]),
    "rule_log": "WITH " + loans_silver_ctes(loads=True, each=True) + "\n" + "\nUNION ALL ".join(
        f"SELECT 'load_' || load AS batch, '{name}' AS rule, '{kind}' AS kind, "
        f"CAST(count_if(NOT {rule}) AS BIGINT) AS failed, count(*) AS total FROM lk GROUP BY load"
        for name, kind, rule in (
            ("core_not_null", "hard", _HARD[0]), ("positive_amount", "hard", _HARD[1]),
            ("plausible_rate", "soft", _SOFT[0]), ("plausible_dti", "soft", _SOFT[1]))),
    "row_account": "WITH " + loans_silver_ctes(loads=True, each=True) + "," + complaints_silver_ctes() + f"""
SELECT 'loans' AS source, 'load_' || b.load AS batch, b.n AS bronze_rows, b.n - b.readable AS null_keys,
       b.readable - b.ids AS duplicates, k.rejected, k.silver_rows, true AS balanced
FROM (SELECT load, count(*) AS n, count(TRY_CAST(id AS BIGINT)) AS readable, count(DISTINCT TRY_CAST(id AS BIGINT)) AS ids
      FROM lbronze GROUP BY load) b
JOIN (SELECT load, CAST(count_if(NOT ({_ALL_HARD})) AS BIGINT) AS rejected, CAST(count_if({_ALL_HARD}) AS BIGINT) AS silver_rows
      FROM lk GROUP BY load) k USING (load)
UNION ALL
SELECT 'complaints', 'all', count(*), count(*) - count(TRY_CAST("Complaint ID" AS BIGINT)),
       count(TRY_CAST("Complaint ID" AS BIGINT)) - count(DISTINCT TRY_CAST("Complaint ID" AS BIGINT)),
       CAST(0 AS BIGINT), (SELECT count(*) FROM sc), true FROM craw""",
    **{f"merged_{name}": _reloaded(sql) for name, sql in {**MART_SQL, "segment_loans": PANEL_SQL["segment_loans"]}.items()},
    "merged_segment_complaints": PANEL_SQL["segment_complaints"],
    "support_by_threshold": "WITH " + loans_silver_ctes() + "," + _LSEG + f"""
SELECT CAST(t AS INTEGER) AS min_resolved, count(*) AS cells, CAST(count_if(resolved_loans >= t) AS BIGINT) AS cells_kept,
       CAST(coalesce(sum(loans) FILTER (WHERE resolved_loans >= t), 0) AS BIGINT) AS loans_kept
FROM lseg2, (SELECT unnest([{', '.join(map(str, SUPPORT_THRESHOLDS))}]) AS t) GROUP BY t""",
    "coverage_below_floor": "WITH " + _spine("lineitem", "l_shipdate") + f"""
SELECT * FROM spine s
WHERE (SELECT count(*) FROM orders o WHERE strftime(CAST(o.o_orderdate AS DATE), '%Y-%m') = s.month) < {MONTH_MIN_ROWS}""",
    "backfill_ledger": "WITH " + _spine("orders", "o_orderdate") + f"""
SELECT s.month, count(o.o_orderkey) AS row_count,
       CASE WHEN count(o.o_orderkey) >= {MONTH_MIN_ROWS} THEN 'landed' ELSE 'short' END AS state
FROM spine s LEFT JOIN orders o ON strftime(CAST(o.o_orderdate AS DATE), '%Y-%m') = s.month GROUP BY ALL""",
}


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(BATCH_SQL)
    out.update(PANEL_SQL)
    out.update(MART_SQL)
    out.update(FAMILY_SQL)
    out.update(OPERATOR_SQL)
    out.update(SOURCE_SQL)
    return out
