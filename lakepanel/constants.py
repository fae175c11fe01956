"""Fixed values.

These must stay equal to the source datasets' conventions and to the
published metric definitions for results to be comparable; they are listed
plainly and in their natural order.  Everything else in the library is a
parameter with one of these as its default.
"""

# ---------------------------------------------------------------- fixed values
# Complaint file header -> silver column name (16 columns, file order).
COMPLAINT_RENAMES = {
    "Date received": "date_received",
    "Product": "product",
    "Sub-product": "sub_product",
    "Issue": "issue",
    "Sub-issue": "sub_issue",
    "Consumer complaint narrative": "narrative",
    "Company public response": "company_public_response",
    "Company": "company",
    "State": "state",
    "ZIP code": "zip_code",
    "Tags": "tags",
    "Submitted via": "submitted_via",
    "Date sent to company": "date_sent_to_company",
    "Company response to consumer": "company_response",
    "Timely response?": "timely_response",
    "Complaint ID": "complaint_id",
}

# Product family classifier: ordered, first match wins, case-insensitive.
PRODUCT_FAMILY_RULES = [
    ("personal_loan", "(?i)personal loan|payday|consumer loan|installment"),
    ("credit_card", "(?i)credit card"),
    ("mortgage", "(?i)mortgage"),
    ("debt_collection", "(?i)debt collection"),
    ("credit_reporting", "(?i)credit report"),
]
PRODUCT_FAMILY_DEFAULT = "other"

# Families that overlap with consumer lending (complaint side of the panel).
LENDING_FAMILIES = ["personal_loan", "credit_card", "debt_collection"]

# Loan status patterns (matched against the lower-cased status text).
RESOLVED_STATUS_PATTERN = "fully paid|charged off|default"
DEFAULT_STATUS_PATTERN = "charged off|default"

# Score bands: half-open, upper edge excluded; last label is the open top band.
FICO_BANDS = [
    (660, "1: <660 (subprime)"),
    (700, "2: 660-699"),
    (740, "3: 700-739"),
    (780, "4: 740-779"),
]
FICO_TOP_BAND = "5: 780+"

DTI_BANDS = [
    (10, "1: <10"),
    (20, "2: 10-20"),
    (30, "3: 20-30"),
    (40, "4: 30-40"),
]
DTI_TOP_BAND = "5: 40+"

# Loan id must be all digits (drops the funding-summary footer row).
NUMERIC_ID_PATTERN = "^[0-9]+$"
# Grade domain for the grade mart.
GRADE_PATTERN = "^[A-G]$"

# Hard rules drop a row, soft rules only count it (SQL predicates over silver).
LOAN_HARD_RULES = {
    "core_not_null": "loan_amnt IS NOT NULL AND grade IS NOT NULL AND loan_status IS NOT NULL",
    "positive_amount": "loan_amnt > 0",
}
LOAN_SOFT_RULES = {
    "plausible_rate": "int_rate BETWEEN 0 AND 100",
    "plausible_dti": "dti BETWEEN 0 AND 120",
}

# Minimum resolved loans for a panel cell to be kept.
PANEL_MIN_RESOLVED = 100

# Loan silver columns in output order.
LOAN_SILVER_COLUMNS = [
    "loan_id", "issue_date", "earliest_cr_date", "credit_age_years",
    "loan_amnt", "funded_amnt", "term_months", "int_rate", "installment",
    "grade", "sub_grade", "emp_length_years", "emp_title", "home_ownership",
    "annual_inc", "verification_status", "purpose", "title", "addr_state", "zip_code",
    "dti", "fico_low", "fico_high", "fico_avg", "revol_util", "revol_bal",
    "open_acc", "total_acc", "delinq_2yrs", "inq_last_6mths", "pub_rec",
    "pub_rec_bankruptcies", "mort_acc", "tot_cur_bal", "application_type",
    "installment_to_income",
    "loan_status", "is_resolved", "is_default",
    "out_prncp", "total_pymnt", "total_rec_prncp", "total_rec_int", "recoveries",
    "last_pymnt_amnt", "net_cash", "charge_off_loss",
    "_ingested_at", "_source_file",
]

# Raw loan text columns parsed as plain doubles / as counters.
LOAN_DOUBLE_COLUMNS = [
    "loan_amnt", "funded_amnt", "installment", "annual_inc", "dti", "revol_bal",
    "tot_cur_bal", "out_prncp", "total_pymnt", "total_rec_prncp", "total_rec_int",
    "recoveries", "last_pymnt_amnt",
]
LOAN_COUNTER_COLUMNS = [
    "open_acc", "total_acc", "delinq_2yrs", "inq_last_6mths", "pub_rec",
    "pub_rec_bankruptcies", "mort_acc",
]
LOAN_PERCENT_COLUMNS = ["int_rate", "revol_util"]
# ------------------------------------------------------------ end fixed values

# Ingest stamp columns added at bronze.
INGESTED_AT = "_ingested_at"
SOURCE_FILE = "_source_file"
