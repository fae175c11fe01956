"""Golden end-to-end: raw CSV files -> bronze -> silver -> marts and panel.

All rows are invented; the expected numbers are worked out by hand in the
comments.
"""

import csv
import datetime as dt
import os

import pytest

from lakepanel.plans import complaints as C
from lakepanel.plans import loans as L
from lakepanel.plans import marts, panel
from lakepanel.sources import files
from lakepanel.sources.versions import read_version

LOAN_HEADER = [
    "id", "issue_d", "earliest_cr_line", "loan_amnt", "funded_amnt", "term", "int_rate",
    "installment", "grade", "sub_grade", "emp_length", "emp_title", "home_ownership",
    "annual_inc", "verification_status", "purpose", "title", "addr_state", "zip_code", "dti",
    "fico_range_low", "fico_range_high", "revol_util", "revol_bal", "open_acc", "total_acc",
    "delinq_2yrs", "inq_last_6mths", "pub_rec", "pub_rec_bankruptcies", "mort_acc",
    "tot_cur_bal", "application_type", "loan_status", "out_prncp", "total_pymnt",
    "total_rec_prncp", "total_rec_int", "recoveries", "last_pymnt_amnt", "desc",
]


def loan(id_, issue, amt, funded, rate, grade, status, state, fico_lo, dti, paid, prncp, rec, desc="ok",
         emp="3 years", inc="60000"):
    row = dict.fromkeys(LOAN_HEADER, "")
    row.update({
        "id": id_, "issue_d": issue, "earliest_cr_line": "Jan-2005", "loan_amnt": amt, "funded_amnt": funded,
        "term": " 36 months", "int_rate": rate, "installment": "100.00", "grade": grade, "sub_grade": grade + "1",
        "emp_length": emp, "emp_title": "Clerk, senior", "home_ownership": "RENT", "annual_inc": inc,
        "purpose": "debt_consolidation", "addr_state": state, "dti": dti, "fico_range_low": fico_lo,
        "fico_range_high": str(float(fico_lo) + 4) if fico_lo else "", "revol_util": "50%",
        "open_acc": "13.0", "total_acc": "20", "loan_status": status, "total_pymnt": paid,
        "total_rec_prncp": prncp, "recoveries": rec, "desc": desc,
    })
    return row


LOANS_FILE_1 = [
    # id 1: defaulted, loss = 1000 - 300 - 50 = 650
    loan("1", "Dec-2015", "1000", "1000", "10.0%", "A", "Charged Off", "CA", "700", "10", "400", "300", "50",
         desc='multi\nline, with "quotes"'),
    # id 2: fully paid, net cash +100
    loan("2", "dec-2015", "2000", "2000", "20.0%", "B", "Fully Paid", "CA", "660", "25", "2100", "2000", "0"),
    # id 3: current, unresolved
    loan("3", "Jan-2016", "3000", "3000", " 13.5", "A", "Current", "NY", "780", "45", "500", "400", "0"),
    # id 4: non-positive amount -> hard drop
    loan("4", "Jan-2016", "0", "0", "10%", "A", "Current", "NY", "700", "5", "0", "0", "0"),
    # id 5: missing grade -> hard drop
    loan("5", "Jan-2016", "500", "500", "10%", "", "Current", "NY", "700", "5", "0", "0", "0"),
    # id 6: grade H, soft-rule failures (rate 250%, dti 130); policy-text default with null recoveries
    loan("6", "2016-01", "1000", "1000", "250%", "H", "Does not meet the credit policy. Status:Charged Off",
         "", "", "130", "100", "100", ""),
]
# Second file: id 2 again (later file wins), plus the footer row.
LOANS_FILE_2 = [
    loan("2", "dec-2015", "2000", "2000", "20.0%", "B", "Fully Paid", "CA", "660", "25", "2200", "2000", "0"),
]


def write_csv(path, header, rows, footer=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as fh:
        w = csv.DictWriter(fh, fieldnames=header, quoting=csv.QUOTE_MINIMAL)
        w.writeheader()
        w.writerows(rows)
        if footer:
            fh.write(footer + "\n")


@pytest.fixture(scope="module")
def loan_silver(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("loans")
    write_csv(str(d / "a" / "loans_1.csv"), LOAN_HEADER, LOANS_FILE_1, footer="Total amount funded in policy code 1: 7500")
    write_csv(str(d / "b" / "loans_2.csv"), LOAN_HEADER, LOANS_FILE_2)
    bronze = files.bronze_csv(spark, str(d / "*" / "*.csv"), id_col="id")
    return L.silver_loans(bronze).cache()


def test_bronze_multiline_parse_and_footer(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("raw")
    write_csv(str(d / "l.csv"), LOAN_HEADER, LOANS_FILE_1, footer="Total amount funded in policy code 1: 7500")
    b = files.bronze_csv(spark, str(d / "l.csv"), id_col="id")
    assert b.count() == 6
    assert b.where("id = '1'").first()["desc"] == 'multi\nline, with "quotes"'
    # Without the multi-line option the quoted newline splits a record.
    assert files.read_plain_csv(spark, str(d / "l.csv")).count() > 7


def test_silver_rows_dedup_and_rules(loan_silver):
    rows = {r["loan_id"]: r for r in loan_silver.collect()}
    assert sorted(rows) == [1, 2, 3, 6]
    assert rows[2]["total_pymnt"] == 2200.0  # survivor from the later file
    assert rows[2]["issue_date"] == dt.date(2015, 12, 1)
    assert rows[6]["issue_date"] is None and rows[6]["is_default"] == 1 and rows[6]["charge_off_loss"] == 0.0
    assert rows[1]["charge_off_loss"] == 650.0 and rows[1]["open_acc"] == 13
    assert rows[3]["int_rate"] == 13.5 and rows[3]["term_months"] == 36 and rows[3]["emp_length_years"] == 3
    assert rows[1]["credit_age_years"] == 10.9
    assert rows[1]["installment_to_income"] == 0.02
    assert all(r["is_default"] <= r["is_resolved"] for r in rows.values())


def test_kpis(loan_silver):
    k = marts.portfolio_kpis(loan_silver).first().asDict()
    # funded 1000+2000+3000+1000 = 7000; defaults {1,6} over resolved {1,2,6}
    assert k["total_loans"] == 4
    assert k["total_funded_bn"] == 0.0
    assert k["avg_loan_amnt"] == 1750.0
    # (1000*10 + 2000*20 + 3000*13.5 + 1000*250) / 7000 = 48.64
    assert k["wavg_int_rate_pct"] == 48.64
    assert k["default_rate_pct"] == 66.67
    assert k["charge_off_loss_mn"] == 0.0
    # net cash: -600 + 200 - 2500 - 900 = -3800 -> -54.29 %
    assert k["realized_return_pct"] == -54.29


def test_grade_mart_excludes_out_of_domain(loan_silver):
    g = {r["grade"]: r.asDict() for r in marts.risk_by_grade(loan_silver).collect()}
    assert sorted(g) == ["A", "B"]
    assert g["A"]["loans"] == 2 and g["A"]["default_rate_pct"] == 100.0
    assert g["A"]["loss_rate_pct"] == round(100 * 650 / 4000, 2)


def test_band_marts_cover_filtered_rows(loan_silver):
    fico = marts.fico_band_risk(loan_silver).collect()
    assert sum(r["loans"] for r in fico) == loan_silver.where("fico_avg IS NOT NULL").count()
    dti = {r["dti_band"]: r["loans"] for r in marts.dti_band_risk(loan_silver).collect()}
    assert dti == {"2: 10-20": 1, "3: 20-30": 1, "5: 40+": 2}


COMPLAINT_HEADER = [
    "Date received", "Product", "Sub-product", "Issue", "Sub-issue", "Consumer complaint narrative",
    "Company public response", "Company", "State", "ZIP code", "Tags", "Submitted via",
    "Date sent to company", "Company response to consumer", "Timely response?", "Complaint ID",
]


def complaint(cid, date, product, state, narrative="", timely="Yes"):
    row = dict.fromkeys(COMPLAINT_HEADER, "")
    row.update({"Complaint ID": cid, "Date received": date, "Product": product, "State": state,
                "Consumer complaint narrative": narrative, "Timely response?": timely,
                "Date sent to company": date, "Company": "Bank, Inc."})
    return row


def test_complaint_silver_and_panel(spark, tmp_path_factory, loan_silver):
    d = tmp_path_factory.mktemp("cmp")
    rows = [
        complaint("10", "2015-12-03", "Credit card or prepaid card", "CA", 'said "no",\nthen left'),
        complaint("10", "2015-12-03", "Credit card or prepaid card", "CA"),  # duplicate id
        complaint("11", "2015-12-09", "Payday loan", "CA", timely="No"),
        complaint("12", "2015-12-10", "Mortgage", "CA"),
        complaint("13", "2015-12-11", "Debt collection", ""),
        complaint("x", "2015-12-11", "Debt collection", "CA"),
        complaint("14", "not a date", "Debt collection", "CA"),
    ]
    write_csv(str(d / "c.csv"), COMPLAINT_HEADER, rows)
    sc = C.silver_complaints(files.bronze_csv(spark, str(d / "c.csv")))
    got = {r["complaint_id"]: r for r in sc.collect()}
    assert sorted(got) == [10, 11, 12, 13, 14]
    # Same ingest stamp: the tie-break takes the smallest remaining columns in
    # name order, and has_narrative=false sorts first.
    assert got[10]["has_narrative"] is False
    assert got[11]["timely_response"] is False and got[11]["product_family"] == "personal_loan"
    assert got[14]["year_month"] is None
    seg = {(r["state"], r["issue_month"]): r["complaints"] for r in panel.complaint_segments(sc).collect()}
    assert seg == {("CA", "2015-12"): 2, (None, "2015-12"): 1, ("CA", None): 1}
    ls = panel.loan_segments(loan_silver)
    p = panel.state_month_panel(ls, panel.complaint_segments(sc), min_resolved=1).collect()
    assert len(p) == 1
    r = p[0].asDict()
    assert (r["state"], r["issue_month"], r["loans"], r["resolved_loans"], r["complaints"]) == ("CA", "2015-12", 2, 2, 2)
    assert r["default_rate"] == 0.5 and r["complaints_per_1k_loans"] == 1000.0
    assert panel.state_month_panel(ls, panel.complaint_segments(sc), min_resolved=3).count() == 0


def test_missing_required_column_raises(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("cmp_bad")
    header = [h for h in COMPLAINT_HEADER if h != "State"]
    write_csv(str(d / "c.csv"), header, [{h: "1" for h in header}])
    with pytest.raises(ValueError):
        C.silver_complaints(files.bronze_csv(spark, str(d / "c.csv")))


def _land_all(d):
    write_csv(str(d / "loans" / "a.csv"), LOAN_HEADER, LOANS_FILE_1, footer="Total amount funded in policy code 1: 7500")
    write_csv(str(d / "loans" / "b.csv"), LOAN_HEADER, LOANS_FILE_2)
    bulk = [complaint("10", "2015-12-03", "Credit card or prepaid card", "CA"),
            complaint("11", "2015-12-09", "Payday loan", "CA")]
    # History month file lacks the Tags column; it overlaps the bulk file on id 11.
    hist_header = [h for h in COMPLAINT_HEADER if h != "Tags"]
    hist = [{k: v for k, v in complaint("11", "2015-12-09", "Payday loan", "CA").items() if k != "Tags"},
            {k: v for k, v in complaint("9", "2015-11-30", "Debt collection", "CA").items() if k != "Tags"}]
    write_csv(str(d / "cmp" / "complaints.csv"), COMPLAINT_HEADER, bulk)
    write_csv(str(d / "hist" / "complaints_2015-11.csv"), hist_header, hist)


def test_lakehouse_layers_end_to_end(spark, tmp_path_factory):
    from lakepanel.plans.lakehouse import Lakehouse

    d = tmp_path_factory.mktemp("lake")
    _land_all(d)
    lake = Lakehouse(spark, str(d / "out"))
    lake.build_loans(str(d / "loans" / "*.csv"), row_floor=3)
    assert lake.report["bronze_loans_rows"] == 7  # 6 + 1 duplicate, footer dropped
    rules = lake.report["loan_rules"]
    assert rules["rows"] == 6 and rules["failed_core_not_null"] == 1 and rules["failed_positive_amount"] == 1
    assert rules["failed_plausible_rate"] == 1 and rules["failed_plausible_dti"] == 1
    assert lake.read("gold_portfolio_kpis", "gold").first()["total_loans"] == 4
    # 6 candidates: 4 in silver, the 2 that break a hard rule in quarantine.
    rejected = lake.read("silver_loans_rejected", "silver").collect()
    assert len(rejected) == 2 and lake.read("silver_loans", "silver").count() == 4
    # One row lacks a core field (its amount is fine), one has a non-positive amount.
    assert sorted((r["pass_core_not_null"], r["pass_positive_amount"]) for r in rejected) == [
        (False, True), (True, False)]
    lake.build_complaints(str(d / "cmp" / "*.csv"), str(d / "hist" / "*.csv"))
    sc = {r["complaint_id"]: r for r in lake.read("silver_complaints", "silver").collect()}
    assert sorted(sc) == [9, 10, 11]
    lake.build_panel(min_resolved=1)
    cells = lake.read("gold_state_month_panel", "gold").collect()
    assert [(r["state"], r["issue_month"], r["complaints"]) for r in cells] == [("CA", "2015-12", 2)]
    assert lake.read("gold_panel_correlation", "gold").count() == 2


def test_lakehouse_incremental_loans_take_only_new_files(spark, tmp_path_factory):
    from lakepanel.plans.lakehouse import Lakehouse

    d = tmp_path_factory.mktemp("lake_inc")
    landing = d / "landing"
    lake = Lakehouse(spark, str(d / "out"))
    glob = str(landing / "*" / "*.csv")
    write_csv(str(landing / "a" / "loans_1.csv"), LOAN_HEADER, LOANS_FILE_1,
              footer="Total amount funded in policy code 1: 7500")
    lake.build_loans(glob, row_floor=3, incremental=True)
    assert lake.report["bronze_loans_rows"] == 6  # footer dropped
    assert lake.read("silver_loans", "silver").count() == 4
    # A later file repeats loan 2 with a new payment total: the later arrival wins.
    write_csv(str(landing / "b" / "loans_2.csv"), LOAN_HEADER, LOANS_FILE_2)
    lake.build_loans(glob, row_floor=3, incremental=True)
    assert lake.report["bronze_loans_rows"] == 7
    silver = {r["loan_id"]: r for r in lake.read("silver_loans", "silver").collect()}
    assert sorted(silver) == [1, 2, 3, 6] and silver[2]["total_pymnt"] == 2200.0
    # Nothing new landed: bronze is unchanged.
    lake.build_loans(glob, row_floor=3, incremental=True, batch="third")
    assert lake.report["bronze_loans_rows"] == 7
    lake.build_loans(glob, row_floor=3, incremental=True, batch="third")  # repeated under its name
    log = [(r["batch"], r["rule"], r["failed"], r["total"]) for r in lake.rule_log().collect()]
    assert len({b for b, *_ in log}) == 3 and ("third", "positive_amount", 1, 6) in log
    assert len(log) == 3 * 4


def test_lakehouse_row_floor_raises(spark, tmp_path_factory):
    from lakepanel.operators.quality import RowFloorError
    from lakepanel.plans.lakehouse import Lakehouse

    d = tmp_path_factory.mktemp("lake_floor")
    _land_all(d)
    with pytest.raises(RowFloorError):
        Lakehouse(spark, str(d / "out")).build_loans(str(d / "loans" / "*.csv"), row_floor=100)


def test_lakehouse_catalog_tables_carry_layer_property(spark, tmp_path_factory):
    from lakepanel.plans.lakehouse import Lakehouse

    d = tmp_path_factory.mktemp("lake_cat")
    _land_all(d)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lp_test LOCATION '{d / 'wh'}'")
    lake = Lakehouse(spark, str(d / "out"), database="lp_test")
    lake.build_loans(str(d / "loans" / "*.csv"))
    props = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES lp_test.silver_loans").collect()}
    assert props.get("quality") == "silver"
    assert spark.table("lp_test.gold_risk_by_grade").count() == 2
    # The quarantine view derives each rule's result in SQL, as rejected_rows does.
    flags = sorted((r["pass_core_not_null"], r["pass_positive_amount"])
                   for r in spark.table("lp_test.silver_loans_rejected").collect())
    assert flags == [(False, True), (True, False)]
    assert spark.table("lp_test.silver_loans").count() == 4
    # Every table carries its layer and a comment.
    for table, layer in [("bronze_loans", "bronze"), ("silver_loans_rejected", "silver"),
                         ("gold_risk_by_grade", "gold")]:
        props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES lp_test.{table}").collect()}
        info = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED lp_test.{table}").collect()}
        assert props.get("quality") == layer
        assert info.get("Comment"), table


def test_build_script_runs_every_layer(spark, tmp_path_factory):
    import importlib.util

    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools", "build_lakehouse.py")
    spec = importlib.util.spec_from_file_location("build_lakehouse", path)
    script = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(script)

    d = tmp_path_factory.mktemp("lake_script")
    _land_all(d)
    out = str(d / "out")
    report = script.main([
        "--root", out, "--loans", str(d / "loans" / "*.csv"), "--loan-row-floor", "3",
        "--complaints", str(d / "cmp" / "*.csv"), "--history", str(d / "hist" / "*.csv"),
        "--min-resolved", "1",
    ], spark)
    assert report["bronze_loans_rows"] == 7 and report["bronze_complaints_rows"] == 4
    assert report["loan_rules"]["failed_core_not_null"] == 1
    cells = read_version(spark, f"{out}/gold/gold_state_month_panel").collect()
    assert [(r["state"], r["issue_month"]) for r in cells] == [("CA", "2015-12")]
