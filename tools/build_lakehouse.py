"""Build the layered lakehouse from landed files; a script for spark-submit.

    spark-submit tools/build_lakehouse.py --root hdfs:///data/lake \\
        --loans 'hdfs:///data/raw/loans/*/*.csv' --incremental --loan-row-floor 2000000 \\
        --complaints 'hdfs:///data/raw/complaints/*.csv' \\
        --history 'hdfs:///data/raw/history/complaints_*.csv' --complaint-row-floor 3000000

Prints one JSON line: bronze row counts and the hard/soft rule failures
observed while the loan candidates were written.  Cluster sizing comes from
the submit command (see README); the session pins only what the library's
semantics rely on.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakepanel.constants import PANEL_MIN_RESOLVED  # noqa: E402
from lakepanel.plans.lakehouse import Lakehouse  # noqa: E402
from lakepanel.session import build_session  # noqa: E402


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    ap.add_argument("--root", required=True, help="folder for the Parquet layers (and stream checkpoints)")
    ap.add_argument("--database", help="write catalog tables in this database instead of Parquet folders")
    ap.add_argument("--loans", help="glob of landed loan CSV files")
    ap.add_argument("--incremental", action="store_true", help="take only loan files not seen before")
    ap.add_argument("--loan-row-floor", type=int)
    ap.add_argument("--complaints", help="glob of landed complaint CSV files")
    ap.add_argument("--history", help="glob of monthly complaint history files")
    ap.add_argument("--complaint-row-floor", type=int)
    ap.add_argument("--min-resolved", type=int, default=PANEL_MIN_RESOLVED,
                    help="panel support threshold (resolved loans per state and month)")
    return ap.parse_args(argv)


def main(argv: list[str] | None = None, spark=None) -> dict:
    args = parse_args(argv)
    spark = spark or build_session(app_name="lakepanel-build")
    lake = Lakehouse(spark, root=args.root, database=args.database)
    if args.loans:
        lake.build_loans(args.loans, row_floor=args.loan_row_floor, incremental=args.incremental)
    if args.complaints:
        lake.build_complaints(args.complaints, history_glob=args.history, row_floor=args.complaint_row_floor)
    if args.loans and args.complaints:
        lake.build_panel(min_resolved=args.min_resolved)
    print(json.dumps(lake.report, default=str))
    return lake.report


if __name__ == "__main__":
    main()
