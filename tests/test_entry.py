"""The entry module with and without the optional training-data folder."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"


def _listed(folder):
    done = subprocess.run([sys.executable, "-c", LIST], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return [line.split() for line in done.stdout.splitlines()]


def test_entry_works_without_the_optional_folder(tmp_dir):
    bare = f"{tmp_dir}/repo"
    shutil.copytree(REPO, bare, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    names, sql = _listed(bare)
    assert "panel_state_month" in names and not [n for n in names if n.startswith("op") or n == "pipeline"]
    assert set(sql) <= set(names)


def test_changed_fixed_value_does_not_pass_by_being_shared():
    from lakepanel import constants, oracle

    for name in ("PRODUCT_FAMILY_RULES", "LOAN_SILVER_COLUMNS", "COMPLAINT_RENAMES", "DTI_BANDS"):
        assert getattr(oracle, name) == getattr(constants, name)
        assert getattr(oracle, name) is not getattr(constants, name)
