"""Rows-only queries checked against a plain-Python reading of the same files.

``csv_plain_fragments`` and ``line_preview`` have no SQL oracle (the first is
the broken one-record-per-line parse, the second reads physical lines), so
they are compared with a brute-force reading of the landed CSV files.
"""

import glob
import re

from lakepanel import queries as Q

from testdata_paths import SF01

# Hadoop's line reader ends a line at \n, \r or \r\n.
LINE_END = re.compile(r"\r\n|\r|\n")


def _landed_files(spark):
    pattern = Q.landed_documents_csv(spark, SF01)
    return sorted(glob.glob(pattern.removeprefix("file:")))


def _lines(path):
    with open(path, encoding="utf-8", newline="") as fh:
        text = fh.read()
    lines = LINE_END.split(text)
    if lines and lines[-1] == "":
        lines.pop()  # the final line break ends the last line
    return lines


def test_plain_fragments_count_matches_physical_lines(spark):
    files = _landed_files(spark)
    assert files
    # One record per non-blank physical line; each file's first line is its header.
    expected = sum(sum(1 for ln in _lines(p) if ln.strip()) - 1 for p in files)
    got = Q.csv_plain_fragments(spark, SF01).count()
    assert got == expected


def test_line_preview_is_the_head_of_a_landed_file(spark):
    heads = {tuple(_lines(p)[:3]) for p in _landed_files(spark)}
    got = tuple(r.value for r in Q.line_preview(spark, SF01).collect())
    assert len(got) == 3
    assert got in heads
