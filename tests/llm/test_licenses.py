"""License scan: base phrases against brute force, gates, suppression, odd rows."""

import random
import re

from helpers import documents
from lakepanel.llm.license_rules import BASE, rules
from lakepanel.llm.license_scan import Scanner, scan_licenses

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_base(text):
    words = WORDS.findall(lowered(text))
    places = []
    for phrase, label in BASE.items():
        p = phrase.split()
        places += [(k, label) for k in range(len(words)) if words[k : k + len(p)] == p]
    starts = [k for k, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


LINES = [
    ("Licensed under the GNU General Public License, version 3.", ["gpl", "gpl-3.0"]),
    ("GNU Lesser General Public License v2.1 or (at your option) any later version", ["lgpl-2.1-or-later"]),
    ("Released under the MIT License.", ["mit"]),
    ("Licensed under the Apache License, Version 2.0.", ["apache", "apache-2.0"]),
    ("Licensed under CC BY-NC 4.0.", ["cc-by", "cc-by-nc-4.0"]),
    ("GPLv3", ["gpl-3.0"]),
    ("SPDX-License-Identifier: MPL-2.0", ["mpl-2.0"]),
    ("http://creativecommons.org/licenses/by-sa/3.0/", ["cc-by-sa-3.0"]),
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted", ["bsd"]),
    ("GNU Affero General Public License version 2", ["agpl"]),
    ("a commit limit; mit der Lizenz", []),
]


def test_named_licenses():
    scanner = Scanner()
    for line, want in LINES:
        _, base, kept = scanner.scan(line.encode())
        labels = {scanner.rules[k].label for k, *_ in [*base, *kept]}
        assert sorted(labels) == want, line


def test_hundreds_of_rules_and_every_gate_lets_its_own_matches_through():
    listed = rules()
    assert len(listed) > 300 and len({r.name for r in listed}) == len(listed)
    scanner = Scanner(listed)
    rng = random.Random(4)
    # Texts spelled from the rules themselves: alternatives and options chosen at random.
    for k, rule in enumerate(listed):
        text = re.sub(r"\(\?<?[!=][^()]*\)", "", rule.source)
        while (m := re.search(r"\((?:\?:)?([^()]*)\)(\??)", text)) is not None:
            pick = rng.choice(m[1].split("|")) if not m[2] or rng.random() < 0.5 else ""
            text = text[: m.start()] + pick + text[m.end() :]
        text = re.sub(r"(.)\?", lambda m: rng.choice([m[1], ""]), text.replace("[cs]", "s"))
        if rule.pattern.search(f" {text} ".encode()):
            assert k in scanner.gated(text.encode().split()), (rule.name, text)


def test_suppression_against_all_pairs():
    scanner = Scanner()
    text = " ".join(line for line, _ in LINES * 3) + " GNU GPL version 2 cc by sa cc by"
    words = text.lower().translate({ord(c): " " for c in ".,;:/()-\n"}).encode().split()
    found = scanner.detections(words)
    ranked = sorted(found, key=lambda d: (scanner.form_rank[scanner.rules[d[0]].form], d[1] - d[2], d[0], d[1]))
    want = []
    for d in ranked:
        if not any(a <= d[1] and d[2] <= b for _, a, b in want):
            want.append(d)
    assert scanner.kept(found) == want and len(want) < len(found)


def test_rows_against_brute_force(spark):
    rng = random.Random(9)
    lines = [x for x, _ in LINES]
    rows = [(k, "\n".join(rng.choice([*lines, "é mit licenseé", "cc by cc by", "words here"]) for _ in range(rng.randint(1, 12)))) for k in range(60)]
    rows += [(60, ""), (61, None), (None, "MIT License"), (62, "..."), rows[3], (63, "word " * 200_000 + "apache license")]
    df = documents(spark, rows).selectExpr("*", "'x' AS labels", "'x' AS n_words", "'x' AS detections")
    got = scan_licenses(df).collect()
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)
    shown = sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got), key=key)
    assert shown == sorted(((i, *brute_base(t)) for i, t in rows), key=key)
    for r in got:
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        assert (r["score"] > 0) == bool(r["detections"])
    assert scan_licenses(df.limit(0)).count() == 0
