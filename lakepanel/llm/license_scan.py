"""Operator 12: license scan by ordered signature rules.

Several hundred hand-written patterns (``license_rules``) look for license
texts, identifiers, addresses, grants and names in the words of a text.

* **Words.**  A-Z become a-z; everything in ASCII but letters and digits ends a
  word; other characters belong to words.  The text is matched as its words
  with one space between them, so punctuation and line breaks do not matter
  and places are word numbers.
* **Keyword prefilter.**  Every rule names words that each of its matches
  holds.  One pass over the words finds which of all keywords a document has;
  only rules whose keywords are all there are tried.
* **Priority and containment.**  Detections are taken by the rules' order
  (form, then list), longer ones first within a form; one that lies inside a
  detection taken before is suppressed.  Partly overlapping ones both stay.
* **Base phrases** are rules of the lowest priority whose matches are also
  reported on their own (``n_base``, ``base_labels``), suppressed or not.

Every document is judged alone and where it lies: nothing is shuffled.

Defined results: a null or empty text has no words, no labels and score 0; a
text's length is not limited (memory of about eight times its bytes); equal
detections of several rules: the first rule's stays; repeated rows give
repeated results; an empty table gives an empty result; columns other than the
id and the text are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, ship_package
from .license_rules import BASE, FORMS, Rule, rules

_WORD_BYTES = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(256))
DETECTION = "struct<label:string,rule:string,start_word:bigint,n_words:bigint,score:double>"


class Scanner:
    """The rules, by keyword."""

    def __init__(self, ordered: Sequence[Rule] | None = None):
        self.rules = list(rules() if ordered is None else ordered)
        self.form_rank = {form: k for k, form in enumerate(FORMS)}
        counts: dict[bytes, int] = defaultdict(int)
        for rule in self.rules:
            for word in rule.keywords | rule.one_of:
                counts[word] += 1
        # Each rule waits at the keyword that the fewest rules share, or at each of those it needs one of.
        self.waiting: dict[bytes, list[int]] = defaultdict(list)
        for k, rule in enumerate(self.rules):
            places = [min(rule.keywords, key=lambda w: (counts[w], w))] if rule.keywords else rule.one_of
            for word in places:
                self.waiting[word].append(k)
        self.keywords = frozenset(counts)

    def gated(self, words: list[bytes]) -> list[int]:
        """Numbers of the rules whose keywords are all among the words, in order."""
        held = self.keywords.intersection(words)
        waiting = {k for w in held for k in self.waiting.get(w, ())}
        return sorted(k for k in waiting if self.rules[k].may_match(held))

    def detections(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        """(rule number, first word, word after the last) of every match, in text order per rule."""
        tried = self.gated(words)
        if not tried:
            return []
        body = b" " + b" ".join(words) + b" "
        starts = list(accumulate((len(w) + 1 for w in words), initial=0))
        out = []
        for k in tried:
            for match in self.rules[k].pattern.finditer(body):
                first = bisect_right(starts, match.start()) - 1
                out.append((k, first, bisect_right(starts, match.end() - 1)))
        return out

    def kept(self, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """The detections that no earlier one contains; by priority.

        A prefix maximum over the start words (a Fenwick tree) tells whether a
        taken detection that begins no later also ends no sooner.
        """
        ranked = sorted(found, key=lambda d: (self.form_rank[self.rules[d[0]].form], d[1] - d[2], d[0], d[1]))
        places = sorted({d[1] for d in found})
        furthest = [0] * (len(places) + 1)
        out = []
        for k, first, after in ranked:
            at = bisect_right(places, first)
            up, most = at, 0
            while up:
                most = max(most, furthest[up])
                up &= up - 1
            if most >= after:
                continue
            out.append((k, first, after))
            while at < len(furthest):
                furthest[at] = max(furthest[at], after)
                at += at & -at
        return out

    def scan(self, raw: bytes) -> tuple[int, list[tuple[int, int]], list[tuple[int, int, int]]]:
        """Number of words, base places (rule, word), kept detections."""
        words = raw.translate(_WORD_BYTES).split()
        found = self.detections(words)
        base = [(k, first) for k, first, _ in found if self.rules[k].form == "base"]
        return len(words), base, self.kept(found) if found else []


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Licenses named or quoted in every document.

    Returns ``doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score`` (the best kept detection's, 0 without one) and
    ``detections`` (kept ones, in text order).
    """
    ship_package(docs.sparkSession)
    kind = docs.select(doc_id).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        detection = pa.struct(
            [("label", pa.string()), ("rule", pa.string()), ("start_word", pa.int64()), ("n_words", pa.int64()), ("score", pa.float64())]
        )
        for batch in batches:
            for part in pieces(batch, "text"):
                rows = [scanner.scan(raw or b"") for raw in part.column(1).cast(pa.large_binary()).to_pylist()]
                named = [{scanner.rules[k].label for k, _ in base} for _, base, _ in rows]
                shown = [
                    [
                        {
                            "label": scanner.rules[k].label,
                            "rule": scanner.rules[k].name,
                            "start_word": first,
                            "n_words": after - first,
                            "score": scanner.rules[k].score,
                        }
                        for k, first, after in sorted(kept, key=lambda d: (d[1], d[2], d[0]))
                    ]
                    for _, _, kept in rows
                ]
                places = [[first for _, first in base] for _, base, _ in rows]
                yield pa.record_batch(
                    [
                        part.column(0),
                        pa.array([n for n, _, _ in rows], pa.int64()),
                        pa.array([len(x) for x in places], pa.int64()),
                        pa.array([min(x, default=None) for x in places], pa.int64()),
                        pa.array([max(x, default=None) for x in places], pa.int64()),
                        pa.array([",".join(sorted(x)) for x in named], pa.string()),
                        pa.array([",".join(sorted(x | {d["label"] for d in y})) for x, y in zip(named, shown, strict=True)], pa.string()),
                        pa.array([max((d["score"] for d in y), default=0.0) for y in shown], pa.float64()),
                        pa.array(shown, pa.list_(detection)),
                    ],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"],
                )

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run,
        f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
        f"labels string, score double, detections array<{DETECTION}>",
    )
