"""Signature rules of the license scan (operator 12).

Rules are regular expressions over *words* (lower case, one space between
them), written by hand per license family and spelled out by ``rules`` for each
version and form.  They are ordered: a rule's place in the list is its
priority, texts and identifiers first, bare names last.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

# The base phrases and their labels, fixed values of the contract.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

LICENSE = "licen[cs]e"
GRANT = (
    "(?:licensed|released|distributed|redistributed|published|available|provided|covered|shared) under"
    "(?: the)?(?: terms(?: and conditions)? of)?(?: the| a| an)?"
)
LATER = "(?: of the license)? or (?:at your option )?(?:any )?(?:later|newer)(?: version)?"

# label, name, short name ("" if too common a word), versions, words of its address.
FAMILIES = [
    ("gpl", f"(?:gnu )?(?<!lesser )(?<!library )(?<!affero )general public {LICENSE}", "(?:gnu )?gpl", "1.0 2.0 3.0", "gnu org licenses (?:old licenses )?gpl"),
    ("lgpl", f"(?:gnu )?(?:lesser|library) general public {LICENSE}", "(?:gnu )?lgpl", "2.0 2.1 3.0", "gnu org licenses (?:old licenses )?lgpl"),
    ("agpl", f"(?:gnu )?affero general public {LICENSE}", "(?:gnu )?agpl", "1.0 3.0", "gnu org licenses agpl"),
    ("gfdl", f"(?:gnu )?free documentation {LICENSE}", "(?:gnu )?gfdl", "1.1 1.2 1.3", "gnu org licenses (?:old licenses )?fdl"),
    ("apache", f"apache (?:software )?{LICENSE}", "apache", "1.0 1.1 2.0", f"apache org licenses {LICENSE}"),
    ("mpl", f"mozilla public {LICENSE}", "mpl", "1.0 1.1 2.0", "mozilla org mpl"),
    ("epl", f"eclipse public {LICENSE}", "epl", "1.0 2.0", "eclipse org legal epl"),
    ("cddl", f"common development and distribution {LICENSE}", "cddl", "1.0 1.1", ""),
    ("cpl", f"common public {LICENSE}", "", "1.0", ""),
    ("cpal", f"common public attribution {LICENSE}", "cpal", "1.0", ""),
    ("eupl", f"european union public {LICENSE}", "eupl", "1.0 1.1 1.2", ""),
    ("osl", f"open software {LICENSE}", "osl", "1.0 1.1 2.0 2.1 3.0", ""),
    ("afl", f"academic free {LICENSE}", "", "1.1 1.2 2.0 2.1 3.0", ""),
    ("artistic", f"artistic {LICENSE}", "", "1.0 2.0", ""),
    ("bsl", f"boost software {LICENSE}", "", "1.0", "boost org license"),
    ("ofl", f"(?:sil )?open font {LICENSE}", "", "1.0 1.1", "scripts sil org ofl"),
    ("odbl", f"open (?:data commons open )?database {LICENSE}", "odbl", "1.0", "opendatacommons org licenses odbl"),
    ("odc-by", f"open data commons attribution {LICENSE}", "odc by", "1.0", "opendatacommons org licenses by"),
    ("lppl", f"latex project public {LICENSE}", "lppl", "1.0 1.1 1.2 1.3", ""),
    ("cecill", f"cecill (?:free software )?{LICENSE}", "cecill", "1.0 1.1 2.0 2.1", ""),
    ("ecl", f"educational community {LICENSE}", "", "1.0 2.0", ""),
    ("upl", f"universal permissive {LICENSE}", "", "1.0", ""),
    ("rpl", f"reciprocal public {LICENSE}", "", "1.1 1.5", ""),
    ("apsl", f"apple public source {LICENSE}", "apsl", "1.0 1.1 1.2 2.0", ""),
    ("php", f"php {LICENSE}", "", "3.0", ""),
    ("psf", f"python software foundation {LICENSE}", "", "2.0", ""),
    ("sspl", f"server side public {LICENSE}", "sspl", "1.0", ""),
    ("busl", f"business source {LICENSE}", "busl", "1.1", ""),
    ("elastic", f"elastic {LICENSE}", "", "2.0", ""),
    ("zpl", f"zope public {LICENSE}", "zpl", "1.1 2.0 2.1", ""),
    ("ipl", f"ibm public {LICENSE}", "", "1.0", ""),
    ("spl", f"sun public {LICENSE}", "", "1.0", ""),
    ("qpl", f"q public {LICENSE}", "", "1.0", ""),
    ("npl", f"netscape public {LICENSE}", "", "1.0 1.1", ""),
    ("mulan-psl", f"mulan (?:permissive software|psl) {LICENSE}", "mulan psl", "1.0 2.0", ""),
    ("open-rail-m", f"(?:bigscience |creativeml )?(?:open rail|openrail) m(?: {LICENSE})?", "", "1.0", ""),
    ("mit", f"(?:mit|expat|mit expat) {LICENSE}", "", "", "opensource org licenses mit"),
    ("mit-0", f"mit no attribution(?: {LICENSE})?", "", "", ""),
    ("x11", f"x11 {LICENSE}", "", "", ""),
    ("isc", f"isc {LICENSE}", "", "", "opensource org licenses isc"),
    ("zlib", f"zlib(?: libpng)? {LICENSE}", "", "", ""),
    ("unlicense", "the unlicense", "", "", "unlicense org"),
    ("wtfpl", f"do what the fuck you want to public {LICENSE}", "wtfpl", "", ""),
    ("0bsd", f"(?:zero clause bsd|bsd zero clause|0bsd)(?: {LICENSE})?", "", "", ""),
    ("bsd-2-clause", f"(?:(?:simplified|freebsd|(?:2|two) clause)(?: bsd)?|bsd (?:2|two) clause) {LICENSE}", "bsd (?:2|two) clause", "", "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", f"(?:(?:modified bsd|new bsd|(?:3|three) clause bsd)|bsd (?:3|three) clause) {LICENSE}", "bsd (?:3|three) clause", "", "opensource org licenses bsd 3 clause"),
    ("bsd-4-clause", f"(?:(?:original bsd|old bsd|(?:4|four) clause bsd)|bsd (?:4|four) clause) {LICENSE}", "bsd (?:4|four) clause", "", ""),
    ("bsd", f"bsd (?:style )?{LICENSE}", "", "", ""),
    ("ncsa", f"(?:university of illinois )?ncsa open source {LICENSE}", "", "", ""),
    ("postgresql", f"postgresql {LICENSE}", "", "", ""),
    ("ms-pl", f"microsoft public {LICENSE}", "ms pl", "", ""),
    ("ms-rl", f"microsoft reciprocal {LICENSE}", "ms rl", "", ""),
    ("openssl", f"openssl {LICENSE}", "", "", ""),
    ("w3c", f"w3c software (?:notice and )?{LICENSE}", "", "", ""),
    ("vim", f"vim {LICENSE}", "", "", ""),
    ("ruby", f"ruby {LICENSE}", "", "", ""),
    ("perl", "same terms as perl(?: itself)?", "", "", ""),
    ("pddl", f"(?:open data commons )?public domain dedication and {LICENSE}", "pddl", "", "opendatacommons org licenses pddl"),
    ("cc0", "(?:creative commons zero|cc0)(?: 1 0)?(?: universal)?", "", "", "creativecommons org publicdomain zero"),
    ("public-domain", "(?:placed|released|dedicated) (?:in|into|to) the public domain", "", "", "creativecommons org publicdomain mark"),
]

# Creative Commons terms after the attribution, as words, as letters.
CC_TERMS = {
    "": ("", ""),
    "-sa": (" share ?alike", " sa"),
    "-nc": (" non ?commercial", " nc"),
    "-nd": (" no ?deriv(?:ative)?s?(?: works)?", " nd"),
    "-nc-sa": (" non ?commercial share ?alike", " nc sa"),
    "-nc-nd": (" non ?commercial no ?deriv(?:ative)?s?(?: works)?", " nc nd"),
}
CC_VERSIONS = "1.0 2.0 2.5 3.0 4.0"

# Sentences of the license texts themselves: label, sentence, two of its words.
TEXTS = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby obtaining"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", "distribute fee"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution binary"),
    ("apache-2.0", "you may not use this file except in compliance with the license", "except compliance"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license", "redistribute modify"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", "redistribute modify"),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license", "redistribute affero"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", "mozilla subject"),
    ("bsl", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", "hereby accompanying"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "authors liable"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered domain"),
    ("ofl", "this font software is licensed under the sil open font license", "font sil"),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed", "verbatim everyone"),
    ("all-rights-reserved", "all rights reserved", "rights reserved"),
    ("proprietary", "proprietary and confidential", "proprietary confidential"),
]


@dataclass
class Rule:
    """``keywords``: words that every match holds; ``one_of``: it holds one of these, if there are any.

    The pattern is only tried where the words occur.
    """

    name: str
    label: str
    form: str
    score: float
    keywords: frozenset[bytes]
    one_of: frozenset[bytes]
    source: str

    def may_match(self, held: frozenset[bytes]) -> bool:
        """Whether a text with the keywords ``held`` can hold a match."""
        return self.keywords <= held and (not self.one_of or not self.one_of.isdisjoint(held))

    @cached_property
    def pattern(self) -> re.Pattern[bytes]:
        """The rule as bytes, between the spaces around its first and last word."""
        return re.compile(f" (?:{self.source})(?= )".encode())


def _version(text: str) -> str:
    major, minor = text.split(".")
    number = rf"v?{major}(?: 0)?(?! [1-9])" if minor == "0" else f"v?{major} {minor}"
    return f"(?:version |ver |v )?{number}"


def _keywords(source: str) -> frozenset[bytes]:
    """The plain words of a pattern outside groups, which every match must hold."""
    depth, plain = 0, ""
    for sign in re.sub(r"\(\?:[^()]* \)\?|\(\?: [^()]*\)\?|\(\?<![^()]*\)", "", source):  # optional words
        depth += (sign == "(") - (sign == ")")
        plain += sign if depth == 0 and sign != ")" else "|"
    return _words(" ".join(w for w in plain.split(" ") if w.isalnum() and len(w) > 1))


def _words(text: str) -> frozenset[bytes]:
    return frozenset(text.encode().split())


# Names whose words stand in groups: one of these is in every match.
ONE_OF = {
    "mit": "license licence",
    "0bsd": "bsd 0bsd",
    "bsd-2-clause": "bsd clause",
    "bsd-3-clause": "bsd clause",
    "bsd-4-clause": "bsd clause",
    "open-rail-m": "rail openrail",
    "cc0": "cc0 creative",
}


# What each form of evidence is worth; its place here is its priority.
FORMS = {"text": 1.0, "identifier": 1.0, "address": 1.0, "grant": 0.95, "name_version": 0.9, "name": 0.8, "short": 0.7, "base": 0.5}


def rules() -> list[Rule]:
    """Every rule, highest priority first: by form, then as listed, later versions of a family after earlier ones."""
    out: list[Rule] = []

    def add(form: str, label: str, source: str, keywords: str | None = None, more: str = "", one_of: str = "") -> None:
        held = (_keywords(source) if keywords is None else _words(keywords)) | _words(more)
        out.append(Rule(f"{form}:{label}:{len(out)}", label, form, FORMS[form], held, _words(one_of), source))

    for label, sentence, words in TEXTS:
        add("text", label, sentence, words)
    for family, name, short, versions, address in FAMILIES:
        spdx = family.replace("-", " ")
        any_of = ONE_OF.get(family, "")
        add("identifier", family, f"spdx license identifier {spdx}")
        add("grant", family, f"{GRANT} {name}", more="under", one_of=any_of)
        add("name", family, name, one_of=any_of)
        if address:
            add("address", family, address)
        if short:
            add("grant", family, f"{GRANT} {short}", more="under")
            add("short", family, f"{short} {LICENSE}d?")
        for v in versions.split():
            label, number = f"{family}-{v}", _version(v)
            add("identifier", label, f"spdx license identifier {spdx} {v.replace('.', ' ')}(?: only)?")
            add("identifier", f"{label}-or-later", f"spdx license identifier {spdx} {v.replace('.', ' ')} or later")
            add("grant", label, f"{GRANT} {name} {number}", more="under", one_of=any_of)
            add("name_version", label, f"{name} {number}", one_of=any_of)
            add("name_version", f"{label}-or-later", f"{name} {number}{LATER}", one_of=any_of)
            if address:
                add("address", label, f"{address} {number}")
            if short:
                # "gpl v3" and "gplv3"
                word = short.split(" ")[-1].rpartition(")")[2].lstrip("?")
                glued, held = f"{short}(?: |(?=v[0-9])){number}", f"{word} {word}v{v.split('.')[0]}"
                add("grant", label, f"{GRANT} {glued}", "under", one_of=held)
                add("short", label, glued, "", one_of=held)
                add("short", f"{label}-or-later", f"{glued}{LATER}", "or", one_of=held)
    kinds = "(?: (?:international|unported|generic))?"
    for terms, (words, letters) in CC_TERMS.items():
        label = f"cc-by{terms}"
        name, short = f"creative commons attribution{words}", f"cc by{letters}"
        add("name", label, f"{name}(?: {LICENSE})?", "creative commons")
        add("short", label, short, "cc by")
        add("grant", label, f"{GRANT} {short}", "cc by under")
        add("address", label, f"creativecommons org licenses by{letters}", "creativecommons licenses")
        for v in CC_VERSIONS.split():
            number = v.replace(".", " ")
            add("identifier", f"{label}-{v}", f"spdx license identifier {short} {number}", "spdx cc")
            add("address", f"{label}-{v}", f"creativecommons org licenses by{letters} {number}", "creativecommons licenses")
            add("name_version", f"{label}-{v}", f"{name} {number}{kinds}(?: (?:public )?{LICENSE})?", "creative commons")
            add("grant", f"{label}-{v}", f"{GRANT} {short} {number}", "cc by under")
            add("short", f"{label}-{v}", f"{short} {number}{kinds}(?: {LICENSE})?", "cc by")
    for phrase, label in BASE.items():
        add("base", label, phrase, phrase)
    order = list(FORMS)
    out.sort(key=lambda r: order.index(r.form))  # stable: as listed within a form
    return out
