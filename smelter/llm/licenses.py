"""License scan: an Aho-Corasick automaton finds notices and tags, a shunting-yard parser reads licence expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases that are looked for and the labels that they stand for.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "permission to use copy modify and or distribute this software": "isc",
    "isc license": "isc",
    "boost software license": "bsl",
    "creative commons": "creative-commons",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0 1 0": "cc0",
    "released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
#: Beginnings of identifiers, the label of those that have it, and whether it permits use without sharing alike.
FAMILIES = [
    ("agpl-", "agpl", False), ("lgpl-", "lgpl", False), ("gpl-", "gpl", False), ("gfdl-", "gfdl", False), ("apache-", "apache", True), ("mit", "mit", True),
    ("bsd-", "bsd", True), ("0bsd", "bsd", True), ("isc", "isc", True), ("mpl-", "mpl", False), ("epl-", "epl", False), ("bsl-", "bsl", True), ("cc0-", "cc0", True),
    ("cc-by-nc-", "cc-by-nc", False), ("cc-by-sa-", "cc-by-sa", False), ("cc-by-nd-", "cc-by-nd", False), ("cc-by-", "cc-by", True), ("unlicense", "unlicense", True), ("zlib", "zlib", True),
]
#: Beginnings of other identifiers, which are their own label, and names of exceptions that don't say so.
OTHERS = (
    "afl-", "apsl-", "artistic-", "blueoak-", "bzip2-", "cddl-", "cecill-", "cpl-", "curl", "ecl-", "eupl-", "fsfap", "ftl", "hpnd", "ijg", "ipl-", "json", "libpng", "licenseref-", "lppl-",
    "ms-pl", "ms-rl", "mulanpsl-", "ncsa", "odbl-", "odc-by-", "ofl-", "openssl", "osl-", "pddl-", "php-", "postgresql", "psf-", "python-", "ruby", "sspl-", "tcl", "unicode-", "upl-", "vim", "w3c", "wtfpl", "x11", "zpl-",
)
NOTES = ("linux-syscall-note",)

LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32
    for c in range(256)
)
EXPRESSION = re.compile(r"spdx-license-identifier\s*:[ \t]*([^\n]*)")
SYMBOL = re.compile(r"[()]|[a-z0-9][a-z0-9.+-]*")
#: How tightly an operator binds.
BINDING = {"or": 1, "and": 2, "with": 3}


@dataclass(frozen=True)
class Terms:
    """The labels in an expression, and whether some choice in it permits use without sharing alike."""

    labels: frozenset[str]
    permissive: bool


def begins(name: str, start: str) -> bool:
    return name.startswith(start) and (start.endswith("-") or name[len(start) :][:1] in ("", "-"))


def licence(name: str) -> Terms | None:
    """What a known identifier stands for; None for any other word."""
    for start, label, permissive in FAMILIES:
        if begins(name, start):
            return Terms(frozenset([label]), permissive)
    return Terms(frozenset([name]), False) if any(begins(name, start) for start in OTHERS) else None


def exception(name: str) -> Terms | None:
    """What may stand behind `with`."""
    return Terms(frozenset(), True) if "exception" in name or name in NOTES else None


def apply(operator: str, left: Terms, right: Terms) -> Terms:
    """An exception behind `with` names no licence, and lifts the duty to share alike."""
    if operator == "with":
        return Terms(left.labels, True)
    permissive = left.permissive or right.permissive if operator == "or" else left.permissive and right.permissive
    return Terms(left.labels | right.labels, permissive)


def evaluate(text: str) -> Terms | None:
    """The longest licence expression that `text`, in lower case, begins with; None if there is none.

    Dijkstra's shunting yard: operands go to one stack, operators wait on another until
    one comes that binds less. Reading ends at the first symbol that can't continue,
    such as a word that is no known identifier. A bracket that is never closed, and an
    operator without a right side, are left out.
    """
    values: list[Terms] = []
    waiting: list[str] = []

    def settle(least: int) -> None:
        while waiting and waiting[-1] != "(" and BINDING[waiting[-1]] >= least:
            right, left = values.pop(), values.pop()
            values.append(apply(waiting.pop(), left, right))

    operand = True
    for symbol in SYMBOL.findall(text):
        if operand and symbol == "(":
            waiting.append(symbol)
        elif operand and symbol != ")" and symbol not in BINDING:
            named = (exception if waiting and waiting[-1] == "with" else licence)(symbol)
            if named is None:
                break
            values.append(named)
            operand = False
        elif not operand and symbol in BINDING:
            settle(BINDING[symbol])
            waiting.append(symbol)
            operand = True
        elif not operand and symbol == ")" and "(" in waiting:
            settle(0)
            waiting.pop()
        else:
            break
    if not values:
        return None
    while operand and waiting and waiting.pop() == "(":
        pass  # up to and with the operator that has no right side
    while waiting:
        settle(0)
        if waiting:
            waiting.pop()  # an open bracket
    return values[-1]


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, label in {**BASE, **NOTICES, TAG: ""}.items():
        found.add_word(f" {phrase} ", (phrase, label))
    found.make_automaton()
    return found


def scan(texts: Iterable[str | None]) -> pd.DataFrame:
    """What is found in each text; see `scan_licenses`."""
    notices, rows = automaton(), []
    for text in texts:
        words = (text or "").encode().translate(LETTERS).split()
        line = f" {b' '.join(words).decode()} "
        base: list[int] = []
        base_labels, labels, permissive = set(), set(), None
        notes = spaces = at = 0
        tagged = False
        for end, (phrase, label) in notices.iter(line):
            if phrase in BASE:
                # counted on from the last place; back at most by the length of a phrase
                start = end - len(phrase) - 1
                spaces += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
                at = start
                base.append(spaces)
                base_labels.add(label)
            elif phrase == TAG:
                tagged = True
            else:
                labels.add(label)
                notes += 1
        for expression in EXPRESSION.findall(text.lower()) if tagged else ():
            if terms := evaluate(expression):
                labels |= terms.labels
                permissive = terms.permissive if permissive is None else permissive and terms.permissive
                notes += 2
        rows.append(
            (
                len(words), len(base), min(base, default=None), max(base, default=None), ",".join(sorted(base_labels)),
                ",".join(sorted(labels | base_labels)), 1 - 0.5 ** (len(base) + notes), permissive,
            )
        )
    frame = pd.DataFrame(rows, columns=["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "permissive"])
    return frame.astype({"n_words": "int64", "n_base": "int64", "first_word": "Int64", "last_word": "Int64", "score": "float64", "permissive": "boolean"})


FOUND = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, permissive boolean"


def scanned(text: Column) -> Column:
    @F.pandas_udf(FOUND)
    def found(texts: pd.Series) -> pd.DataFrame:
        return scan(texts)

    return found(text)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, permissive.

    Words are runs of letters, digits and characters beyond ASCII, A-Z in lower case.
    A notice is found where its words stand one after the other. `n_base` counts the
    places of the base phrases, `first_word` and `last_word` are the smallest and
    largest start, null if there is none. `labels` also has those of other notices and
    of SPDX tags. `score` is 1 - 0.5 ** evidence: 1 for each notice, 2 for each
    expression. `permissive` tells whether all expressions can be met without sharing
    alike; null without any. A null text counts as empty: no words, no labels, score
    0. Repeated rows give repeated results, other columns are ignored, an empty table
    gives no rows.
    """
    return docs.select("doc_id", scanned(F.col("text").cast("string")).alias("f")).select("doc_id", "f.*")
