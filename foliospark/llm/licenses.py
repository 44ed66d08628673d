"""License scan: Aho-Corasick over identifier tags and notice phrases, and a shunting-yard parser of license expressions.

Texts are normalised to lower-case ASCII words joined by single spaces; phrases are matched on whole words, overlapping ones
included. Behind an identifier tag, whose words stand on one line, the rest of that line is parsed and evaluated as an expression
(and / or / with, parentheses): the automaton's hit gives the tag's place among the words, and the words' places in the text the line.

Defined cases: a null or empty text has no words, no places, empty labels and score 0. A malformed expression yields the labels
of the identifiers read before the fault and no obligation. Extra columns of the input are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, over_arrow, raw_texts

#: Phrases of the contract; their labels are the base labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Notices: (phrase, label, weight of the evidence).
NOTICES = [
    ("released under the mit license", "mit", 0.9),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 0.9),
    ("licensed under the apache license version 2 0", "apache-2.0", 0.9),
    ("gnu general public license", "gpl", 0.8),
    ("general public license version 2", "gpl-2.0", 0.9),
    ("general public license version 3", "gpl-3.0", 0.9),
    ("lesser general public license", "lgpl", 0.9),
    ("affero general public license", "agpl", 0.9),
    ("mozilla public license", "mpl", 0.9),
    ("eclipse public license", "epl", 0.9),
    ("bsd license", "bsd", 0.8),
    ("redistribution and use in source and binary forms", "bsd", 0.9),
    ("creative commons attribution", "cc-by", 0.8),
    ("licensed under cc by", "cc-by", 0.9),
    ("cc by nc", "cc-by-nc", 0.9),
    ("cc by sa", "cc-by-sa", 0.9),
    ("public domain dedication", "cc0", 0.8),
    ("all rights reserved", "proprietary", 0.5),
]
#: Tags whose line holds a license expression.
TAGS = ["spdx license identifier", "license expression"]
BASE_WEIGHT, TAG_WEIGHT = 0.6, 0.95
#: Families of identifiers and the obligation that they bring: 0 permissive, 1 weak copyleft, 2 strong copyleft, 3 no free use.
FAMILIES = [
    ("agpl", 2), ("lgpl", 1), ("gpl", 2), ("mpl", 1), ("epl", 1), ("apache", 0), ("mit", 0), ("bsd", 0), ("isc", 0), ("zlib", 0),
    ("unlicense", 0), ("cc0", 0), ("cc-by-nc", 3), ("cc-by-sa", 1), ("cc-by", 0), ("proprietary", 3),
]
#: Exceptions that turn strong into weak copyleft.
LINKING = ("classpath-exception", "gcc-exception", "llvm-exception", "linking-exception", "font-exception", "bison-exception")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}

_SEPARATORS = bytes(0x20 if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_RAW_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_REST = re.compile(rb"[ \t]*[:=]?[ \t]*([^\r\n]*)")
_TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+-]*")


@dataclass(frozen=True)
class Verdict:
    """labels: identifiers of the expression; obligation: the least that a user who picks freely among alternatives takes on."""

    labels: tuple[str, ...]
    obligation: int | None


def family(identifier: str) -> int:
    """Obligation of a license identifier; an unknown one counts as no free use."""
    return next((o for name, o in FAMILIES if identifier.startswith(name)), 3)


def postfix(text: str) -> list[str] | None:
    """Shunting-yard: an expression in postfix order; None if it is malformed. Text after a complete expression ends it."""
    out: list[str] = []
    stack: list[str] = []
    operand = True  # what may come next
    for token in _TOKEN.findall(text):
        token = token.rstrip(".-") or token
        if operand:
            if token == "(":
                stack.append(token)
            elif token in PRECEDENCE or token == ")":
                return None
            else:
                out.append(token)
                operand = False
        elif token in PRECEDENCE:
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[token]:
                out.append(stack.pop())
            stack.append(token)
            operand = True
        elif token == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                break
            stack.pop()
        else:
            break
    if operand or "(" in stack:
        return None
    return out + stack[::-1]


def evaluate(text: str) -> Verdict:
    """Value of a license expression: `or` takes the lighter side, `and` the heavier, `with` a linking exception lightens."""
    order = postfix(text)
    if order is None:
        return Verdict(tuple(sorted({t.rstrip(".-") for t in _TOKEN.findall(text) if t.startswith(tuple(n for n, _ in FAMILIES))})), None)
    stack: list[tuple[frozenset[str], int, str]] = []
    for token in order:
        if token not in PRECEDENCE:
            stack.append((frozenset([token]), family(token), token))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            stack.append((left[0], min(left[1], 1) if right[2].startswith(LINKING) else left[1], left[2]))
        else:
            stack.append((left[0] | right[0], (min if token == "or" else max)(left[1], right[1]), ""))
    return Verdict(tuple(sorted(stack[0][0])), stack[0][1])


def automaton() -> ahocorasick.Automaton:
    """Phrases of all kinds, padded with spaces so that only whole words match."""
    found: dict[str, list[tuple[str, str, float]]] = {}
    for phrase, label in BASE.items():
        found.setdefault(phrase, []).append(("base", label, BASE_WEIGHT))
    for phrase, label, weight in NOTICES:
        found.setdefault(phrase, []).append(("notice", label, weight))
    for phrase in TAGS:
        found.setdefault(phrase, []).append(("tag", phrase, TAG_WEIGHT))
    out = ahocorasick.Automaton()
    for phrase, kinds in found.items():
        out.add_word(f" {phrase} ", (len(phrase) + 1, kinds))
    out.make_automaton()
    return out


def tag_lines(raw: bytes, tags: list[tuple[int, int]]) -> list[bytes]:
    """What follows each tag on its line. tags: (number of the first word, count of words), ascending."""
    out, spans, at = [], _RAW_WORD.finditer(raw), -1
    ends: dict[int, tuple[int, int]] = {}
    for first, n in tags:
        while at < first + n - 1 and (m := next(spans, None)):
            at += 1
            ends[at] = m.span()
        begin, end = ends[first][0], ends[first + n - 1][1]
        if b"\n" not in raw[begin:end] and b"\r" not in raw[begin:end]:
            out.append(_REST.match(raw, end)[1])
        for k in [k for k in ends if k < first]:
            del ends[k]
    return out


def scan(raw: bytes | None, finder: ahocorasick.Automaton) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, expressions, obligation) of one text."""
    words = (raw or b"").translate(_SEPARATORS).split()
    line = b" ".join([b"", *words, b""]) if words else b""
    base: set[str] = set()
    labels: set[str] = set()
    places: list[int] = []
    doubt, at, seen = 1.0, 0, 0
    tags: list[tuple[int, int]] = []
    evidence: set[tuple[str, float]] = set()
    for end, (back, kinds) in finder.iter(line.decode("latin-1")):
        start = end - back
        seen += line.count(b" ", at, start) if start >= at else -line.count(b" ", start, at)
        at = start
        for kind, label, weight in kinds:
            if kind == "tag":
                tags.append((seen, label.count(" ") + 1))
                continue
            if kind == "base":
                places.append(seen)
                base.add(label)
            labels.add(label)
            evidence.add((label, weight))
    expressions: list[str] = []
    obligation = None
    if tags:
        for found in tag_lines(raw, sorted(tags)):
            text = found.lower().decode("utf-8", "replace").strip()
            verdict = evaluate(text)
            if verdict.labels:
                expressions.append(text)
                labels.update(verdict.labels)
                evidence.update((x, TAG_WEIGHT) for x in verdict.labels)
            if verdict.obligation is not None:
                obligation = max(verdict.obligation, obligation or 0)
    for _, weight in sorted(evidence):
        doubt *= 1 - weight
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), 1 - doubt, expressions, obligation


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions array<string>, obligation int"


def license_scan(docs: DataFrame) -> DataFrame:
    """One row for each document. A map over whole texts: no shuffle, memory bounded by one Arrow batch."""
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string()), pa.int32()]

    def make():
        finder = automaton()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [scan(raw, finder) for raw in raw_texts(batch.column("text"))]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], names=[f.split()[0] for f in SCHEMA.split(", ")])

        return work

    return over_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), SCHEMA, make)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(load(spark, sf_dir, "documents"))
