"""Licence scans: notices, identifier tags, and the value of licence expressions.

Two Aho-Corasick automata go over each whole text once. One finds the word sequences of notices (``PHRASES``) in
the text's words, each place of each phrase, those that overlap too. The other finds tags (``TAGS``), behind which a
licence expression is expected: identifiers, joined by and, or, with, and parentheses. A shunting-yard parser
turns it into postfix order on two explicit stacks, so no depth of parentheses is a burden; it reads as far as the
grammar goes and leaves the rest of the line. The postfix form is evaluated to a strength, from 0 (public
domain) to 5 (no commercial use, or unknown): "or" lets one choose the least, "and" binds by the greatest, and an exception ("with")
relaxes a copyleft licence by one. "and" binds closer than "or", "with" closest.

A text is free to use if its strongest finding is at most ``allowed``. Each row is scanned in its task, in time linear in its
length; nothing is shuffled.

Odd input: a null text is empty; a text without words has zeros, nulls for the places, and empty labels. Tags without a valid expression count as
tags and give no label. Repeated rows, and rows without an id, are scanned each. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.llm.common import pick, small_batches, text_or_empty

RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "n_tags long, expressions array<string>, strength int, allowed boolean"
)

# The phrases whose places are counted, with their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Further notices, with their labels.
NOTICES = {
    "gnu lesser general public license": "lgpl", "gnu library general public license": "lgpl", "gnu affero general public license": "agpl",
    "mozilla public license": "mpl", "eclipse public license": "epl", "boost software license": "bsl", "bsd license": "bsd", "isc license": "isc",
    "redistribution and use in source and binary forms": "bsd", "permission is hereby granted free of charge": "mit",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "creative commons attribution": "cc-by", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc by nc sa": "cc-by-nc-sa", "cc by nc nd": "cc-by-nc-nd",
    "creative commons zero": "cc0", "dedicated to the public domain": "public-domain", "all rights reserved": "all-rights-reserved",
}
PHRASES = {**BASE, **NOTICES}

#: Tags that stand before an expression, in lower case.
TAGS = ("spdx-license-identifier:", "license:", "licence:", "license-expression:", "license =", '"license":')

#: The strength of each label: 0 public domain, 1 permissive, 2 weak, 3 strong and 4 network copyleft, 5 restricted or unknown.
STRENGTH = {
    "cc0": 0, "unlicense": 0, "public-domain": 0, "0bsd": 0, "mit": 1, "apache": 1, "bsd": 1, "isc": 1, "zlib": 1, "bsl": 1, "cc-by": 1, "python": 1, "psf": 1, "artistic": 1, "postgresql": 1, "ncsa": 1, "x11": 1,
    "lgpl": 2, "mpl": 2, "epl": 2, "cddl": 2, "eupl": 2, "ms-pl": 1, "ofl": 2, "gpl": 3, "cc-by-sa": 3, "agpl": 4, "sspl": 4,
    "cc-by-nc": 5, "cc-by-nd": 5, "cc-by-nc-sa": 5, "cc-by-nc-nd": 5, "all-rights-reserved": 5,
}
UNKNOWN = 5
#: How sure each kind of finding makes that a text states a licence.
SURE = {"expression": 0.95, "base": 0.8, "notice": 0.7, "tag": 0.3}

# Every byte that is no part of a word is a blank; A-Z are a-z.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# A longer identifier is none; so tags in a row don't read one another's rest.
_TOKEN = re.compile(r"[ \t]*(\(|\)|[a-z0-9][a-z0-9.+:_-]{0,99}(?![a-z0-9.+:_-]))")
_FAMILY = re.compile(r"(.+?)(?:-v?\d+(?:\.\d+)*(?:-clause)?)?(?:-only|-or-later)?\+?")
_BINDS = {"or": 1, "and": 2, "with": 3}


@cache
def automaton(words: tuple[str, ...]):
    """One automaton per worker; a value is the word's number and length."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, w in enumerate(words):
        found.add_word(w, (i, len(w)))
    found.make_automaton()
    return found


def family(identifier: str) -> str | None:
    """The label of an identifier such as gpl-2.0-or-later or bsd-3-clause; None if it is none."""
    if identifier.startswith(("licenseref-", "documentref-")):
        return identifier
    if identifier in STRENGTH:
        return identifier
    label = _FAMILY.fullmatch(identifier)[1]
    return label if label in STRENGTH else None


def postfix(text: str, at: int = 0) -> list[str]:
    """The longest valid expression that begins there, in postfix order; empty if there is none.

    Shunting-yard: operands go to the output, an operator waits on a stack until one that binds less comes.
    """
    out: list[str] = []
    stack: list[str] = []
    best: tuple[int, list[str]] | None = None
    depth, operand, closed = 0, True, False  # closed: what stands last takes no exception
    while m := _TOKEN.match(text, at):
        t, at = m[1], m.end()
        if operand and t == "(":
            stack.append(t)
            depth += 1
            continue
        if operand:
            after_with = bool(stack) and stack[-1] == "with"
            if after_with:
                known = re.fullmatch(r".*-exception(?:-[0-9.]+)?", t)
            else:
                known = family(t.rstrip(".:")) if t not in _BINDS else None
            if not known:
                break
            out.append(t.rstrip(".:"))
            operand, closed = False, after_with
        elif t == ")" and depth:
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
            depth -= 1
            closed = True
        elif t in _BINDS:
            if t == "with" and closed:
                break
            while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= _BINDS[t]:
                out.append(stack.pop())
            stack.append(t)
            operand = True
            continue
        else:
            break
        if not depth:
            best = len(out), stack.copy()  # three operators at most wait outside parentheses
    return [*out[: best[0]], *reversed(best[1])] if best else []


def evaluated(rpn: list[str]) -> tuple[int, list[str]]:
    """(strength, labels) of an expression in postfix order."""
    stack: list[int] = []
    labels = []
    for t in rpn:
        if t == "with":
            stack[-1] -= 2 <= stack[-1] <= 4
        elif t in _BINDS:
            b, a = stack.pop(), stack.pop()
            stack.append(min(a, b) if t == "or" else max(a, b))
        elif re.fullmatch(r".*-exception(?:-[0-9.]+)?", t):
            continue  # of a "with", which follows
        else:
            label = family(t)
            labels.append(label)
            stack.append(STRENGTH.get(label, UNKNOWN))
    return stack[0], labels


def scanned(raw: bytes, allowed: int) -> tuple:
    """What RESULT says of one text, without its id."""
    words = raw.translate(_WORDS).split()
    line = f" {b' '.join(words).decode()} "
    keys = tuple(PHRASES)
    places, base, labels, sure = [], set(), set(), 1.0
    blanks, seen = 0, 0
    notices = set()
    for end, (i, n) in automaton(tuple(f" {k} " for k in keys)).iter(line):
        blanks += line.count(" ", seen, end + 1)
        seen = end + 1
        labels.add(PHRASES[keys[i]])
        if keys[i] in BASE:
            base.add(BASE[keys[i]])
            places.append(blanks - 2 - keys[i].count(" "))
        else:
            notices.add(keys[i])
    strengths = [STRENGTH[x] for x in labels]
    lower = raw.translate(_LOWER).decode()
    expressions, ends = [], set()
    for end, (_, n) in automaton(TAGS).iter(lower):
        start = end - n + 1
        if end in ends or start and lower[start - 1].isalnum():
            continue
        ends.add(end)
        rpn = postfix(lower, end + 1)
        if rpn:
            expressions.append(" ".join(rpn))
            value, found = evaluated(rpn)
            strengths.append(value)
            labels.update(found)
    for kind, n in (("expression", len(expressions)), ("base", len(base)), ("notice", len(notices)), ("tag", len(ends))):
        sure *= (1 - SURE[kind]) ** min(n, 8)
    strength = max(strengths, default=None)
    ordered = (",".join(sorted(base)), ",".join(sorted(labels)))
    return len(words), len(places), min(places, default=None), max(places, default=None), *ordered, 1 - sure, len(ends), expressions, strength, strength is None or strength <= allowed


def scan_licenses(docs: DataFrame, allowed: int = 2) -> DataFrame:
    """RESULT for every row of docs(doc_id, text).

    expressions: those behind tags, in postfix order; strength: the greatest of all findings, null without any.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = zip(*(x.rsplit(" ", 1) for x in RESULT.split(", ")), strict=True)
        arrow = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "array<string>": pa.list_(pa.string()), "int": pa.int32(), "boolean": pa.bool_()}
        for b in batches:
            rows = [scanned(t.as_buffer().to_pybytes(), allowed) for t in b.column("text")]
            cols = zip(*rows, strict=True) if rows else [[]] * (len(names) - 1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(list(c), arrow[k]) for c, k in zip(cols, kinds[1:], strict=True))], list(names))

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, RESULT)
