import re

import pytest

from voxmill.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# Fixed values of the contract.
BASE = {("gnu", "general", "public", "license"): "gpl", ("apache", "license"): "apache", ("cc", "by"): "cc-by", ("mit", "license"): "mit"}


def base(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, p) for p in BASE for i in range(len(words)) if tuple(words[i : i + len(p)]) == p]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({BASE[p] for _, p in places}))


ODD = [
    None, "", " ", "MIT License", "mit  license mit-license MIT license", "éMIT License", "CC BY CC BY-NC cc,by", "the GNU General Public License, and GNU General GNU General Public License",
    "Apache License Apache License", "ſİK mit license İ", "\x00mit\x00license\x7fx", "cc by" * 50_000, "license:" * 30_000, "(" * 300_000, "SPDX-License-Identifier: " + "(" * 100_000 + "MIT" + ")" * 100_000,
    "a" * 1_000_000 + " mit license", "mit license " * 40_000,
]


def scan(spark, texts, **kw):
    docs = spark.createDataFrame([(i, t, 3, "x") for i, t in enumerate(texts)], "doc_id int, text string, n_words int, labels string")
    return {r.doc_id: r for r in licenses.scan_licenses(docs, **kw).collect()}


def test_base_of_odd_texts(spark):
    found = scan(spark, ODD)
    for i, t in enumerate(ODD):
        r = found[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(t), t and t[:40]
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert found[14].expressions == ["mit"]
    assert licenses.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    twice = spark.createDataFrame([(None, "cc by"), (None, "cc by")], "doc_id long, text string")
    assert [r.n_base for r in licenses.scan_licenses(twice).collect()] == [1, 1]


def test_base_of_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = licenses.scan_licenses(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(texts[r.doc_id])
    some = [r for r in rows if r.labels]
    assert len(some) > 200 and all((r.score > 0) == bool(r.labels) for r in rows)


@pytest.mark.parametrize(
    ("text", "rpn", "strength"),
    [
        ("mit", "mit", 1),
        ("(mit or gpl-2.0-only) and bsd-3-clause foo", "mit gpl-2.0-only or bsd-3-clause and", 1),
        ("mit or gpl-2.0-only and agpl-3.0+", "mit gpl-2.0-only agpl-3.0+ and or", 1),
        ("gpl-3.0 and (mit or agpl-3.0)", "gpl-3.0 mit agpl-3.0 or and", 3),
        ("gpl-2.0-or-later with classpath-exception-2.0 and mit.", "gpl-2.0-or-later classpath-exception-2.0 with mit and", 2),
        ("apache-2.0 with llvm-exception", "apache-2.0 llvm-exception with", 1),
        ("(mit) with llvm-exception", "mit", 1),
        ("gpl-2.0 with mit", "gpl-2.0", 3),
        ("mit and", "mit", 1),
        ("mit or (gpl-2.0", "mit", 1),
        ("((mit", "", None),
        ("or mit", "", None),
        ("foo", "", None),
        ("licenseref-own", "licenseref-own", 5),
        ("cc-by-nc-4.0 or cc0-1.0", "cc-by-nc-4.0 cc0-1.0 or", 0),
        ("mit\nor gpl-2.0", "mit", 1),
    ],
)
def test_expressions(text, rpn, strength):
    got = licenses.postfix(text)
    assert " ".join(got) == rpn
    if rpn:
        assert licenses.evaluated(got)[0] == strength


def test_what_may_be_used(spark):
    texts = ["SPDX-License-Identifier: GPL-3.0-only OR MIT", "License: GPL-3.0-only", "sublicense: mit", "All rights reserved.", "licensed under CC BY-NC 4.0", "none"]
    found = scan(spark, texts)
    assert [found[i].allowed for i in range(6)] == [True, False, True, False, False, True]
    assert found[0].labels == "gpl,mit" and found[2].labels == "" and found[4].labels == "cc-by,cc-by-nc" and found[4].base_labels == "cc-by"
    assert [r.allowed for r in scan(spark, texts, allowed=3).values()].count(True) == 4
