"""Licence scans: expressions against a plain recursive reader, phrases against lists of words."""

from __future__ import annotations

import random
import re

import duckdb
import pytest

from shelfmark.llm.license_scan import NOTICES, TERMS, evaluated, label_of, license_scan
from shelfmark.llm.queries import ORACLES, op11_license_scan


def read(tokens):
    """A recursive reader: (labels, terms) of `a or b and c with d`, or None."""
    place = 0

    def peek():
        return tokens[place] if place < len(tokens) else None

    def item():
        nonlocal place
        t = peek()
        place += 1
        if t == "(":
            inner = either()
            if peek() != ")":
                raise ValueError
            place += 1
            return inner
        if t in (None, ")", "and", "or", "with"):
            raise ValueError
        v = evaluated(t)
        if peek() == "with":
            place += 1
            if peek() in (None, "(", ")", "and", "or", "with"):
                raise ValueError
            place += 1
            return v.labels, 1 if v.terms in (2, 3) else v.terms
        return v.labels, v.terms

    def both():
        nonlocal place
        labels, terms = item()
        while peek() == "and":
            place += 1
            more = item()
            labels, terms = labels | more[0], max(terms, more[1])
        return labels, terms

    def either():
        nonlocal place
        labels, terms = both()
        while peek() == "or":
            place += 1
            more = both()
            labels, terms = labels | more[0], min(terms, more[1])
        return labels, terms

    try:
        value = either()
    except ValueError:
        return None
    return value if place == len(tokens) else None


def test_expressions_against_a_recursive_reader():
    draw = random.Random(7)
    words = ["mit", "gpl-3.0-only", "cc-by-nc-4.0", "lgpl-2.1+", "and", "or", "with", "classpath-exception-2.0", "(", ")"]
    valid = 0
    for _ in range(20_000):
        tokens = draw.choices(words, weights=[3, 3, 2, 2, 3, 3, 1, 1, 2, 2], k=draw.randint(0, 9))
        got, want = evaluated(" ".join(tokens)), read(tokens)
        assert (got and (got.labels, got.terms)) == want, tokens
        valid += want is not None
    assert valid > 300


@pytest.mark.parametrize(
    "expression, labels, terms",
    [
        ("mit", {"mit"}, "permissive"),
        ("gpl-2.0-only with classpath-exception-2.0", {"gpl-2"}, "weak copyleft"),
        ("mit or gpl-3.0-or-later", {"mit", "gpl-3"}, "permissive"),
        ("mit and gpl-3.0-or-later", {"mit", "gpl-3"}, "copyleft"),
        ("(mit or agpl-3.0) and cc-by-nc-4.0", {"mit", "agpl-3", "cc-by-nc"}, "restricted"),
        ("mit or agpl-3.0 and cc-by-nc-4.0", {"mit", "agpl-3", "cc-by-nc"}, "permissive"),
        ("licenseref-ours", {"licenseref-ours"}, "unknown"),
        ("none", set(), "unknown"),
    ],
)
def test_values(expression, labels, terms):
    value = evaluated(expression)
    assert (set(value.labels), TERMS[value.terms]) == (labels, terms)


def test_labels():
    assert [label_of(x) for x in ("apache-2.0", "gpl-2.0+", "cc-by-nc-sa-4.0", "cc0-1.0", "bsd-3-clause")] == ["apache-2", "gpl-2", "cc-by-nc-sa", "cc0", "bsd-3-clause"]


LONG = "word " * 60_000 + "Under the MIT\nLicense " + "word " * 10
CASES = [
    (1, "Released under the MIT License, and CC-BY-NC; cc by nc cc by nc 4.0"),
    (2, "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0 */ code"),
    (3, "spdx-license-identifier: see the file\nSPDX-License-Identifier:\n# SPDX-License-Identifier: \"0BSD\""),
    (4, "SPDX-License-Identifier: MIT SPDX-License-Identifier: ((Zlib))\nSPDX-License-Identifier: NONE <!-- SPDX-License-Identifier: ISC -->"),
    (5, None),
    (6, ""),
    (7, LONG),
    (8, "under  the\tMIT  license apache license version 2.0 under the mit licenses underé the mit license"),
    (8, "under  the\tMIT  license apache license version 2.0 under the mit licenses underé the mit license"),
    (None, "all rights reserved"),
    (9, "spdx license identifier without a colon; SPDX-License-Identifier: a with (b)"),
    (10, "SPDX-License-Identifier: MIT WITH x WITH y\nspdx-license-identifier: (mit\nspdx-license-identifier: ()"),
]


def test_places_against_lists_of_words(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in CASES], "doc_id long, text string, labels string")
    got = {}
    for r in license_scan(docs).collect():
        got.setdefault(r.doc_id, []).append(sorted((p.phrase, p.first, p.last) for p in r.places))
    for i, text in CASES:
        words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        want = sorted(
            (phrase, at, at + n - 1)
            for phrase in NOTICES
            for n in [len(phrase.split())]
            for at in range(len(words) - n + 1)
            if words[at : at + n] == phrase.split()
        )
        assert want in got[i]
    assert len(got[8]) == 2


def test_expressions_behind_tags(spark):
    docs = spark.createDataFrame(CASES, "doc_id long, text string")
    rows = {r.doc_id: r for r in license_scan(docs).collect()}
    assert rows[2].labels == ["apache-2", "gpl-2", "mit"] and rows[2].terms == "weak copyleft" and rows[2].score == 1.0
    assert [(e.expression, e.valid) for e in rows[3].expressions] == [("see the file", False), ("", False), ("0bsd", True)]
    assert rows[4].labels == ["isc", "mit", "zlib"]
    assert [e.valid for e in rows[9].expressions] == [False] and rows[9].score == 0.0
    assert [e.valid for e in rows[10].expressions] == [False] * 3
    assert rows[5].n_words == 0 and rows[5].labels == [] and rows[5].terms is None
    assert rows[7].labels == ["mit"] and rows[None].labels == ["reserved"] and rows[None].score == 0.6


def test_query_against_sql_on_cases(spark, tmp_path):
    cases = [(1 if i is None else i, t) for i, t in CASES]
    spark.createDataFrame(cases, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    result = con.execute(ORACLES["op11_license_scan"])
    names = [c[0] for c in result.description]
    out = op11_license_scan(spark, str(tmp_path))
    assert out.columns == names
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(result.fetchall(), key=repr)


def test_no_phrases_no_tags_no_rows(spark):
    docs = spark.createDataFrame([(1, "under the mit license")], "doc_id long, text string")
    assert license_scan(docs, {}, ()).first().labels == []
    assert license_scan(docs, {"the MIT": "x"}, ()).first().places[0].asDict() == {"phrase": "the MIT", "label": "x", "first": 1, "last": 2}
    assert license_scan(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        license_scan(docs, {"!": "x"}).collect()
